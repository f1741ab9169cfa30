"""Stored versions against those computed in memory, batch by batch."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestay import sources
from lodestay.functions import record_hash
from lodestay.operators import incremental as inc
from lodestay.sources import history as module
from lodestay.sources.history import History


def batch(spark, rows, stamp):
    return spark.createDataFrame(rows, "id long, price int").withColumns({"_ingested_at": F.lit(stamp).cast("timestamp"), "record_hash": record_hash("price")})


def rows(df):
    return sorted(map(tuple, df.select("id", "price", "valid_from", "valid_to", "is_current", "version_sk").collect()), key=repr)


def contents(path):
    return {p.relative_to(path).as_posix(): (p.stat().st_mtime_ns, p.read_bytes()) for p in Path(path, "data").rglob("is_current=false/*.parquet")}


def test_batches_on_disk_are_those_in_memory_and_closed_files_stay(spark):
    rng = random.Random(4)
    path = f"{sources.work_dir(spark)}/dim"
    dim, table, state, closed = None, History(spark, path, "id", buckets=4), {}, {}
    for k in range(1, 5):
        stamp = f"2024-0{k}-01 00:00:00"
        state |= {i: rng.randrange(3) for i in rng.sample(range(30), 18)}
        fresh = batch(spark, sorted(state.items()), stamp)
        dim = inc.scd2(dim, fresh, "id", stamp)
        dim = sources.materialize(dim, "table", f"dim{k}", sources.work_dir(spark))
        assert table.apply(fresh, stamp) and not table.apply(fresh, stamp)
        assert rows(table.read()) == rows(dim) and rows(table.current()) == rows(dim.where("is_current"))
        now = contents(path)
        assert closed.items() <= now.items() and (k == 1 or len(now) > len(closed))
        closed = now
    assert table.vacuum() == 3 and rows(table.read()) == rows(dim) and contents(path) == closed


def test_only_the_batch_is_exchanged(spark):
    path = f"{sources.work_dir(spark)}/dim"
    table = History(spark, path, "id", buckets=4)
    table.apply(batch(spark, [(i, i) for i in range(100)], "2024-01-01 00:00:00"), "2024-01-01 00:00:00")
    plan = table.following(batch(spark, [(1, 5), (200, 5)], "2024-02-01 00:00:00"), "2024-02-01 00:00:00", table.state())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan and "PartitionFilters: [isnotnull(is_current" in plan, plan
    assert len(list(Path(path, "data").rglob("*.parquet"))) <= 4


def test_a_lost_change_and_another_session(spark, monkeypatch):
    path = f"{sources.work_dir(spark)}/dim"
    table = History(spark, path, "id", buckets=2)
    one, two = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    table.apply(batch(spark, [(1, 5), (2, 6), (None, 7)], one), one)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(module, "switch", lost)
        with pytest.raises(OSError, match="lost"):
            table.apply(batch(spark, [(1, 9)], two), two)
    assert {(r.id, r.price, r.is_current) for r in table.read().collect()} == {(1, 5, True), (2, 6, True), (None, 7, True)}
    table.apply(batch(spark, [(1, 9), (2, 6)], two), two)
    want = rows(table.read())
    assert {(r[0], r[1], r[4]) for r in want} == {(1, 5, False), (1, 9, True), (2, 6, True), (None, 7, True)}
    spark.sql(f"DROP TABLE {table.state()['table']}")  # as in a session with another catalog
    assert rows(History(spark, path, "id").read()) == want
    old = "2023-01-01 00:00:00"
    assert not table.apply(batch(spark, [(1, 1)], old), old)
    assert table.apply(batch(spark, [(1, 1)], old), "2024-03-01 00:00:00") and rows(table.read()) == want  # older data under a newer stamp
