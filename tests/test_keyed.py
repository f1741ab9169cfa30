"""Stored keyed tables: what changes, what stays, and what a lost driver leaves."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestay import sources
from lodestay.operators import marts
from lodestay.sources import keyed
from lodestay.sources.keyed import Keyed, upsert_latest

SCHEMA = "listing_id long, calendar_date date, price int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(table):
    return {p.relative_to(table.path).as_posix() for p in Path(table.path, "data").rglob("*.parquet")}


def put(spark, table, *given, batch=None):
    return table.merge(spark.createDataFrame(list(given), "k long, v string, at int"), upsert_latest(["k"], F.desc("at"), F.asc("v")), batch)


def test_facts_on_disk_are_those_of_one_load_without_dates_too(spark):
    rng = random.Random(5)
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=8)
    held, dateless = {}, []
    for n in range(1, 5):
        batch = {(i if i else None, date(2024, 1, d)): rng.randrange(50, 99) for i in rng.sample(range(7), 4) for d in rng.sample(range(1, 29), 9)}
        lost = [(rng.choice([1, 5, None]), None, rng.randrange(50, 99)) for _ in range(3)]
        fresh = spark.createDataFrame([*[(i, d, p) for (i, d), p in batch.items()], *lost], SCHEMA)
        assert marts.load_calendar(table, fresh, n)
        assert not marts.load_calendar(table, fresh, n)  # it is in
        held |= batch
        dateless += lost
        want = marts.fct_calendar_daily(spark.createDataFrame([*[(i, d, p) for (i, d), p in held.items()], *dateless], SCHEMA))
        assert rows(table.read()) == rows(want)


def test_a_load_leaves_other_buckets_alone_and_reads_its_own_once(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=16)
    marts.load_calendar(table, spark.createDataFrame([(i, date(2024, 1, d), d) for i in range(40) for d in (1, 2, 3)], SCHEMA))
    before = files(table)
    assert len(before) == len(table.state()["folders"]) > 8  # a file a bucket
    seen = []

    def change(old, fresh, deal):
        new = marts.fct_calendar_incremental(old, fresh, deal)
        seen.append((old.inputFiles(), new._jdf.queryExecution().executedPlan().toString()))
        return new

    table.merge(spark.createDataFrame([(3, date(2024, 1, 2), 9)], SCHEMA), change)
    (read, plan), bucket = seen[0], spark.range(1).select(F.pmod(F.hash(F.lit(3).cast("long")), F.lit(16))).first()[0]
    assert read and all(f"bucket={bucket}/" in f for f in read)
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1
    state = table.state()
    current = {f for f in files(table) if any(f.startswith(f"data/{folder}/bucket={b}/") for b, folder in state["folders"].items())}
    assert len(current & before) == len(before) - 1  # all but its own keep their names
    got = {(r.calendar_date.day): (r.price, r.price_change_from_previous_day) for r in table.read().where("listing_id = 3").collect()}
    assert got == {1: (1, 0), 2: (9, 8), 3: (3, -6)}


def test_what_is_lost_before_the_switch_changes_nothing(spark, monkeypatch):
    table = Keyed(spark, f"{sources.work_dir(spark)}/t", ["k"], buckets=4)
    put(spark, table, (1, "a", 1), (2, "b", 1), batch=1)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "switch", lost)
        with pytest.raises(OSError, match="lost"):
            put(spark, table, (1, "new", 2), (3, "c", 1), batch=2)
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 1)]
    assert put(spark, table, (1, "new", 2), (3, "c", 1), batch=2)
    assert rows(table.read()) == [(1, "new", 2), (2, "b", 1), (3, "c", 1)]
    assert not put(spark, table, (1, "newer", 3), batch=2) and not put(spark, table, (1, "newer", 3), batch=1)
    assert table.vacuum(keep=1) >= 1  # what the lost change wrote
    assert set(keyed.names(spark, f"{table.path}/data")) == set(table.state()["folders"].values())
    assert rows(table.read()) == [(1, "new", 2), (2, "b", 1), (3, "c", 1)]


def test_an_overtaken_writer_raises(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/t", ["k"], buckets=4)
    put(spark, table, (1, "a", 1))
    state = table.state()
    put(spark, table, (1, "b", 2))
    with pytest.raises(RuntimeError, match="someone else"):
        keyed.switch(spark, table.path, state["number"] + 1, {})
    assert rows(table.read()) == [(1, "b", 2)]


def test_buckets_grow_with_the_table(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/t", ["k"], buckets=2, bucket_bytes=1000)
    for n in range(4):
        put(spark, table, *[(i, f"v{n}", n) for i in range(n * 300, n * 300 + 400)])
    state = table.state()
    assert state["buckets"] >= 8 and sum(state["bytes"].values()) > 4000
    assert sorted(map(tuple, table.read().collect())) == [(i, f"v{min(i // 300, 3)}", min(i // 300, 3)) for i in range(1300)]


def test_new_columns_are_appended_and_nothing_is_a_change_too(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/t", ["k"], buckets=4)
    assert table.read() is None
    put(spark, table, (1, "a", 1), (2, "b", 1), (None, "n", 1))
    table.merge(spark.createDataFrame([(2, "c", 2, True)], "k long, v string, at int, extra boolean"), upsert_latest(["k"], F.desc("at")))
    assert rows(table.read()) == sorted([(1, "a", 1, None), (2, "c", 2, True), (None, "n", 1, None)], key=repr)
    table.merge(spark.createDataFrame([], "k long, v string, at int, extra boolean"), upsert_latest(["k"], F.desc("at")))
    assert table.read().count() == 3 and table.state()["number"] == 2


def test_the_watermark_is_in_the_state_and_reaches_the_scan(spark):
    work = sources.work_dir(spark)
    events = spark.range(100).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("at"))
    events.write.parquet(f"{work}/in")
    source = spark.read.parquet(f"{work}/in")
    table = Keyed(spark, f"{work}/t", ["id"], buckets=4, stamp="at")
    assert table.above(source).count() == 100
    for part in ("id < 40", "id BETWEEN 20 AND 30"):
        table.merge(source.where(part), upsert_latest(["id"], F.desc("at")))
    newer = table.above(source)
    assert sorted(r.id for r in newer.collect()) == list(range(40, 100))
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert f"{work}/t" not in plan and plan.count("FileScan") == 1 and "GreaterThan(at," in plan
