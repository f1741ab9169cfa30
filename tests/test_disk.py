"""Stored tables leave neither superseded versions nor shuffles nor caches behind."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestay import sources
from lodestay.operators import marts
from lodestay.sources import keyed
from lodestay.sources.keyed import Keyed, upsert_latest

SCHEMA = "listing_id long, calendar_date date, price int"


def days(spark, listings, first, last):
    return spark.createDataFrame([(i, date(2024, 1, d), d * i) for i in range(listings) for d in range(first, last)], SCHEMA)


def test_a_load_keeps_no_copy_and_deals_large_buckets_as_several_tasks(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=4, keep=1, task_rows=50)
    seen = []

    def change(old, fresh, deal):
        new = marts.fct_calendar_incremental(old, fresh, deal)
        seen.append((fresh.is_cached, new.rdd.getNumPartitions()))
        return new

    for low, high in ((1, 11), (9, 21)):
        table.merge(days(spark, 40, low, high), change)
        assert set(keyed.names(spark, f"{table.path}/data")) == set(table.state()["folders"].values())
    assert seen[0] == (False, 8) and not seen[1][0] and seen[1][1] > 8  # 400 rows in 4 buckets, 50 a task
    assert all(".zstd." in p.name for p in Path(table.path, "data").rglob("*.parquet"))
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, marts.fct_calendar_daily(days(spark, 40, 1, 21)).collect()))


def test_shuffles_go_as_a_load_ends(spark):
    before = spark.conf.get(keyed.RELEASE, None)
    tracker = spark._jsparkSession.sparkContext().env().mapOutputTracker()
    held = tracker.shuffleStatuses().size()
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=4)
    for low, high in ((1, 11), (9, 21)):
        marts.load_calendar(table, days(spark, 40, low, high))
    assert tracker.shuffleStatuses().size() <= held and spark.conf.get(keyed.RELEASE, None) == before


def test_rows_of_other_buckets_are_refused(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/t", ["k"], buckets=4)
    row = lambda *ks: spark.createDataFrame([(k, 1) for k in ks], "k long, at int")
    table.merge(row(*range(20)), upsert_latest(["k"], F.desc("at")))
    with pytest.raises(RuntimeError, match="not given"):
        table.merge(row(1), lambda old, fresh, deal: row(*range(20)))
    assert table.read().count() == 20


def test_a_large_change_goes_in_rounds(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=8, keep=1, round_rows=200)
    seen = []

    def change(old, fresh, deal):
        seen.append({r[0] for r in fresh.select(table.number(8)).distinct().collect()})
        return marts.fct_calendar_incremental(old, fresh, deal)

    for low, high in ((1, 11), (9, 21)):
        seen.clear()
        table.merge(days(spark, 60, low, high), change)
        assert len(seen) > 2 and sum(map(len, seen)) == len(set().union(*seen)) == 8  # every bucket in one round
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, marts.fct_calendar_daily(days(spark, 60, 1, 21)).collect()))


def test_new_days_that_come_twice_take_one_exchange(spark):
    rows = days(spark, 5, 1, 6).withColumn("at", F.lit(1)).unionByName(days(spark, 5, 3, 8).withColumns({"at": F.lit(2), "price": F.col("price") + 1}))
    twice = rows.unionByName(spark.createDataFrame([(1, None, 5, 1), (1, None, 5, 1)], rows.schema))
    order = [F.desc("at")]
    stored = marts.fct_calendar_daily(days(spark, 5, 1, 4).withColumn("at", F.lit(0)))
    for old in (None, spark.createDataFrame(stored.collect(), stored.schema)):
        df = marts.fct_calendar_incremental(old, twice, lambda df: df.repartition(3, "listing_id"), order)
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        got = {(r.listing_id, r.calendar_date, r.price) for r in df.collect()}
        assert df.count() == 5 * 7 + 2 and {(i, date(2024, 1, d), d * i + (d >= 3)) for i in range(5) for d in range(1, 8)} <= got


def test_buckets_that_only_gain_rows_are_not_written_again(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/t", ["k"], buckets=4, stamp="at", keep=1)
    upsert = upsert_latest(["k"], F.desc("at"))
    row = lambda ks, at, more=None: spark.createDataFrame([(k, at, f"{k}/{at}") for k in ks], f"k long, at timestamp, {more or 'v'} string")
    stamps = [datetime(2024, 1, d) for d in range(1, 6)]
    exchanged = []

    def change(old, fresh, deal):
        return upsert(old, fresh, lambda df: exchanged.append(1) or deal(df))

    assert table.merge(row(range(40), stamps[0]), change, keys=["k"])
    first = table.state()
    exchanged.clear()
    assert table.merge(row(range(40, 80), stamps[1]), change, keys=["k"])
    second = table.state()
    assert second["folders"] == first["folders"] and set(second["gained"]) == set(first["folders"]) and len(exchanged) == 1  # for the schema
    assert all(second["bytes"][b] > first["bytes"][b] for b in first["bytes"])
    hit = str(table.read().where("k = 7").select(table.number(4)).first()[0])
    assert table.merge(row([7, 100, 101, 102, 103, 104], stamps[2]), change, keys=["k"])  # one key is there already
    third = table.state()
    assert third["folders"][hit] != first["folders"][hit] and hit not in third["gained"]
    assert all(third["folders"][b] == first["folders"][b] for b in third["folders"] if b != hit)
    assert table.merge(row([200, 200], stamps[3]), change, keys=["k"])  # twice in one batch
    assert table.merge(row([300], stamps[4], "w"), change, keys=["k"])  # a column that comes later
    got = {r.k: (r.at, r.v, r.w) for r in table.read().collect()}
    at = dict.fromkeys(range(40), 0) | dict.fromkeys(range(40, 80), 1) | dict.fromkeys([7, *range(100, 105)], 2) | {200: 3}
    assert got == {k: (stamps[i], f"{k}/{stamps[i]}", None) for k, i in at.items()} | {300: (stamps[4], None, f"300/{stamps[4]}")}
    assert table.read().count() == 87 and set(keyed.names(spark, f"{table.path}/data")) == set(table.state()["folders"].values()).union(*table.state()["gained"].values())
