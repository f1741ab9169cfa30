"""Loads of the stored warehouse that grow with what arrives: slices of the facts, one sort, texts and reviewers once."""

import random
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lodestay import sources
from lodestay.operators import clean, marts
from lodestay.plans import bridge
from lodestay.plans.warehouse import Warehouse
from lodestay.queries import warehouse as queries
from lodestay.sources import loading
from lodestay.sources.keyed import Keyed, upsert_latest

SCHEMA = "listing_id long, calendar_date date, price int, at int"
SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(table):
    return {p.relative_to(table.path).as_posix() for p in Path(table.path, "data").rglob("*.parquet")}


def days(spark, listings, year, price=5, at=1):
    return spark.createDataFrame([(i, date(year, m, d), price + i + m, at) for i in range(listings) for m in (1, 12) for d in (1, 2, 31)], SCHEMA)


def test_later_days_leave_earlier_years_as_they_are(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=4, keep=1, slices=marts.YEARS)
    order = [F.desc("at")]
    marts.load_calendar(table, days(spark, 20, 1996).unionByName(days(spark, 20, 1997)).unionByName(days(spark, 20, 1998)), order=order)
    before, read = files(table), []
    later = days(spark, 20, 1998, 70, 2).where("calendar_date > '1998-12-01'").unionByName(days(spark, 20, 1999, 90, 2))

    def change(old, fresh, deal, earlier):
        new = marts.fct_calendar_incremental(old, fresh, deal, order, earlier)
        read.append((old.inputFiles(), earlier.select("price").inputFiles(), new._jdf.queryExecution().executedPlan().toString()))
        return new

    table.merge(later, change)
    (old, earlier, plan), kept = read[0], files(table)
    assert old and all("slice=1998" in f for f in old) and earlier and all("slice=1996" in f or "slice=1997" in f for f in earlier)
    assert {f for f in before if "slice=1998" not in f} < kept and not {f for f in before if "slice=1998" in f} & kept  # superseded ones are deleted
    assert plan.count("Sort [") == 1
    held = {}
    for df in (days(spark, 20, 1996), days(spark, 20, 1997), days(spark, 20, 1998), later):
        held |= {(r.listing_id, r.calendar_date): tuple(r) for r in df.collect()}
    assert rows(table.read()) == rows(marts.fct_calendar_daily(spark.createDataFrame(list(held.values()), SCHEMA)))


def test_slices_hold_what_one_load_gives_whatever_comes_when(spark):
    rng = random.Random(11)
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=2, keep=1, slices=marts.YEARS)
    held, dateless = {}, []
    for n, years in enumerate(((2000, 2003), (2005,), (1998, 2001), (2004, 2005), ()), 1):  # later, earlier and between; the last without dates alone
        given = {(i, date(y, 1, d)): (rng.choice([None, *range(50, 99)]), n) for y in years for i in rng.sample([None, *range(6)], 4) for d in rng.sample(range(1, 29), 5)}
        lost = [(rng.choice([1, 5, None]), None, rng.randrange(50, 99), n) for _ in range(3)]
        fresh = spark.createDataFrame([*[(*k, *v) for k, v in given.items()], *lost], SCHEMA)
        twice = fresh.unionByName(fresh.where("calendar_date IS NOT NULL").withColumns({"price": F.lit(1), "at": F.col("at") - 10}))
        assert marts.load_calendar(table, twice, n, order=[F.desc("at")])
        assert not marts.load_calendar(table, twice, n, order=[F.desc("at")])
        held, dateless = held | given, dateless + lost
        want = marts.fct_calendar_daily(spark.createDataFrame([*[(*k, *v) for k, v in held.items()], *dateless], SCHEMA))
        assert rows(table.read()) == rows(want)
    assert set(table.state()["folders"]) <= {f"{b}/{y}" for b in (0, 1) for y in (1998, 2000, 2001, 2003, 2004, 2005, 9999)}


def test_a_table_without_slices_gets_them_with_its_next_load(spark):
    path = f"{sources.work_dir(spark)}/facts"
    marts.load_calendar(Keyed(spark, path, ["listing_id"], buckets=2), days(spark, 5, 1997))
    table = Keyed(spark, path, ["listing_id"], buckets=2, keep=1, slices=marts.YEARS)
    marts.load_calendar(table, days(spark, 1, 1998))
    assert all("/" in c for c in table.state()["folders"])
    assert rows(table.read()) == rows(marts.fct_calendar_daily(days(spark, 5, 1997).unionByName(days(spark, 1, 1998))))


def test_a_bucket_of_many_slices_is_not_split_for_its_sum(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/facts", ["listing_id"], buckets=2, slices=marts.YEARS)
    for year in (1996, 1997, 1998, 1999):
        marts.load_calendar(table, days(spark, 40, year))
        table.bucket_bytes = max(table.state()["bytes"].values())  # a cell's
    assert table.state()["buckets"] == 2 and sum(table.state()["bytes"].values()) > 3 * 2 * min(table.state()["bytes"].values())


def test_days_of_a_stretch_of_time_are_those_filtered(spark):
    whole = bridge.raw_calendar(spark, SF)
    for since, until in (("1998-12-25", None), (None, "1999-01-01"), ("1998-12-25", "1999-01-01")):
        want = whole.where(f"date >= '{since or '0'}' AND date < '{until or '9'}'")
        assert rows(bridge.raw_calendar(spark, SF, since=since, until=until)) == rows(want) != []


def test_texts_are_read_once_a_document_and_reviewers_grouped_once(spark, monkeypatch):
    taken = []
    merge = Keyed.merge

    def watched(self, fresh, *more, **others):
        taken.append((self.path.rsplit("/", 1)[1], fresh.inputFiles(), fresh._jdf.queryExecution().executedPlan().toString()))
        return merge(self, fresh, *more, **others)

    monkeypatch.setattr(Keyed, "merge", watched)
    house: Warehouse = queries._refreshed(spark, SF)
    assert all("lower(" not in plan for at, _, plan in taken if at == "reviews_cleaned")
    assert all(f and all("/.reviewers-" in x for x in f) for at, f, _ in taken if at == "dim_reviewers")
    assert not list(Path(house.path.removeprefix("file://"), "stored").glob(".reviewers-*"))
    raw = bridge.raw_reviews(spark, SF)
    each = clean.clean_reviews(clean.stg_reviews(raw), *house.words).select("review_id", "review_length", "sentiment", "record_hash")
    assert rows(house.reviews.read().select(*each.columns)) == rows(each)


def test_stored_stamps_have_statistics_to_prune_by(spark):
    work = sources.work_dir(spark).removeprefix("file://")
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    loading.append_batch(spark.range(9), f"{work}/bronze", "b1", "f", F.lit("2024-01-01").cast("timestamp"))
    table = Keyed(spark, f"{work}/t", ["id"], buckets=1, stamp="_ingested_at")
    table.merge(spark.read.parquet(f"{work}/bronze"), upsert_latest(["id"], F.desc("_ingested_at")))
    for p in [*Path(work, "bronze").rglob("*.parquet"), *Path(work, "t").rglob("*.parquet")]:
        group = pq.ParquetFile(p).metadata.row_group(0)
        column = next(c for i in range(group.num_columns) if (c := group.column(i)).path_in_schema == "_ingested_at")
        assert column.physical_type == "INT64" and column.statistics.has_min_max
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before


def test_a_table_that_only_gains_rows_is_not_written_anew_for_its_size(spark):
    table = Keyed(spark, f"{sources.work_dir(spark)}/t", ["k"], buckets=2, bucket_bytes=1000)
    put = lambda low, high, at: table.merge(spark.range(low, high).select(F.col("id").alias("k"), F.lit(at).alias("at")), upsert_latest(["k"], F.desc("at")), keys=["k"])
    put(0, 3000, 1)
    before = files(table)
    put(3000, 6000, 2)
    state = table.state()
    assert sum(state["bytes"].values()) > 4 * 2 * 1000 and state["buckets"] == 2 and before < files(table) and table.read().count() == 6000
    put(5999, 6001, 3)  # one key is there already
    assert table.state()["buckets"] > 2 and rows(table.read().where("k > 5997")) == [(5998, 2), (5999, 3), (6000, 3)] and table.read().count() == 6001
