import random

import pytest
from pyspark.sql import functions as F

from lodestay import sources, streaming
from lodestay.functions import record_hash
from lodestay.operators import incremental as inc
from lodestay.operators import marts
from lodestay.sources import loading
from lodestay.sources.keyed import Keyed


def batch(spark, rows, stamp):
    df = spark.createDataFrame(rows, "id long, price int")
    return df.withColumns({"host_is_superhost": F.lit(True), "room_type": F.lit("r"), "minimum_nights": F.lit(1), "_ingested_at": F.lit(stamp).cast("timestamp"), "record_hash": record_hash("price")})


def test_versions_never_overlap(spark):
    random.seed(4)
    state, dim = {}, None
    for k in range(1, 5):
        stamp = f"2024-0{k}-01 00:00:00"
        for i in random.sample(range(8), 5):
            state[i] = random.randrange(3)
        rows = sorted(state.items())
        dim = inc.scd2(dim, batch(spark, rows, stamp), "id", stamp)
        dim = sources.materialize(dim, "table", f"dim{k}", sources.work_dir(spark))
        again = inc.scd2(dim, batch(spark, rows, stamp), "id", f"2024-0{k}-02 00:00:00")
        assert again.count() == dim.count()  # the same batch changes nothing
        got = {}
        for r in dim.collect():
            got.setdefault(r.id, []).append(r)
        assert {i: [r.price for r in v if r.is_current] for i, v in got.items()} == {i: [p] for i, p in state.items()}
        for versions in got.values():
            versions.sort(key=lambda r: r.valid_from)
            assert all(a.valid_to == b.valid_from for a, b in zip(versions, versions[1:], strict=False))
        assert dim.select("version_sk").distinct().count() == dim.count()


def test_older_stamp_changes_nothing(spark):
    dim = inc.scd2(None, batch(spark, [(1, 5)], "2024-02-01 00:00:00"), "id", "2024-02-01 00:00:00")
    old = inc.scd2(dim, batch(spark, [(1, 9)], "2024-01-01 00:00:00"), "id", "2024-03-01 00:00:00")
    assert [r.price for r in old.collect()] == [5]


def test_scd3(spark):
    dim = None
    for k, p in ((1, 100), (2, 100), (3, 150)):
        stamp = f"2024-0{k}-01 00:00:00"
        dim = inc.scd2(dim, batch(spark, [(1, p)], stamp), "id", stamp)
    r = inc.scd3(dim, "id").first()
    assert (r.current_price, r.previous_price, r.original_price, r.price_changed, r.price_percent_change) == (150, 100, 100, True, 50.0)


def test_watermark(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, _ingested_at int")
    assert [r.id for r in inc.above_watermark(rows, rows.where("id <= 2")).collect()] == [3]
    assert inc.above_watermark(rows, rows.where("false")).count() == 3


def test_upsert_and_merge(spark):
    a = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    b = spark.createDataFrame([(2, "B", 9), (3, "c", 3)], "k int, v string, w int")
    assert sorted(map(tuple, inc.upsert(a, b, ["k"]).collect())) == [(1, "a", 1), (2, "B", 9), (3, "c", 3)]
    assert sorted(map(tuple, inc.merge(a, b, ["k"], ["v"]).collect())) == [(1, "a", 1), (2, "B", 2), (3, "c", 3)]
    with pytest.raises(ValueError):
        inc.same_schema(a, b.drop("w"))


def test_stream_ingest_reads_a_file_once(spark):
    work = sources.work_dir(spark)
    schema = "id int, name string"
    one = spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1)
    one.write.option("header", True).option("compression", "gzip").csv(f"{work}/in/reviews")
    ingest = lambda: streaming.ingest(spark, f"{work}/in", schema, f"{work}/out", f"{work}/cp")
    count = lambda: spark.read.parquet(f"{work}/out").count()
    ingest()
    assert count() == 2
    ingest()
    assert count() == 2
    one.write.mode("append").option("header", True).option("compression", "gzip").csv(f"{work}/in/reviews")
    ingest()
    assert count() == 4


def test_stream_upsert_keeps_the_newest_row_whenever_it_comes(spark):
    work, schema = sources.work_dir(spark), "k int, v string, at int"
    run = lambda: streaming.upsert_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in"), f"{work}/out", ["k"], f"{work}/cp", [F.desc("at"), F.asc("v")], buckets=4)
    put = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{work}/in")
    read = lambda: sorted((r.k, r.v, r.at) for r in Keyed(spark, f"{work}/out", ["k"]).read().collect())
    put((1, "a", 5), (2, "b", 5), (2, "c", 5), (3, "d", 1))
    run()
    assert read() == [(1, "a", 5), (2, "b", 5), (3, "d", 1)]
    put((1, "late", 4), (3, "new", 2))
    put((4, "x", 1))
    run()
    assert read() == [(1, "a", 5), (2, "b", 5), (3, "new", 2), (4, "x", 1)]


def test_facts_in_batches_are_those_of_one_load(spark):
    random.seed(5)
    rows = [(i, f"2024-01-{d:02d}", random.randrange(50, 99)) for i in range(6) for d in range(1, 29) if random.random() < 0.8]
    days = spark.createDataFrame(rows, "listing_id long, d string, price int").select("listing_id", F.to_date("d").alias("calendar_date"), "price")
    newer = days.where("calendar_date < '2024-01-20'").withColumn("price", F.col("price") + 7)
    batches = [days.where("calendar_date < '2024-01-10' AND listing_id < 4"), newer.where("calendar_date BETWEEN '2024-01-08' AND '2024-01-19' AND listing_id > 1"), days.where("calendar_date = '2024-01-03' AND listing_id = 5"), days.where("calendar_date > '2024-01-21'")]
    facts, held = marts.fct_calendar_daily(batches[0]), {(r.listing_id, r.calendar_date): r.price for r in batches[0].collect()}
    for b in batches[1:]:
        facts = sources.materialize(marts.fct_calendar_incremental(facts, b), "table", "facts", sources.work_dir(spark))
        held |= {(r.listing_id, r.calendar_date): r.price for r in b.collect()}
    want = marts.fct_calendar_daily(spark.createDataFrame([(i, d, p) for (i, d), p in held.items()], "listing_id long, calendar_date date, price int"))
    assert sorted(map(tuple, facts.collect())) == sorted(map(tuple, want.collect()))


def test_loads_are_recorded_and_expire(spark):
    work = sources.work_dir(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    load = lambda d, k, h: loading.load(d, f"{work}/t", f"{work}/m", "t", f"b{k}", f"f{k}", h)
    assert [load(df, 1, "x"), load(df, 1, "x"), load(df.limit(1), 1, "y"), load(df, 2, None), load(df, 2, None)] == ["COMPLETED", "SKIPPED", "COMPLETED", "COMPLETED", "SKIPPED"]
    with pytest.raises(ValueError, match="id"):
        load(df.selectExpr("'x' AS id", "name"), 3, "z")
    rows = loading.read_metrics(spark, f"{work}/m").collect()
    assert sorted((r.batch_id, r.processing_status, r.rows_processed) for r in rows) == [("b1", "COMPLETED", 1), ("b1", "COMPLETED", 2), ("b1", "SKIPPED", 0), ("b2", "COMPLETED", 2), ("b2", "SKIPPED", 0), ("b3", "FAILED", 0)]
    assert all(r.end_time >= r.start_time and r.load_duration_seconds >= 0 for r in rows)
    assert sources.drop_batches(spark, f"{work}/t", spark.createDataFrame([("b1",), ("gone",)], "_batch_id string")) == 1
    assert {r[0]: r[1] for r in sources.batch_counts(spark.read.parquet(f"{work}/t")).collect()} == {"b2": 2}


def test_log_folds_whatever_the_batches(spark):
    log = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "c", 2), (1, "d", 2)], "k int, v string, at int")
    one = inc.upsert_log(inc.latest(log.where("at = 3"), ["k"], F.desc("at")), log.where("at < 3"), ["k"], F.desc("at"))
    assert sorted(map(tuple, one.collect())) == [(1, "b", 3), (2, "c", 2)]


def test_late_rows_are_dropped_and_counted_and_the_state_shrinks(spark):
    work, schema = sources.work_dir(spark), "k long, at timestamp"
    put = lambda ids, day: spark.createDataFrame([(i,) for i in ids], "k long").withColumn("at", F.lit(f"2024-01-{day:02d}").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{work}/in")
    put(range(50), 1)
    put([0, 1, 50], 1)  # two again, while they are held
    put([60], 20)
    put([61], 20)  # a trigger judges by the watermark of the one before
    put([70, 71], 2)  # behind it
    put([62], 20)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    query = streaming.run(streaming.dedup_stream(stream, ["k"], "at", "2 days"), lambda b, n: b.write.mode("overwrite").parquet(f"{work}/out/n={n}"), f"{work}/cp")
    seen = streaming.progress(query)
    assert sum(p["late"] for p in seen) == 2 and sum(p["repeated"] for p in seen) == 2
    assert max(p["held"] for p in seen) >= 51 and seen[-1]["held"] <= 3
    assert sorted(r.k for r in spark.read.parquet(f"{work}/out").collect()) == [*range(51), 60, 61, 62]
