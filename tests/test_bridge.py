"""The calendar that is made from shipments, at its edges."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lodestay import sources
from lodestay.plans import bridge

duckdb = pytest.importorskip("duckdb")


def put(spark, d, suppliers, items):
    spark.createDataFrame(suppliers, "s_suppkey long").coalesce(1).write.parquet(f"{d}/supplier.parquet")
    rows = [(k, day and datetime(2024, 1, 1) + timedelta(day - 1, 3600), p) for k, day, p in items]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double").coalesce(1).write.parquet(f"{d}/lineitem.parquet")


def both(spark, d):
    con = duckdb.connect()
    for t in ("supplier", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d.removeprefix('file://')}/{t}.parquet/*.parquet')")
    shown = ["listing_id", "date", "available", "price", "adjusted_price", "minimum_nights", "maximum_nights"]
    got = bridge.raw_calendar(spark, d).select(*[F.coalesce("price", F.lit("$")) if c == "price" else c for c in shown]).collect()  # DuckDB's concat leaves nulls out
    want = con.execute(f"SELECT {', '.join(shown)} FROM ({bridge.CALENDAR_SQL})").fetchall()
    return sorted(map(tuple, got), key=repr), sorted(want, key=repr)


def test_every_supplier_has_every_day(spark):
    d = sources.work_dir(spark)
    # 1: shipped on the first and the last day; 2: none; 3: a day without a price, one without a date; 4: twice in the table; 9: no supplier
    put(spark, d, [(1,), (2,), (3,), (4,), (4,), (None,)], [(1, 1, 10.0), (1, 1, 12.5), (1, 30, 9.0), (3, 7, None), (3, 8, 4.0), (3, None, 1.0), (4, 5, 3.0), (4, 6, 2.0), (9, 40, 5.0), (None, 3, 6.0)])
    got, want = both(spark, d)
    assert got == want and len(got) == 6 * 40


def test_no_shipments_no_days(spark):
    d = sources.work_dir(spark)
    put(spark, d, [(1,)], [])
    got, want = both(spark, d)
    assert got == want == []


def test_tasks_follow_the_days_and_one_exchange_serves_all(spark, monkeypatch):
    d = sources.work_dir(spark)
    put(spark, d, [(i,) for i in range(50)], [(i % 50, i % 40 + 1, 5.0) for i in range(400)])
    monkeypatch.setattr(bridge, "ROWS", 100)
    df = bridge.raw_calendar(spark, d)
    assert df.rdd.getNumPartitions() == 50 * 40 // 100
    plan = df.groupBy("listing_id", F.substring("date", 1, 7)).count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_texts_of_reviews_are_dealt_by_document(spark, monkeypatch):
    d = sources.work_dir(spark)
    tables = {
        "documents": ([(i, f"text {i} " * 200) for i in range(20)], "doc_id long, text string"),
        "orders": ([(k, k % 7, datetime(2024, 1, 1)) for k in range(2000)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": ([(k, k % 5) for k in range(2000)], "l_orderkey long, l_suppkey long"),
        "customer": ([(k, f"c{k}") for k in range(7)], "c_custkey long, c_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    monkeypatch.setattr(bridge, "TEXTS", 200)
    df = bridge.raw_reviews(spark, d)
    assert df.rdd.getNumPartitions() == 10
    got = df.select("id", "comments", F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
    assert {r.id: r.comments for r in got} == {k: f"text {k % 20} " * 200 for k in range(2000)}
    assert sum(a.comments != b.comments for a, b in zip(got, got[1:], strict=False)) == 19  # equal texts side by side


def test_texts_of_days_are_parsed_once_a_stretch(spark):
    from lodestay.operators import clean

    d = sources.work_dir(spark)
    put(spark, d, [(1,), (2,), (4,), (4,)], [(1, 1, 10.0), (1, 30, 1234567890.0), (4, 5, None), (4, 6, 2.0), (2, 7, 3.5)])
    each = clean.clean_calendar(clean.stg_calendar(bridge.raw_calendar(spark, d)))
    once = clean.clean_calendar(clean.stg_calendar(bridge.raw_calendar(spark, d, clean.calendar_texts())))
    assert once.dtypes == each.dtypes
    got = sorted(map(tuple, once.collect()), key=repr)
    assert got == sorted(map(tuple, each.collect()), key=repr) and len(got) == 4 * 30
    plan = once.select("price", "is_available", "calendar_date")._jdf.queryExecution().optimizedPlan().toString()
    days = plan.index("Generate explode")  # parents come first
    assert "translate" not in plan[:days] and "translate" in plan[days:]


def test_texts_of_reviews_are_read_once_a_document(spark):
    from lodestay.operators import clean

    d, words = sources.work_dir(spark), (("good",), ("bad",))
    tables = {
        "documents": ([(0, " Good "), (1, "so BAD"), (2, "  "), (3, None), (9, "never met")], "doc_id long, text string"),
        "orders": ([(k, k % 7, datetime(2024, 1, 1)) for k in range(200)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": ([(k, k % 5) for k in range(200)], "l_orderkey long, l_suppkey long"),
        "customer": ([(k, f"c{k}") for k in range(7)], "c_custkey long, c_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    each = clean.clean_reviews(clean.stg_reviews(bridge.raw_reviews(spark, d)), *words)
    once = clean.clean_reviews(clean.stg_reviews(bridge.raw_reviews(spark, d, lambda t: clean.review_texts(t, "text", *words))), *words)
    assert once.dtypes == each.dtypes
    got = sorted(map(tuple, once.collect()), key=repr)
    assert got == sorted(map(tuple, each.collect()), key=repr) and len(got) == 200  # order 4, 9, ... has no document
    plan = once.select("review_length", "sentiment", "data_quality_check")._jdf.queryExecution().optimizedPlan().toString()
    met = plan.index("Join LeftOuter")
    assert "lower(" not in plan[:met] and "lower(" in plan[met:]


def test_bookings_are_dealt_by_listing(spark, monkeypatch):
    from lodestay.operators import marts

    d = sources.work_dir(spark)
    spark.createDataFrame([(k, datetime(2024, 1, 1)) for k in range(200)], "o_orderkey long, o_orderdate timestamp_ntz").coalesce(1).write.parquet(f"{d}/orders.parquet")
    items = [(k % 200, k % 50, datetime(2024, 1, 1) + timedelta(k % 90), "R" if k % 3 else "N") for k in range(1000)]
    spark.createDataFrame(items, "l_orderkey long, l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string").coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    monkeypatch.setattr(bridge, "ROWS", 100)
    leads = marts.lead_times(bridge.bookings(spark, d))
    assert leads.rdd.getNumPartitions() == 10  # grouped where they were dealt, whatever the session's number
    assert sum(r.total_bookings_with_lead_time for r in leads.collect()) == 1000
    assert marts.cancellations(bridge.bookings(spark, d, 7)).rdd.getNumPartitions() == 7
