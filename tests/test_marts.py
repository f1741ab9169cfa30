import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from lodestay.operators import marts


def calendar(spark, taken, days=12, gaps=()):
    rows = [(1, date(2024, 1, 1) + timedelta(i), i not in taken, 10.0 + i) for i in range(days) if i not in gaps]
    return spark.createDataFrame(rows, "listing_id long, calendar_date date, is_available boolean, price double").withColumn("price", F.col("price").cast("decimal(12,2)"))


def runs(df):
    return [r.nights for r in marts.stays(df).orderBy("check_in_date").collect()]


def test_runs_of_taken_days(spark):
    assert runs(marts.booking_sequences(calendar(spark, {0, 2, 3, 5, 6, 7}))) == [1, 2, 3]
    assert runs(marts.booking_sequences(calendar(spark, set(range(7))))) == [7]
    assert runs(marts.booking_sequences(calendar(spark, {4, 5, 7, 8}, gaps={6}))) == [2, 2]  # a missing date ends a run
    assert runs(marts.booking_sequences(calendar(spark, {0, 2, 3, 5}), "as_written")) == [4]


def test_stay_metrics(spark):
    m = marts.stay_metrics(marts.stays(marts.booking_sequences(calendar(spark, {0, 2, 3, 5, 6, 7})))).first()
    assert (m.one_night_bookings, m.two_night_bookings, m.three_to_six_night_bookings, m.seven_plus_night_bookings) == (1, 1, 1, 0)
    assert m.median_nights == 2 and m.alos == 2 and float(m.total_booking_value) == 10 + 12 + 13 + 15 + 16 + 17


def test_no_revenue_is_reached(spark):
    df = spark.createDataFrame([(0, 0, 0, 0), (5, 5, 0, 0), (0, 0, 0, 3)], "one_night_revenue int, two_night_revenue int, three_to_six_night_revenue int, seven_plus_night_revenue int")
    assert [r[0] for r in df.select(marts.most_valuable_stay()).collect()] == ["No Revenue", "1 Night", "7+ Nights"]
    assert df.select(marts.most_valuable_stay(as_written=True)).first()[0] == "1 Night"


def test_elasticity_edges(spark):
    df = spark.createDataFrame([(1.6,), (1.5,), (0.5,), (-0.5,), (-0.6,), (None,)], "price_elasticity double")
    assert [r[0] for r in df.select(marts.elasticity_category()).collect()] == ["Highly Elastic", "Elastic", "Elastic", "Inelastic", "Abnormal Response", "Insufficient Data"]


def test_reviews_do_not_multiply_days(spark):
    listings = spark.createDataFrame([(1, 7, "h")], "listing_id long, host_id long, host_name string")
    cal = calendar(spark, {0, 1})
    reviews = spark.createDataFrame([(1, date(2024, 1, 5), 1, "positive", 3), (1, date(2024, 1, 6), 2, "neutral", 5)], "listing_id long, review_date date, review_id long, sentiment string, review_length int")
    once = marts.host_performance(listings, cal, reviews).first()
    assert (once.total_days, once.booked_days, once.review_count, once.positive_review_percentage) == (12, 2, 2, 50.0)
    assert marts.host_performance(listings, cal, reviews, "as_written").first().total_days == 24


def test_every_day_meets_every_review_without_such_rows(spark):
    rng = random.Random(3)
    listings = spark.createDataFrame([(i, i // 2, f"h{i // 2}") for i in range(5)] + [(4, None, None)], "listing_id long, host_id long, host_name string")
    days = [(i, date(2024, m, d) if d else None, rng.random() < 0.5, rng.choice([None, 10, 20])) for i in range(6) for m in (1, 2) for d in rng.sample(range(29), 6)]
    cal = spark.createDataFrame(days, "listing_id long, calendar_date date, is_available boolean, price int").withColumn("price", F.col("price").cast("decimal(12,2)"))
    held = [(rng.randrange(6), date(2024, rng.choice([1, 2, 3]), 5), rng.randrange(9), rng.choice(["positive", "neutral"]), rng.choice([None, 3, 8])) for _ in range(60)]
    reviews = spark.createDataFrame(held, "listing_id long, review_date date, review_id long, sentiment string, review_length int")
    pairs = cal.alias("c").join(reviews.alias("r"), (F.col("c.listing_id") == F.col("r.listing_id")) & (F.trunc("calendar_date", "month") == F.trunc("review_date", "month")), "left").join(listings.alias("l"), F.col("c.listing_id") == F.col("l.listing_id"))
    want = pairs.groupBy("host_id", "host_name", F.trunc("calendar_date", "month").alias("month_date")).agg(
        F.countDistinct("l.listing_id"), F.count_if(~F.col("is_available")), F.count("*"), F.sum(F.when(~F.col("is_available"), F.col("price")).otherwise(0)), F.avg("price").cast("double"), F.countDistinct("review_id"), F.avg("review_length")
    )
    got = marts.host_performance(listings, cal, reviews, "as_written")
    show = lambda df: sorted([tuple(None if v is None else v if hasattr(v, "year") or isinstance(v, str) else round(float(v), 6) for v in r) for r in df.collect()], key=repr)
    shown = ("host_id", "host_name", "month_date", "active_listings", "booked_days", "total_days", "estimated_revenue", "average_daily_rate", "review_count", "avg_review_length")
    assert show(got.select(*shown)) == show(want)


def test_listing_without_reviews(spark):
    dim = spark.createDataFrame([(1, "n", 7, "h", "x", "p", "r", 5.0)], "listing_id long, listing_name string, host_id long, host_name string, neighbourhood_cleansed string, property_type string, room_type string, price double")
    none = spark.createDataFrame([], "listing_id long, review_date date, review_id long, sentiment string, review_length int")
    out = marts.review_metrics(dim, none).first()
    assert (out.review_count, out.review_rating_category, out.positive_review_percentage) == (0, "No Reviews", 0.0)


def test_opportunities_compute_the_listings_once(spark):
    from lodestay import sources
    from lodestay.operators import analyses

    source = sources.work_dir(spark)
    rows = [(i, f"l{i}", "Loft", "Room", "Asia", 4.0, float(i), 20.0 if i == 3 else 1.0, "2 Nights", i * 4, 80.0 if i == 5 else 50.0, 90.0) for i in range(8)]
    spark.createDataFrame(rows, list(analyses.ECONOMICS)).write.parquet(source)
    out = analyses.optimization_opportunities(spark.read.parquet(source))
    assert not any(source in f for f in out.inputFiles())  # average, order and result read what was written once
    got = [(r.listing_id, r.optimization_opportunity) for r in out.collect()]
    no = "No major optimization needed"
    assert got == [(3, "High cancellation rate"), (5, "Extend min nights requirement"), (2, "Increase min nights"), (4, no), (6, no), (7, no)]


def test_reviews_meet_dealt_days_without_an_exchange(spark):
    from lodestay import sources
    from lodestay.operators import marts

    d = sources.work_dir(spark)
    spark.sql("SELECT id % 20 AS listing_id, date_add(date '2024-01-01', CAST(id / 20 AS INT)) AS calendar_date, id % 3 = 0 AS is_available, CAST(id % 90 AS decimal(10,2)) AS price FROM range(2000)").write.parquet(f"{d}/days")
    spark.sql("SELECT id % 23 AS listing_id, date_add(date '2024-01-01', CAST(id % 150 AS INT)) AS review_date, id % 400 AS review_id, if(id % 2 = 0, 'positive', 'neutral') AS sentiment, CAST(id % 50 AS INT) AS review_length FROM range(500)").write.parquet(f"{d}/held")
    days, held = spark.read.parquet(f"{d}/days"), spark.read.parquet(f"{d}/held")
    # listing 3 is there twice, 4 at two hosts
    listings = spark.createDataFrame([(i, i % 4, f"h{i % 4}") for i in (*range(18), 3)] + [(4, 9, None)], "listing_id long, host_id long, host_name string")
    deal = lambda df: df.repartition(6, "listing_id")
    for mode in ("deduplicated", "as_written"):
        plain = marts.host_performance(listings, days, held, mode)
        dealt = marts.host_performance(listings, deal(days), held, mode, deal)
        assert dealt.dtypes == plain.dtypes
        assert sorted(map(tuple, dealt.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    first = marts.host_performance(listings, days, held).where("host_id = 3 AND month_date = date '2024-01-01'").first()
    assert first.active_listings == 4 and first.total_days == 5 * 31  # 3 (twice), 7, 11, 15
    plan = marts.host_performance(listings, deal(days), held, deal=deal)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(listing_id" in line and "REPARTITION" not in line]
