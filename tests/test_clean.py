from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from lodestay import functions as fn
from lodestay.operators import clean


def values(df, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()]


def test_money_percent_flag(spark):
    df = spark.createDataFrame([("$1,234.50",), ("",), (None,), ("-5",), ("abc",)], "s string")
    assert values(df, fn.money("s")) == [Decimal("1234.50"), None, None, Decimal("-5.00"), None]
    df = spark.createDataFrame([("95%",), ("N/A",), ("",), ("95",), ("100%",), (None,)], "s string")
    assert values(df, fn.percent("s")) == [Decimal("95.00"), None, None, None, Decimal("100.00"), None]
    df = spark.createDataFrame([("t",), ("f",), ("x",), (None,)], "s string")
    assert values(df, fn.flag("s")) == [True, False, None, None]


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-29",), ("02/29/2024",), ("31/31/2024",), ("2024-02-30",), ("soon",), (None,)], "s string")
    assert values(df, fn.day("s")) == [date(2024, 2, 29), date(2024, 2, 29), None, None, None, None]


def test_rounding_ties_go_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.00499999999,), (None,)], "x double")
    assert values(df, fn.rounded("x", 0)) == [3.0, -2.0, 1.0, None]
    assert values(df.limit(3), fn.rounded("x", 2))[2] == 1.01


def test_location_rules(spark):
    places = {"Berlin, Germany": ("Berlin", "Germany"), "Bonn, Germany": ("Bonn", "Germany"), "Lyon, France": ("Lyon", "France"), "Leeds, UK": ("Leeds", "United Kingdom"), "York, United Kingdom": ("York", "United Kingdom"), "Austin, USA": ("Austin", "United States"), "Graz, Austria": ("Graz", "Austria"), "Cadiz, Spain": ("Cadiz", "Spain"), "Rome, Italy": ("Rome", "Italy"), "Oslo, Viken, Norway": ("Oslo", "Norway"), "Peru": (None, "Peru"), None: (None, None)}
    df = spark.createDataFrame([(p,) for p in places], "host_location string")
    assert values(df, clean.host_city(), clean.host_country()) == list(places.values())


def test_quality_score_branches(spark):
    rows = [("within an hour", "95%", "85%", "excellent"), ("within a day", "95%", "85%", "good"), ("within a few days", "95%", "85%", "average"), (None, "20%", None, "below_average"), (None, "N/A", "99%", None), ("within an hour", "75%", "N/A", "average")]
    df = spark.createDataFrame([r[:3] for r in rows], "host_response_time string, host_response_rate string, host_acceptance_rate string")
    assert values(df, clean.quality_score()) == [r[3] for r in rows]


def test_listing_quality_first_rule_wins(spark):
    rows = [(None, None, "x", 2, 1, 5, "missing_listing_id"), (1, None, "x", 2, 1, 5, "missing_listing_name"), (1, "n", "abc", 2, 1, 5, "invalid_price"), (1, "n", "-5.00", 2, 1, 5, "negative_price"), (1, "n", "5", 0, 1, 5, "invalid_accommodates"), (1, "n", "5", 2, -1, 5, "negative_minimum_nights"), (1, "n", "5", 2, 9, 5, "invalid_maximum_nights"), (1, "n", "5", 2, 1, 5, "valid")]
    df = spark.createDataFrame([r[:6] for r in rows], "listing_id long, listing_name string, price_raw string, accommodates int, minimum_nights int, maximum_nights int")
    assert values(df, clean.listing_quality()) == [r[6] for r in rows]


def test_sentiment(spark):
    df = spark.createDataFrame([("GREAT stay",), ("bad bed",), ("great but bad",), ("fine",), (None,)], "review_text string")
    assert values(df, clean.sentiment()) == ["positive", "negative", "positive", "neutral", "neutral"]


def test_optional_stamp_and_stable_hash(spark):
    raw = spark.createDataFrame([(1, 2, 3, "a", "2024-01-01", None)], "id long, listing_id long, reviewer_id long, reviewer_name string, date string, comments string")
    staged = clean.stg_reviews(raw, F.lit("2024-01-01").cast("timestamp"))
    assert "_ingested_at" in staged.columns
    assert values(staged, "record_hash") == values(clean.stg_reviews(raw), "record_hash")
