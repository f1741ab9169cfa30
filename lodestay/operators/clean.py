"""Staging and cleaning of listings, reviews and calendar days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestay.functions import column_or, contains_any, day, day_of_week, flag, money, percent, record_hash, whole_number

#: Fixed values.
COUNTRIES = {", Germany": "Germany", ", France": "France", ", United Kingdom": "United Kingdom", ", UK": "United Kingdom", ", United States": "United States", ", USA": "United States", ", Austria": "Austria", ", Spain": "Spain", ", Italy": "Italy"}
RESPONSE_TIMES = {"within an hour": ("within_hour", 1), "within a hour": ("within_hour", 1), "within a few hours": ("within_few_hours", 3), "within few hours": ("within_few_hours", 3), "within a day": ("within_day", 24), "within a few days": ("within_few_days", 72), "within few days": ("within_few_days", 72)}
QUICK = [t for t, (_, h) in RESPONSE_TIMES.items() if h <= 3]
SAME_DAY = [t for t, (_, h) in RESPONSE_TIMES.items() if h <= 24]
POSITIVE = ("excellent", "great", "fantastic", "amazing", "wonderful", "perfect")
NEGATIVE = ("bad", "terrible", "poor", "awful", "horrible")
HOST_COUNTS = ("calculated_host_listings_count", *(f"calculated_host_listings_count_{k}" for k in ("entire_homes", "private_rooms", "shared_rooms")))
NUMBER = r"^[0-9]*\.?[0-9]+$"
SIGNED_NUMBER = r"^-?[0-9]*\.?[0-9]+$"


def digits(c: str) -> Column:
    s = F.col(c).cast("string")
    return F.when(s.rlike("^[0-9]+$"), s)


def truth(c: str) -> Column:
    return F.when(F.col(c) == "t", "true").when(F.col(c) == "f", "false")


def stg_listings(raw: DataFrame) -> DataFrame:
    bare = F.translate("price", "$,", "")
    numbers = ("host_listings_count", "accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights", *HOST_COUNTS)
    return raw.select(
        F.col("id").try_cast("bigint").alias("listing_id"),
        F.col("host_id").try_cast("bigint").alias("host_id"),
        F.col("name").alias("listing_name"),
        *("host_name", "host_since", "host_location", "host_response_time", "host_response_rate", "host_acceptance_rate"),
        (F.col("host_is_superhost") == "t").alias("host_is_superhost"),
        "neighbourhood_cleansed",
        *[F.col(c).try_cast("decimal(10,6)").alias(c) for c in ("latitude", "longitude")],
        *[F.trim(c).alias(c) for c in ("property_type", "room_type")],
        *[F.col(c).try_cast("int").alias(c) for c in numbers],
        *("bathrooms_text", "amenities", "license"),
        bare.alias("price_raw"),
        (F.col("instant_bookable") == "t").alias("instant_bookable"),
        F.col("last_scraped").try_cast("timestamp").alias("last_scraped"),
        "_ingested_at",
        record_hash(
            F.when(bare.rlike(NUMBER), bare),
            *[digits(c) for c in ("minimum_nights", "maximum_nights")],
            truth("host_is_superhost"),
            digits("host_listings_count"),
            "room_type",
            digits("accommodates"),
            "bathrooms_text",
            *[digits(c) for c in ("bedrooms", "beds")],
            *("amenities", "license"),
            truth("instant_bookable"),
        ).alias("record_hash"),
    )


def stg_reviews(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    return raw.select(
        F.col("id").alias("review_id"),
        *("listing_id", "reviewer_id", "reviewer_name"),
        F.col("date").alias("review_date"),
        F.col("comments").alias("review_text"),
        column_or(raw, "_ingested_at", F.current_timestamp() if ingested_at is None else ingested_at),
        record_hash("id", "listing_id", "date", "comments").alias("record_hash"),
        *[c for c in ("parsed_length", "parsed_sentiment") if c in raw.columns],
    )


def calendar_texts() -> dict[str, Column]:
    """What the texts of a calendar row say. A source that repeats texts over many days may have these columns, and the day as
    parsed_date, from the start; they are taken over then."""
    return {"parsed_available": flag("available"), "parsed_price": money("price", 10), "parsed_adjusted": money("adjusted_price", 10)}


def stg_calendar(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    return raw.select(
        "listing_id",
        F.col("date").alias("calendar_date"),
        *("available", "price", "adjusted_price", "minimum_nights", "maximum_nights"),
        column_or(raw, "_ingested_at", F.current_timestamp() if ingested_at is None else ingested_at),
        record_hash("listing_id", "date", "available", "price", "minimum_nights", "maximum_nights").alias("record_hash"),
        *[c for c in (*calendar_texts(), "parsed_date") if c in raw.columns],
    )


def clean_calendar(stg: DataFrame) -> DataFrame:
    d = F.col("parsed_date") if "parsed_date" in stg.columns else F.col("calendar_date").try_cast("date")
    said = {c: F.col(c) if c in stg.columns else e for c, e in calendar_texts().items()}
    return stg.select(
        "listing_id",
        d.alias("calendar_date"),
        said["parsed_available"].alias("is_available"),
        said["parsed_price"].alias("price"),
        said["parsed_adjusted"].alias("adjusted_price"),
        *("minimum_nights", "maximum_nights"),
        day_of_week(d).alias("day_of_week"),
        F.month(d).alias("month_num"),
        F.year(d).alias("year_num"),
        F.coalesce(day_of_week(d).isin(0, 6), F.lit(False)).alias("is_weekend"),
        *("_ingested_at", "record_hash"),
    )


def host_city(location: str = "host_location") -> Column:
    place = F.col(location)
    return F.when(place.contains("Berlin, Germany"), "Berlin").when(place.contains(","), F.trim(F.split_part(place, F.lit(","), F.lit(1))))


def host_country(location: str = "host_location") -> Column:
    place, rule = F.col(location), F
    for ending, country in COUNTRIES.items():
        rule = rule.when(place.contains(ending), country)
    return rule.when(place.contains(","), F.trim(F.split_part(place, F.lit(","), F.lit(-1)))).otherwise(place)


def response_category(c: str = "host_response_time") -> Column:
    rule = F
    for text, (name, _) in RESPONSE_TIMES.items():
        rule = rule.when(F.col(c) == text, name)
    return rule.when(F.col(c).isNotNull(), "other")


def response_hours(c: str = "host_response_time") -> Column:
    rule = F
    for text, (_, hours) in RESPONSE_TIMES.items():
        rule = rule.when(F.col(c) == text, hours)
    return rule.otherwise(F.lit(None).cast("int"))


def quality_score(time: str = "host_response_time", rate: str = "host_response_rate", acceptance: str = "host_acceptance_rate") -> Column:
    answered, accepted = percent(rate), percent(acceptance)
    return (
        F.when((answered >= 90) & F.col(time).isin(QUICK) & (accepted >= 80), "excellent")
        .when((answered >= 70) & F.col(time).isin(SAME_DAY) & (accepted >= 60), "good")
        .when(answered >= 50, "average")
        .when(answered.isNotNull(), "below_average")
    )


def listing_quality() -> Column:
    """The first rule that fails; a negative price is told from text that is no number."""
    price = F.trim("price_raw")
    return (
        F.when(F.col("listing_id").isNull(), "missing_listing_id")
        .when(F.col("listing_name").isNull(), "missing_listing_name")
        .when(price.isNull() | ~price.rlike(SIGNED_NUMBER), "invalid_price")
        .when(price.try_cast("decimal(12,2)") < 0, "negative_price")
        .when(F.col("accommodates").isNull() | (F.col("accommodates") <= 0) | (F.col("accommodates") >= 50), "invalid_accommodates")
        .when(F.col("minimum_nights") < 0, "negative_minimum_nights")
        .when(F.col("maximum_nights") < F.col("minimum_nights"), "invalid_maximum_nights")
        .otherwise("valid")
    )


def clean_listings(stg: DataFrame) -> DataFrame:
    price = F.trim("price_raw")
    return stg.select(
        *("listing_id", "host_id", "listing_name", "host_name"),
        host_city().alias("host_city"),
        host_country().alias("host_country"),
        day("host_since").alias("host_since"),
        response_category().alias("host_response_time_category"),
        response_hours().alias("host_response_time_hours"),
        percent("host_response_rate").alias("host_response_rate_pct"),
        percent("host_acceptance_rate").alias("host_acceptance_rate_pct"),
        quality_score().alias("host_quality_score"),
        *("host_is_superhost", "host_listings_count", "neighbourhood_cleansed", "latitude", "longitude", "property_type", "room_type", "accommodates", "bathrooms_text", "bedrooms", "beds", "amenities"),
        F.when(price.rlike(NUMBER), price.try_cast("decimal(10,2)")).alias("price"),
        *("minimum_nights", "maximum_nights", "license", "instant_bookable", *HOST_COUNTS, "last_scraped", "_ingested_at", "record_hash"),
        listing_quality().alias("data_quality_check"),
    )


def sentiment(text: str = "review_text", positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE, lowered: bool = False) -> Column:
    return F.when(contains_any(text, positive, lowered), "positive").when(contains_any(text, negative, lowered), "negative").otherwise("neutral")


def review_quality() -> Column:
    return (
        F.when(F.col("review_id").isNull(), "missing_review_id")
        .when(F.col("listing_id").isNull(), "missing_listing_id")
        .when(F.col("review_date").isNull(), "invalid_date_format")
        .when(F.col("review_length") == 0, "empty_review_text")
        .otherwise("valid")
    )


def review_texts(df: DataFrame, text: str, positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE) -> DataFrame:
    """The length without blanks around it and the sentiment of a text. A source in which many reviews share a text may have these
    columns from the start; clean_reviews() takes them over then."""
    # a column of its own, so that a long text is put into lower case once and not for every word
    low = df.withColumn("__low", F.lower(text))
    return low.withColumns({"parsed_length": F.char_length(F.trim(text)), "parsed_sentiment": sentiment("__low", positive, negative, lowered=True)}).drop("__low")


def clean_reviews(stg: DataFrame, positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE) -> DataFrame:
    read = stg if "parsed_sentiment" in stg.columns else review_texts(stg, "review_text", positive, negative)
    cleaned = read.select(
        *[whole_number(c).alias(c) for c in ("review_id", "listing_id", "reviewer_id")],
        F.trim("reviewer_name").alias("reviewer_name"),
        day("review_date").alias("review_date"),
        F.trim("review_text").alias("review_text"),
        F.col("parsed_length").alias("review_length"),
        F.coalesce("parsed_sentiment", F.lit("neutral")).alias("sentiment"),  # a review without a text
        *("_ingested_at", "record_hash"),
    )
    return cleaned.withColumn("data_quality_check", review_quality())
