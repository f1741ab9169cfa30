"""Cleaning, facts, marts and analyses over the bridged entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.operators import analyses, clean, marts
from lodestay.plans import bridge
from lodestay.plans.warehouse import Warehouse
from lodestay.queries import Registry, b, flat, r
from lodestay.sources import work_dir
from lodestay.sources.keyed import Keyed

AS_OF = "2001-06-30"
HOST = 7


# Layers, as frames.


def listings(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_listings(clean.stg_listings(bridge.raw_listings(spark, d)))


def calendar(spark: SparkSession, d: str, over: bridge.Span | None = None) -> DataFrame:
    """Texts are parsed once a stretch of days."""
    return marts.fct_calendar_daily(clean.clean_calendar(clean.stg_calendar(bridge.raw_calendar(spark, d, clean.calendar_texts(), over))))


def cleaned_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Texts are read once a document."""
    words = (bridge.POSITIVE, bridge.NEGATIVE)
    return clean.clean_reviews(clean.stg_reviews(bridge.raw_reviews(spark, d, lambda documents: clean.review_texts(documents, "text", *words))), *words)


def reviews(spark: SparkSession, d: str) -> DataFrame:
    return marts.fct_reviews(cleaned_reviews(spark, d))


def economics(spark: SparkSession, d: str) -> DataFrame:
    over = bridge.span(spark, d)
    booked = bridge.bookings(spark, d, over.tasks)
    stays = marts.stay_metrics(marts.stays(marts.booking_sequences(calendar(spark, d, over))))
    return marts.booking_economics(listings(spark, d), stays, marts.lead_times(booked), marts.cancellations(booked))


def months(spark: SparkSession, d: str) -> DataFrame:
    return marts.listing_months(calendar(spark, d), AS_OF)


def finance(spark: SparkSession, d: str) -> DataFrame:
    return marts.financial_performance(months(spark, d), listings(spark, d))


def hosts(spark: SparkSession, d: str, mode: str = "deduplicated") -> DataFrame:
    over = bridge.span(spark, d)
    return marts.host_performance(listings(spark, d), calendar(spark, d, over), reviews(spark, d), mode, lambda df: df.repartition(over.tasks, "listing_id"))


# The same layers in SQL.

NUM = "'^[0-9]*\\.?[0-9]+$'"


def _pct(c: str) -> str:
    return f"CASE WHEN contains({c}, '%') AND regexp_matches(replace({c}, '%', ''), '^[0-9]+(\\.[0-9]+)?$') THEN replace({c}, '%', '')::DECIMAL(5,2) END"


def _day(c: str) -> str:
    return f"coalesce(CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN try_cast({c} AS DATE) END, CASE WHEN regexp_matches({c}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') THEN try_strptime({c}, '%m/%d/%Y')::DATE END)"


def _money(c: str) -> str:
    return f"try_cast(nullif(regexp_replace(trim({c}), '[$,]', '', 'g'), '') AS DECIMAL(12,2))"


def _hash(*cs: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(({c})::VARCHAR, '')" for c in cs) + "))"


def _digits(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}::VARCHAR, '^[0-9]+$') THEN {c}::VARCHAR END"


def _truth(c: str) -> str:
    return f"CASE {c} WHEN 't' THEN 'true' WHEN 'f' THEN 'false' END"


BARE = "regexp_replace(price, '[$,]', '', 'g')"
_rate, _acc = _pct("host_response_rate"), _pct("host_acceptance_rate")
_hour, _days = "('within an hour','within a hour','within a few hours','within few hours')", "('within an hour','within a hour','within a few hours','within few hours','within a day')"
COUNTRY = "CASE " + " ".join(f"WHEN contains(host_location, '{k}') THEN '{v}'" for k, v in clean.COUNTRIES.items()) + " WHEN contains(host_location, ',') THEN trim(string_split(host_location, ',')[-1]) ELSE host_location END"
CITY = "CASE WHEN contains(host_location, 'Berlin, Germany') THEN 'Berlin' WHEN contains(host_location, ',') THEN trim(string_split(host_location, ',')[1]) END"
CATEGORY = "CASE " + " ".join(f"WHEN host_response_time = '{t}' THEN '{n}'" for t, (n, _) in clean.RESPONSE_TIMES.items()) + " WHEN host_response_time IS NOT NULL THEN 'other' END"
HOURS = "CASE " + " ".join(f"WHEN host_response_time = '{t}' THEN {h}" for t, (_, h) in clean.RESPONSE_TIMES.items()) + " END"
SCORE = f"CASE WHEN {_rate} >= 90 AND host_response_time IN {_hour} AND {_acc} >= 80 THEN 'excellent' WHEN {_rate} >= 70 AND host_response_time IN {_days} AND {_acc} >= 60 THEN 'good' WHEN {_rate} >= 50 THEN 'average' WHEN {_rate} IS NOT NULL THEN 'below_average' END"
QUALITY = f"""CASE WHEN id IS NULL THEN 'missing_listing_id' WHEN name IS NULL THEN 'missing_listing_name' WHEN price IS NULL OR NOT regexp_matches(trim({BARE}), '^-?[0-9]*\\.?[0-9]+$') THEN 'invalid_price'
  WHEN try_cast(trim({BARE}) AS DECIMAL(12,2)) < 0 THEN 'negative_price' WHEN accommodates IS NULL OR accommodates <= 0 OR accommodates >= 50 THEN 'invalid_accommodates'
  WHEN minimum_nights < 0 THEN 'negative_minimum_nights' WHEN maximum_nights < minimum_nights THEN 'invalid_maximum_nights' ELSE 'valid' END"""
LISTING_HASH = _hash(f"CASE WHEN regexp_matches({BARE}, {NUM}) THEN {BARE} END", _digits("minimum_nights"), _digits("maximum_nights"), _truth("host_is_superhost"), _digits("host_listings_count"), "room_type", _digits("accommodates"), "bathrooms_text", _digits("bedrooms"), _digits("beds"), "amenities", "license", _truth("instant_bookable"))


def _like(c: str, ws: tuple[str, ...]) -> str:
    return "coalesce(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in ws) + ", FALSE)"


SENTIMENT = f"CASE WHEN {_like('comments', bridge.POSITIVE)} THEN 'positive' WHEN {_like('comments', bridge.NEGATIVE)} THEN 'negative' ELSE 'neutral' END"
STAY_SQL = {"one_night": "nights = 1", "two_night": "nights = 2", "three_to_six_night": "nights BETWEEN 3 AND 6", "seven_plus_night": "nights >= 7"}
LEAD_SQL = {"last_minute": "l <= 7", "short_lead": "l BETWEEN 8 AND 30", "medium_lead": "l BETWEEN 31 AND 90", "long_lead": "l > 90"}


def _count(c: str) -> str:
    return f"count(*) FILTER ({c})"


def _sum(c: str, x: str) -> str:
    return f"coalesce(sum({x}) FILTER ({c}), 0)"


def _mean(x: str) -> str:
    return f"sum({x})::DOUBLE / count({x})"


def _ratio(a: str, c: str, scale: str = "1.0") -> str:
    return f"({a})::DOUBLE / nullif(({c})::DOUBLE, 0) * {scale}::DOUBLE"


_z = lambda c: f"coalesce({c}, 0)"
LAYERS = f"""WITH raw_listings AS ({bridge.LISTINGS_SQL}), raw_calendar AS ({bridge.CALENDAR_SQL}), raw_reviews AS ({bridge.REVIEWS_SQL}), booked AS ({bridge.BOOKINGS_SQL}),
li AS (SELECT id AS listing_id, name AS listing_name, host_id, host_name, neighbourhood_cleansed, trim(property_type) AS property_type, trim(room_type) AS room_type, accommodates,
  CASE WHEN regexp_matches(trim({BARE}), {NUM}) THEN try_cast(trim({BARE}) AS DECIMAL(10,2)) END AS price FROM raw_listings),
cal AS (SELECT listing_id, date::DATE AS calendar_date, available = 't' AS is_available, {_money("price")} AS price, {_money("adjusted_price")} AS adjusted_price, minimum_nights, maximum_nights, date_part('dow', date::DATE)::INT AS day_of_week,
  month(date::DATE)::INT AS month_num, year(date::DATE)::INT AS year_num, date_part('dow', date::DATE) IN (0, 6) AS is_weekend, {_hash("listing_id", "date", "available", "price", "minimum_nights", "maximum_nights")} AS record_hash FROM raw_calendar),
fct AS (SELECT *, CASE WHEN lag(price) OVER w IS NOT NULL THEN price - lag(price) OVER w ELSE 0 END AS price_change_from_previous_day FROM cal WINDOW w AS (PARTITION BY listing_id ORDER BY calendar_date)),
rc AS (SELECT id AS review_id, listing_id, reviewer_id, trim(reviewer_name) AS reviewer_name, {_day("date")} AS review_date, trim(comments) AS review_text, length(trim(comments))::INT AS review_length, {SENTIMENT} AS sentiment,
  {_hash("id", "listing_id", "date", "comments")} AS record_hash FROM raw_reviews),
rq AS (SELECT *, CASE WHEN review_id IS NULL THEN 'missing_review_id' WHEN listing_id IS NULL THEN 'missing_listing_id' WHEN review_date IS NULL THEN 'invalid_date_format' WHEN review_text = '' THEN 'empty_review_text' ELSE 'valid' END AS data_quality_check FROM rc),
rv AS (SELECT * FROM rq WHERE data_quality_check = 'valid'),
runs AS (SELECT listing_id, calendar_date, price, is_available, CASE WHEN NOT is_available AND coalesce(lag(is_available) OVER w, TRUE) THEN 1 ELSE 0 END AS new_sequence_flag FROM fct WINDOW w AS (PARTITION BY listing_id ORDER BY calendar_date)),
seq AS (SELECT * FROM (SELECT *, sum(new_sequence_flag) OVER (PARTITION BY listing_id ORDER BY calendar_date ROWS UNBOUNDED PRECEDING) AS booking_sequence_id FROM runs) WHERE NOT is_available),
stay AS (SELECT listing_id, booking_sequence_id, min(calendar_date) AS check_in_date, max(calendar_date) AS check_out_date, count(*) AS nights, sum(price) AS v FROM seq GROUP BY ALL),
sm AS (SELECT listing_id, {_mean("nights")} AS alos, min(nights) AS min_nights, max(nights) AS max_nights, quantile_cont(nights, 0.5) AS median_nights, {_mean("v")} AS avg_booking_value, max(v) AS max_booking_value, min(v) AS min_booking_value, sum(v) AS total_booking_value, count(*) AS total_bookings,
  {', '.join(f"{_count(c)} AS {k}_bookings, {_sum(c, 'v')} AS {k}_revenue" for k, c in STAY_SQL.items())} FROM stay GROUP BY listing_id),
lt AS (SELECT listing_id, {_mean("l")} AS avg_lead, quantile_cont(l, 0.5) AS median_lead, min(l) AS min_lead, max(l) AS max_lead, {', '.join(f"{_count(c)} AS {k}_bookings" for k, c in LEAD_SQL.items())}, count(*) AS n_lead FROM (SELECT *, check_in - booked_at AS l FROM booked) GROUP BY listing_id),
cn AS (SELECT listing_id, {_count("cancelled")} AS cancelled_bookings, count(*) AS n_cancel, {_ratio(_count("cancelled"), "count(*)", "100.0")} AS cancellation_rate FROM booked GROUP BY listing_id),
econ0 AS (SELECT listing_id, listing_name, host_id, host_name, neighbourhood_cleansed, property_type, room_type, accommodates, {_z("alos")} AS avg_length_of_stay, {_z("median_nights")} AS median_length_of_stay, {_z("min_nights")} AS min_length_of_stay, {_z("max_nights")} AS max_length_of_stay,
  {_z("avg_lead")} AS avg_booking_lead_time, {_z("median_lead")} AS median_booking_lead_time, {', '.join(f"{_z(k + '_bookings')} AS {k}_bookings" for k in (*LEAD_SQL, *STAY_SQL))}, {', '.join(f"{_z(k + '_revenue')} AS {k}_revenue" for k in STAY_SQL)},
  {_z("avg_booking_value")} AS avg_booking_value, {_z("min_booking_value")} AS min_booking_value, {_z("max_booking_value")} AS max_booking_value, {_z("cancellation_rate")} AS cancellation_rate, {_z("cancelled_bookings")} AS cancelled_bookings, {_z("n_cancel")} AS total_bookings_with_cancellation_data,
  {_z("total_bookings")} AS total_bookings, {_z("total_booking_value")} AS total_booking_value FROM li LEFT JOIN sm USING (listing_id) LEFT JOIN lt USING (listing_id) LEFT JOIN cn USING (listing_id)),
econ AS (SELECT *, CASE WHEN total_bookings > 0 THEN {_ratio("one_night_bookings", "total_bookings", "100.0")} ELSE 0 END AS one_night_booking_percentage, CASE WHEN total_booking_value > 0 THEN {_ratio("seven_plus_night_revenue", "total_booking_value", "100.0")} ELSE 0 END AS long_stay_revenue_percentage,
  CASE greatest(one_night_revenue, two_night_revenue, three_to_six_night_revenue, seven_plus_night_revenue) WHEN 0 THEN 'No Revenue' WHEN one_night_revenue THEN '1 Night' WHEN two_night_revenue THEN '2 Nights' WHEN three_to_six_night_revenue THEN '3-6 Nights' ELSE '7+ Nights' END AS most_valuable_stay_duration FROM econ0),
mon AS (SELECT listing_id, date_trunc('month', calendar_date)::DATE AS month_start_date, count(*) AS total_days, {_count("NOT is_available")} AS booked_days, {_count("is_available")} AS available_days, {_count("is_weekend AND NOT is_available")} AS booked_weekend_days, {_count("NOT is_weekend AND NOT is_available")} AS booked_weekday_days,
  {_sum("NOT is_available", "price")} AS total_revenue, coalesce({_ratio(_sum("NOT is_available", "price"), _count("NOT is_available"))}, 0) AS adr, {_ratio(_sum("NOT is_available", "price"), "count(*)")} AS revpad,
  coalesce({_ratio(_sum("is_weekend AND NOT is_available", "price"), _count("is_weekend AND NOT is_available"))}, 0) AS weekend_adr, coalesce({_ratio(_sum("NOT is_weekend AND NOT is_available", "price"), _count("NOT is_weekend AND NOT is_available"))}, 0) AS weekday_adr,
  {_ratio(_count("NOT is_available"), "count(*)", "100.0")} AS occupancy_rate FROM fct WHERE calendar_date <= DATE '{AS_OF}' GROUP BY ALL),
chg AS (SELECT listing_id, month_start_date, CASE WHEN lag(adr) OVER w > 0 THEN (adr / lag(adr) OVER w - 1) * 100 END AS price_change_pct, CASE WHEN lag(occupancy_rate) OVER w > 0 THEN (occupancy_rate / lag(occupancy_rate) OVER w - 1) * 100 END AS occupancy_change_pct FROM mon WINDOW w AS (PARTITION BY listing_id ORDER BY month_start_date)),
ela AS (SELECT *, CASE WHEN price_change_pct <> 0 THEN occupancy_change_pct / price_change_pct * -1 ELSE 0 END AS price_elasticity FROM chg WHERE price_change_pct IS NOT NULL AND occupancy_change_pct IS NOT NULL),
fin0 AS (SELECT listing_id, month_start_date, mon.* EXCLUDE (listing_id, month_start_date), price_change_pct, occupancy_change_pct, price_elasticity, listing_name, host_id, host_name, neighbourhood_cleansed, property_type, room_type,
  CASE WHEN weekday_adr > 0 THEN (weekend_adr / weekday_adr - 1) * 100 ELSE 0 END AS weekend_pricing_premium_pct,
  CASE WHEN price_elasticity > 1.5 THEN 'Highly Elastic' WHEN price_elasticity BETWEEN 0.5 AND 1.5 THEN 'Elastic' WHEN price_elasticity BETWEEN -0.5 AND 0.5 THEN 'Inelastic' WHEN price_elasticity < -0.5 THEN 'Abnormal Response' ELSE 'Insufficient Data' END AS elasticity_category,
  CASE WHEN price_elasticity > 1.0 THEN 'Consider lowering price to increase occupancy' WHEN price_elasticity BETWEEN 0.5 AND 1.0 THEN 'Price is sensitive - optimize carefully' WHEN price_elasticity BETWEEN -0.5 AND 0.5 THEN 'Price is inelastic - may increase price' WHEN price_elasticity < -0.5 THEN 'Abnormal data - investigate other factors' ELSE 'Need more data' END AS pricing_recommendation,
  avg(adr) OVER (PARTITION BY listing_id ORDER BY month_start_date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS trailing_12m_avg_adr
  FROM mon LEFT JOIN ela USING (listing_id, month_start_date) JOIN li USING (listing_id)),
fin AS (SELECT *, CASE WHEN trailing_12m_avg_adr > 0 THEN adr / trailing_12m_avg_adr END AS seasonal_index, CASE WHEN adr > 1.1::DOUBLE * trailing_12m_avg_adr THEN 'High Season' WHEN adr < 0.9::DOUBLE * trailing_12m_avg_adr THEN 'Low Season' ELSE 'Regular Season' END AS seasonality FROM fin0),
hr AS (SELECT listing_id, date_trunc('month', review_date)::DATE AS month_date, count(DISTINCT review_id) AS review_count, {_count("sentiment = 'positive'")} AS positive_reviews, sum(review_length) AS ls, count(review_length) AS ln FROM rv GROUP BY ALL),
hd AS (SELECT listing_id, date_trunc('month', calendar_date)::DATE AS month_date, {_count("NOT is_available")} AS booked_days, {_count("is_available")} AS available_days, count(*) AS total_days, {_sum("NOT is_available", "price")} AS revenue, count(price) AS pn, sum(price) AS ps FROM fct GROUP BY ALL),
hm AS (SELECT host_id, host_name, month_date, count(DISTINCT listing_id) AS active_listings, sum(booked_days) AS booked_days, sum(available_days) AS available_days, sum(total_days) AS total_days, sum(revenue) AS estimated_revenue, sum(ps) AS ps, sum(pn) AS pn, coalesce(sum(review_count), 0) AS review_count, coalesce(sum(positive_reviews), 0) AS positive_reviews,
  coalesce(sum(ls), 0) AS ls, coalesce(sum(ln), 0) AS ln FROM hd LEFT JOIN hr USING (listing_id, month_date) JOIN li USING (listing_id) GROUP BY ALL),
"""


def _host(name: str, source: str) -> str:
    return f"""{name}0 AS (SELECT host_id, host_name, month_date, active_listings, booked_days, available_days, total_days, {r(_ratio("booked_days", "total_days", "100.0"), 2)} AS occupancy_rate, estimated_revenue, {r(_ratio("estimated_revenue", "active_listings"), 2)} AS revenue_per_listing,
  {r(_ratio("estimated_revenue", "booked_days"), 2)} AS revenue_per_booked_day, {_ratio("ps", "pn")} AS average_daily_rate, review_count, {r(_ratio("positive_reviews", "review_count", "100.0"), 2)} AS positive_review_percentage, {_ratio("ls", "ln")} AS avg_review_length FROM {source}),
{name} AS (SELECT *, lag(estimated_revenue) OVER w AS previous_month_revenue, lag(occupancy_rate) OVER w AS previous_month_occupancy, CASE WHEN lag(estimated_revenue) OVER w > 0 THEN (estimated_revenue::DOUBLE / (lag(estimated_revenue) OVER w)::DOUBLE - 1) * 100 END AS revenue_growth_pct FROM {name}0 WINDOW w AS (PARTITION BY host_id ORDER BY month_date))"""


LAYERS += _host("hp", "hm")
FAN_OUT = f""", fo AS (SELECT host_id, host_name, date_trunc('month', calendar_date)::DATE AS month_date, count(DISTINCT li.listing_id) AS active_listings, {_count("NOT is_available")} AS booked_days, {_count("is_available")} AS available_days, count(*) AS total_days, {_sum("NOT is_available", "fct.price")} AS estimated_revenue, sum(fct.price) AS ps, count(fct.price) AS pn,
  count(DISTINCT review_id) AS review_count, {_count("sentiment = 'positive'")} AS positive_reviews, sum(review_length) AS ls, count(review_length) AS ln FROM li JOIN fct ON fct.listing_id = li.listing_id LEFT JOIN rv ON rv.listing_id = li.listing_id AND date_trunc('month', review_date) = date_trunc('month', calendar_date) GROUP BY ALL), """ + _host("hw", "fo")
HOST_SHOWN = f"""SELECT host_id, host_name, month_date, active_listings, {b("booked_days")} AS booked_days, {b("available_days")} AS available_days, {b("total_days")} AS total_days, occupancy_rate, {r("estimated_revenue")} AS estimated_revenue, revenue_per_listing, revenue_per_booked_day, {r("average_daily_rate")} AS average_daily_rate,
  {b("review_count")} AS review_count, positive_review_percentage, {r("avg_review_length")} AS avg_review_length, {r("previous_month_revenue")} AS previous_month_revenue, previous_month_occupancy, {r("revenue_growth_pct")} AS revenue_growth_pct FROM """

registry = Registry()


def add(name: str, query, sql: str | None) -> None:
    registry.add(name, lambda spark, d: flat(query(spark, d)), None if sql is None else LAYERS + " " + sql)


_SAME = ("name AS listing_name", "host_name", "neighbourhood_cleansed", "bathrooms_text", "amenities", "license", "host_listings_count", "accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights", *clean.HOST_COUNTS)
_BOTH = f"id AS listing_id, host_id, {', '.join(_SAME)}, host_is_superhost = 't' AS host_is_superhost, instant_bookable = 't' AS instant_bookable, {r('latitude::DECIMAL(10,6)')} AS latitude, {r('longitude::DECIMAL(10,6)')} AS longitude, trim(property_type) AS property_type, trim(room_type) AS room_type, last_scraped, _ingested_at, {LISTING_HASH} AS record_hash"
_stamps = lambda df: df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("last_scraped", "_ingested_at")})
_STAMPS = "* REPLACE (strftime(last_scraped, '%Y-%m-%d %H:%M:%S') AS last_scraped, strftime(_ingested_at, '%Y-%m-%d %H:%M:%S') AS _ingested_at)"
add("stg_listings", lambda s, d: _stamps(clean.stg_listings(bridge.raw_listings(s, d))),
    f"SELECT {_STAMPS} FROM (SELECT {_BOTH}, host_since, host_location, host_response_time, host_response_rate, host_acceptance_rate, {BARE} AS price_raw FROM raw_listings)")
add("stg_reviews", lambda s, d: clean.stg_reviews(bridge.raw_reviews(s, d)).drop("review_text", "_ingested_at"),
    f"SELECT id AS review_id, listing_id, reviewer_id, reviewer_name, date AS review_date, {_hash('id', 'listing_id', 'date', 'comments')} AS record_hash FROM raw_reviews")
add("stg_calendar", lambda s, d: clean.stg_calendar(bridge.raw_calendar(s, d)).drop("_ingested_at"),
    f"SELECT listing_id, date AS calendar_date, available, price, adjusted_price, minimum_nights, maximum_nights, {_hash('listing_id', 'date', 'available', 'price', 'minimum_nights', 'maximum_nights')} AS record_hash FROM raw_calendar")
add("clean_calendar", lambda s, d: clean.clean_calendar(clean.stg_calendar(bridge.raw_calendar(s, d))).drop("_ingested_at"),
    f"SELECT listing_id, calendar_date, is_available, {r('price')} AS price, {r('adjusted_price')} AS adjusted_price, minimum_nights, maximum_nights, day_of_week, month_num, year_num, is_weekend, record_hash FROM cal")
add("clean_listings", lambda s, d: _stamps(listings(s, d)),
    f"SELECT {_STAMPS} FROM (SELECT {_BOTH}, {CITY} AS host_city, {COUNTRY} AS host_country, {_day('host_since')} AS host_since, {CATEGORY} AS host_response_time_category, {HOURS} AS host_response_time_hours, {r(_rate)} AS host_response_rate_pct, {r(_acc)} AS host_acceptance_rate_pct, {SCORE} AS host_quality_score, {r(f'CASE WHEN regexp_matches(trim({BARE}), {NUM}) THEN try_cast(trim({BARE}) AS DECIMAL(12,2)) END')} AS price, {QUALITY} AS data_quality_check FROM raw_listings)")
add("parse_location", lambda s, d: bridge.raw_listings(s, d).select("id", clean.host_city().alias("host_city"), clean.host_country().alias("host_country")), f"SELECT id, {CITY} AS host_city, {COUNTRY} AS host_country FROM raw_listings")
add("parse_date_formats", lambda s, d: bridge.raw_listings(s, d).select("id", clean.day("host_since").alias("host_since")), f"SELECT id, {_day('host_since')} AS host_since FROM raw_listings")
add("response_time_category", lambda s, d: bridge.raw_listings(s, d).select("id", clean.response_category().alias("category"), clean.response_hours().alias("hours")), f"SELECT id, {CATEGORY} AS category, {HOURS} AS hours FROM raw_listings")
add("parse_percent", lambda s, d: bridge.raw_listings(s, d).select("id", clean.percent("host_response_rate").alias("rate")), f"SELECT id, {r(_rate)} AS rate FROM raw_listings")
add("host_quality_score", lambda s, d: bridge.raw_listings(s, d).select("id", clean.quality_score().alias("score")), f"SELECT id, {SCORE} AS score FROM raw_listings")
add("listing_quality_label", lambda s, d: clean.stg_listings(bridge.raw_listings(s, d)).select("listing_id", clean.listing_quality().alias("label")), f"SELECT id AS listing_id, {QUALITY} AS label FROM raw_listings")
add("clean_reviews", lambda s, d: cleaned_reviews(s, d).drop("review_text", "_ingested_at"), "SELECT review_id, listing_id, reviewer_id, reviewer_name, review_date, review_length, sentiment, record_hash, data_quality_check FROM rq")
add("sentiment_keywords", lambda s, d: cleaned_reviews(s, d).groupBy("sentiment").agg(F.count("*").alias("n")), "SELECT sentiment, count(*) AS n FROM rc GROUP BY sentiment")
add("review_quality_label", lambda s, d: cleaned_reviews(s, d).groupBy("data_quality_check").agg(F.count("*").alias("n")), "SELECT data_quality_check, count(*) AS n FROM rq GROUP BY ALL")
_CALENDAR_SQL = f"SELECT listing_id, calendar_date, is_available, {r('price')} AS price, day_of_week, is_weekend, {r('price_change_from_previous_day')} AS price_change_from_previous_day FROM fct"
add("fct_calendar_daily", lambda s, d: calendar(s, d).select("listing_id", "calendar_date", "is_available", "price", "day_of_week", "is_weekend", "price_change_from_previous_day"), _CALENDAR_SQL)


_DATELESS = "CASE WHEN listing_id % 9 = 4 AND day_of_week = 3 AND month_num = 7 THEN NULL ELSE calendar_date END"


def _in_batches(spark: SparkSession, d: str) -> DataFrame:
    """The facts as a stored table, in three loads of which the second brings a month again; some days have lost their date."""
    days = clean.clean_calendar(clean.stg_calendar(bridge.raw_calendar(spark, d))).withColumn("__day", F.col("calendar_date")).withColumn("calendar_date", F.expr(_DATELESS))
    table = Keyed(spark, f"{work_dir(spark)}/facts", ["listing_id"], keep=1, slices=marts.YEARS)
    for batch, (low, high) in enumerate((("1900-01-01", "1999-01-01"), ("1998-12-01", "2000-06-01"), ("2000-06-01", "2100-01-01")), 1):
        marts.load_calendar(table, days.where(f"__day >= '{low}' AND __day < '{high}'").drop("__day"), batch)
    return table.read().select("listing_id", "calendar_date", "is_available", "price", "day_of_week", "is_weekend", "price_change_from_previous_day")


add("fct_calendar_incremental", _in_batches, f"""SELECT listing_id, calendar_date, is_available, {r('price')} AS price, day_of_week, is_weekend, {r('c')} AS price_change_from_previous_day FROM
  (SELECT *, CASE WHEN calendar_date IS NOT NULL AND lag(price) OVER w IS NOT NULL THEN price - lag(price) OVER w ELSE 0 END AS c
   FROM (SELECT * REPLACE ({_DATELESS} AS calendar_date) FROM cal) WINDOW w AS (PARTITION BY listing_id, calendar_date IS NULL ORDER BY calendar_date))""")
add("fct_reviews", lambda s, d: reviews(s, d).drop("review_text", "_ingested_at"), "SELECT md5(review_id::VARCHAR) AS review_sk, review_id, listing_id, reviewer_id, reviewer_name, review_date, year(review_date)::INT AS review_year, month(review_date)::INT AS review_month, day(review_date)::INT AS review_day, rpad(dayname(review_date), 9, ' ') AS review_day_of_week, review_length, sentiment, record_hash FROM rv")
_rev = f"SELECT reviewer_id, reviewer_name, min({_day('date')}) AS first_review_date, max({_day('date')}) AS last_review_date, count(*) AS total_reviews, count(DISTINCT listing_id) AS unique_listings_reviewed, CASE WHEN count(*) >= 10 THEN 'frequent' WHEN count(*) >= 3 THEN 'regular' ELSE 'new' END AS reviewer_tier FROM raw_reviews GROUP BY reviewer_id, reviewer_name"
add("dim_reviewers", lambda s, d: marts.dim_reviewers(clean.stg_reviews(bridge.raw_reviews(s, d))), _rev)
add("booking_sequences_islands", lambda s, d: marts.booking_sequences(calendar(s, d)), f"SELECT listing_id, calendar_date, {r('price')} AS price, new_sequence_flag, {b('booking_sequence_id')} AS booking_sequence_id FROM seq")
add("booking_sequences_as_written", lambda s, d: marts.booking_sequences(calendar(s, d), "as_written"), f"SELECT listing_id, calendar_date, {r('price')} AS price, CASE WHEN calendar_date = min(calendar_date) OVER (PARTITION BY listing_id) THEN 1 ELSE 0 END AS new_sequence_flag, 1::BIGINT AS booking_sequence_id FROM fct WHERE NOT is_available")
add("stay_metrics_by_listing", lambda s, d: marts.stay_metrics(marts.stays(marts.booking_sequences(calendar(s, d)))),
    f"SELECT listing_id, {r('alos')} AS alos, min_nights, max_nights, {r('median_nights')} AS median_nights, {', '.join(f'{r(c)} AS {c}' for c in ('avg_booking_value', 'max_booking_value', 'min_booking_value', 'total_booking_value'))}, total_bookings, {', '.join(f'{k}_bookings' for k in STAY_SQL)}, {', '.join(f"{r(k + '_revenue')} AS {k}_revenue" for k in STAY_SQL)} FROM sm")
add("booking_patterns_monthly", lambda s, d: marts.booking_patterns(marts.stays(marts.booking_sequences(calendar(s, d)))),
    f"SELECT listing_id, date_trunc('month', check_in_date)::DATE AS month_start_date, count(*) AS monthly_bookings, {r(_mean('nights'))} AS monthly_alos, {r(_mean('v'))} AS monthly_avg_booking_value, {r('sum(v)')} AS monthly_total_booking_value FROM stay GROUP BY 1, 2")
add("lead_time_metrics", lambda s, d: marts.lead_times(bridge.bookings(s, d)),
    f"SELECT listing_id, {r('avg_lead')} AS avg_lead_time_days, {r('median_lead')} AS median_lead_time_days, min_lead AS min_lead_time_days, max_lead AS max_lead_time_days, {', '.join(f'{k}_bookings' for k in LEAD_SQL)}, n_lead AS total_bookings_with_lead_time FROM lt")
add("cancellation_metrics", lambda s, d: marts.cancellations(bridge.bookings(s, d)), f"SELECT listing_id, cancelled_bookings, n_cancel AS total_bookings_with_cancellation_data, {r('cancellation_rate')} AS cancellation_rate FROM cn")
_econ = ("avg_length_of_stay", "median_length_of_stay", "avg_booking_lead_time", "median_booking_lead_time", "avg_booking_value", "min_booking_value", "max_booking_value", "cancellation_rate", "total_booking_value", "one_night_booking_percentage", "long_stay_revenue_percentage", *[f"{k}_revenue" for k in STAY_SQL])
add("booking_economics", economics, f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in _econ)}) FROM econ")
_mon = ("total_revenue", "adr", "revpad", "weekend_adr", "weekday_adr", "occupancy_rate")
add("listing_month_metrics", months, f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in _mon)}) FROM mon")
add("price_elasticity", lambda s, d: marts.elasticity(months(s, d)), f"SELECT listing_id, month_start_date, {', '.join(f'{r(c)} AS {c}' for c in ('price_change_pct', 'occupancy_change_pct', 'price_elasticity'))} FROM ela")
_fin = (*_mon, "price_change_pct", "occupancy_change_pct", "price_elasticity", "weekend_pricing_premium_pct", "trailing_12m_avg_adr", "seasonal_index")
add("financial_performance", finance, f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in _fin)}) FROM fin")
add("listing_availability_monthly", lambda s, d: marts.availability_monthly(calendar(s, d)),
    f"SELECT listing_id, year_num, month_num, make_date(year_num, month_num, 1) AS first_day_of_month, count(*) AS total_days, {_count('is_available')} AS available_days, {_count('NOT is_available')} AS booked_days, {r(_mean('price'))} AS avg_daily_price, {r('max(price)')} AS max_daily_price, {r('min(price)')} AS min_daily_price, {r('sum(price) FILTER (is_weekend)::DOUBLE / count(price) FILTER (is_weekend)')} AS avg_weekend_price, {r('sum(price) FILTER (NOT is_weekend)::DOUBLE / count(price) FILTER (NOT is_weekend)')} AS avg_weekday_price, {r(_ratio(_count('NOT is_available'), 'count(*)', '100.0'))} AS occupancy_rate FROM fct GROUP BY listing_id, year_num, month_num")
add("host_performance_monthly", hosts, HOST_SHOWN + "hp")
add("host_performance_monthly_as_written", lambda s, d: hosts(s, d, "as_written"), None)
registry.sql["host_performance_monthly_as_written"] = LAYERS + FAN_OUT + " " + HOST_SHOWN + "hw"
add("review_metrics_by_listing", lambda s, d: marts.review_metrics(listings(s, d), reviews(s, d)),
    f"""SELECT *, CASE WHEN review_count = 0 THEN 'No Reviews' WHEN positive_reviews > negative_reviews * 3 THEN 'Highly Rated' WHEN positive_reviews > negative_reviews THEN 'Well Rated' WHEN negative_reviews > positive_reviews THEN 'Poorly Rated' ELSE 'Mixed Reviews' END AS review_rating_category, coalesce({r(_ratio("positive_reviews", "review_count", "100.0"))}, 0) AS positive_review_percentage FROM
    (SELECT listing_id, listing_name, host_id, host_name, neighbourhood_cleansed, property_type, room_type, {r("any_value(price)")} AS price, count(review_id) AS review_count, {r("sum(review_length)::DOUBLE / nullif(count(review_length), 0)")} AS avg_review_length, min(review_date) AS first_review_date, max(review_date) AS last_review_date, {', '.join(f"{_count(f"sentiment = '{k}'")} AS {k}_reviews" for k in ("positive", "negative", "neutral"))} FROM li LEFT JOIN rv USING (listing_id) GROUP BY listing_id, listing_name, host_id, host_name, neighbourhood_cleansed, property_type, room_type)""")



def _refreshed(spark: SparkSession, d: str) -> Warehouse:
    """Two deliveries of each entity into a stored warehouse. The second brings the later days, the other reviews, and every
    fifth listing at another price."""
    house = Warehouse(spark, f"{work_dir(spark)}/warehouse", positive=bridge.POSITIVE, negative=bridge.NEGATIVE, keep=1)
    over = bridge.span(spark, d)
    listed = bridge.raw_listings(spark, d)
    reviewed = bridge.raw_reviews(spark, d, lambda documents: clean.review_texts(documents, "text", *house.words))  # texts are read once a document
    first = {"listings": listed, "calendar": bridge.raw_calendar(spark, d, over=over, until="1999-01-01"), "reviews": reviewed.where("id % 2 = 0")}
    for entity, rows in first.items():
        house.deliver(entity, rows, "b1", f"{entity}_1.csv.gz", "h1", ingested_at="2001-11-05 00:00:00")
    house.refresh()
    later = {"calendar": bridge.raw_calendar(spark, d, over=over, since="1998-12-25"), "reviews": reviewed.where("id % 2 = 1"), "listings": listed.where("id % 5 = 0").withColumn("price", F.lit("$999.00"))}
    for entity, rows in later.items():
        house.deliver(entity, rows, "b2", f"{entity}_2.csv.gz", "h2", ingested_at="2001-12-05 00:00:00")
    house.refresh()
    return house


def _by_listing(spark: SparkSession, d: str) -> DataFrame:
    """What a listing looks like in the stored warehouse: price, versions, days, and reviews."""
    house = _refreshed(spark, d)
    now = house.current_listings().select("listing_id", "host_name", "price")
    versions = house.listings.read().groupBy("listing_id").agg(F.count("*").alias("versions"))
    days = house.facts().groupBy("listing_id").agg(F.count("*").alias("days"), F.count_if(~F.col("is_available")).alias("booked_days"), F.sum("price_change_from_previous_day").alias("rise"))
    reviewed = house.valid_reviews().groupBy("listing_id").agg(F.count("*").alias("reviews"), F.countDistinct("reviewer_id").alias("reviewers"))
    return now.join(versions, "listing_id").join(days, "listing_id").join(reviewed, "listing_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("reviews", "reviewers")})


add("warehouse_incremental", _by_listing, f"""SELECT listing_id, host_name, {r("CASE WHEN listing_id % 5 = 0 THEN 999.0 ELSE price END")} AS price, CASE WHEN listing_id % 5 = 0 THEN 2 ELSE 1 END AS versions,
  days, booked_days, {r('rise')} AS rise, coalesce(reviews, 0) AS reviews, coalesce(reviewers, 0) AS reviewers FROM li
  JOIN (SELECT listing_id, count(*) AS days, {_count('NOT is_available')} AS booked_days, sum(price_change_from_previous_day) AS rise FROM fct GROUP BY 1) USING (listing_id)
  LEFT JOIN (SELECT listing_id, count(*) AS reviews, count(DISTINCT reviewer_id) AS reviewers FROM rv GROUP BY 1) USING (listing_id)""")
add("warehouse_hosts", lambda s, d: (lambda house: marts.host_performance(house.current_listings(), house.facts(), house.valid_reviews()))(_refreshed(s, d)), HOST_SHOWN + "hp")
add("warehouse_reviewers", lambda s, d: _refreshed(s, d).reviewers.read(), """SELECT reviewer_id, reviewer_name, min(review_date) AS first_review_date, max(review_date) AS last_review_date, count(*) AS total_reviews, count(DISTINCT listing_id) AS unique_listings_reviewed,
  CASE WHEN count(*) >= 10 THEN 'frequent' WHEN count(*) >= 3 THEN 'regular' ELSE 'new' END AS reviewer_tier FROM rc GROUP BY 1, 2""")

# Analyses.


def ask(name: str, mart, question, sql: str) -> None:
    add(name, lambda s, d: question(mart(s, d)), sql)


def _band(c: str, edges) -> str:
    return "CASE " + " ".join(f"WHEN {c} < {e} THEN '{n}'" for e, n in edges[:-1]) + f" ELSE '{edges[-1][1]}' END"


a2 = lambda c, n=None: f"{r(f'avg({c})', 2)} AS {n or c}"
s2 = lambda c, n=None: f"{r(f'sum({c})')} AS {n or c}"
n_ = lambda c, n=None: f"{b(f'sum({c})')} AS {n or c}"
_lead, _stay = _band("avg_booking_lead_time", analyses.LEAD_BANDS), _band("avg_length_of_stay", analyses.STAY_BANDS)
_lost = "sum(cancelled_bookings * avg_booking_value)"
_leads, _revs = " + ".join(f"{k}_bookings" for k in LEAD_SQL), " + ".join(f"{k}_revenue" for k in STAY_SQL)
_L = "count(DISTINCT listing_id)"
ask("booking_summary", economics, analyses.booking_summary, f"SELECT {_L} AS total_active_listings, {n_('total_bookings')}, {s2('total_booking_value', 'total_revenue')}, {r(_ratio('sum(total_booking_value)', 'sum(total_bookings)'), 2)} AS platform_avg_booking_value, {a2('avg_length_of_stay', 'platform_avg_length_of_stay')}, {a2('avg_booking_lead_time', 'platform_avg_lead_time')}, {a2('cancellation_rate', 'platform_avg_cancellation_rate')} FROM econ")
ask("cancellation_impact", economics, analyses.cancellation_impact, f"SELECT property_type, {a2('cancellation_rate', 'avg_cancellation_rate')}, {r(_lost, 2)} AS estimated_lost_revenue, {s2('total_booking_value', 'actual_revenue')}, {r(_ratio(_lost, 'sum(total_booking_value)', '100.0'), 2)} AS pct_revenue_impact FROM econ GROUP BY property_type")
ask("cancellation_by_lead_time", economics, analyses.cancellation_by_lead_time, f"SELECT {_lead} AS lead_time_category, {a2('cancellation_rate', 'avg_cancellation_rate')}, {n_('cancelled_bookings', 'total_cancelled_bookings')}, {n_('total_bookings_with_cancellation_data', 'total_bookings')}, {r(_ratio('sum(cancelled_bookings)', 'sum(total_bookings_with_cancellation_data)', '100.0'), 2)} AS overall_cancellation_rate FROM econ GROUP BY 1")
ask("booking_kpis", economics, analyses.booking_kpis, f"SELECT {_L} AS total_listings, {n_('total_bookings')}, {s2('total_booking_value', 'total_revenue')}, {', '.join(a2(c) for c in ('avg_length_of_stay', 'median_length_of_stay', 'avg_booking_lead_time', 'avg_booking_value'))}, max(max_length_of_stay) AS max_length_of_stay, {n_('last_minute_bookings')}, {r(_ratio('sum(last_minute_bookings)', 'sum(total_bookings)', '100.0'), 2)} AS pct_last_minute, {r('max(max_booking_value)')} AS max_booking_value, {a2('cancellation_rate', 'avg_cancellation_rate')}, {n_('cancelled_bookings', 'total_cancellations')}, {', '.join(n_(f'{k}_bookings') for k in STAY_SQL)}, {', '.join(s2(f'{k}_revenue') for k in STAY_SQL)} FROM econ")
ask("lead_time_buckets", economics, analyses.lead_time_buckets, f"SELECT {_lead} AS lead_time_category, {_L} AS num_listings, {a2('avg_booking_value')}, {s2('total_booking_value', 'total_revenue')}, {a2('avg_length_of_stay')}, {a2('cancellation_rate', 'avg_cancellation_rate')} FROM econ GROUP BY 1")
ask("lead_time_by_property", economics, analyses.lead_time_by_property, f"SELECT property_type, {', '.join(n_(f'{k}_bookings') for k in LEAD_SQL)}, {r(_ratio('sum(last_minute_bookings)', f'sum({_leads})', '100.0'), 2)} AS pct_last_minute, {r(_ratio('sum(long_lead_bookings)', f'sum({_leads})', '100.0'), 2)} AS pct_long_lead FROM econ GROUP BY property_type")
ask("stay_length_buckets", economics, analyses.stay_length_buckets, f"SELECT {_stay} AS stay_length_category, {_L} AS num_listings, {n_('total_bookings', 'num_bookings')}, {s2('total_booking_value', 'total_revenue')}, {a2('avg_booking_value')}, {a2('cancellation_rate', 'avg_cancellation_rate')} FROM econ GROUP BY 1")
ask("optimization_opportunities", economics, analyses.optimization_opportunities, f"SELECT listing_id, listing_name, property_type, room_type, neighbourhood_cleansed, {', '.join(f'{r(c)} AS {c}' for c in ('avg_length_of_stay', 'avg_booking_value', 'cancellation_rate'))}, most_valuable_stay_duration, CASE WHEN cancellation_rate > 15 AND total_bookings > 10 THEN 'High cancellation rate' WHEN long_stay_revenue_percentage > 75 AND avg_length_of_stay < 5 THEN 'Extend min nights requirement' WHEN one_night_booking_percentage > 75 AND avg_booking_value < (SELECT avg(avg_booking_value) FROM econ) THEN 'Increase min nights' WHEN avg_length_of_stay > 5 AND long_stay_revenue_percentage < 30 THEN 'Optimize for shorter stays' ELSE 'No major optimization needed' END AS optimization_opportunity FROM econ WHERE total_bookings > 5")
_opt = ", ".join(f"count(DISTINCT CASE WHEN most_valuable_stay_duration = '{v}' THEN listing_id END) AS {k}_optimal_listings" for k, v in (("one_night", "1 Night"), ("two_night", "2 Nights"), ("medium_stay", "3-6 Nights"), ("long_stay", "7+ Nights")))
ask("neighbourhood_stay_mix", economics, analyses.neighbourhood_stay_mix, f"SELECT neighbourhood_cleansed, {a2('one_night_booking_percentage', 'avg_one_night_pct')}, {a2('long_stay_revenue_percentage', 'avg_long_stay_revenue_pct')}, {_opt} FROM econ GROUP BY 1 HAVING {_L} > 5")
ask("profitable_stay_by_property", economics, analyses.profitable_stay_by_property, f"SELECT property_type, most_valuable_stay_duration, {_L} AS num_listings, {a2('avg_booking_value')}, {s2('total_booking_value', 'total_revenue')} FROM econ GROUP BY 1, 2")
ask("revenue_breakdown", economics, analyses.revenue_breakdown, f"SELECT {', '.join(s2(f'{k}_revenue') for k in STAY_SQL)}, {', '.join(f'{r(_ratio(f"sum({k}_revenue)", f"sum({_revs})", "100.0"), 2)} AS pct_{k}' for k in STAY_SQL)} FROM econ")
ask("revenue_per_night", economics, analyses.revenue_per_night, "SELECT " + ", ".join(f"{r(_ratio(f'sum({k}_revenue)', f'sum({k}_bookings)::DOUBLE * {n}::DOUBLE'), 2)} AS revenue_per_night_{k}" for k, n in zip(STAY_SQL, ("1.0", "2.0", "4.5", "10.0"), strict=True)) + " FROM econ")
ask("top_neighbourhoods", economics, analyses.top_neighbourhoods, f"SELECT neighbourhood_cleansed, {_L} AS num_listings, {a2('avg_length_of_stay')}, {a2('avg_booking_lead_time', 'avg_lead_time')}, {a2('avg_booking_value')}, {a2('cancellation_rate', 'avg_cancellation_rate')}, {n_('total_bookings')}, {s2('total_booking_value', 'total_revenue')} FROM econ GROUP BY 1 ORDER BY total_revenue DESC, 1 LIMIT 15")
ask("monthly_revenue_trend", finance, analyses.monthly_revenue_trend, f"SELECT month_start_date, {s2('total_revenue', 'platform_revenue')}, {r('avg(adr)')} AS platform_avg_adr, {r('avg(occupancy_rate)')} AS platform_avg_occupancy FROM fin GROUP BY 1")
ask("elasticity_distribution", finance, analyses.elasticity_distribution, f"SELECT elasticity_category, count(*) AS month_listing_count, {_L} AS unique_listing_count, {r('avg(price_elasticity)', 3)} AS avg_elasticity, {r('avg(occupancy_rate)', 3)} AS avg_occupancy, {r('avg(adr)', 3)} AS avg_price FROM fin WHERE elasticity_category <> 'Insufficient Data' GROUP BY 1")
_in = lambda x: f"count(DISTINCT CASE WHEN seasonality = '{x}' THEN listing_id END)"
ask("seasonal_patterns", finance, analyses.seasonal_patterns, f"SELECT month(month_start_date)::INT AS month_num, rpad(monthname(month_start_date), 9, ' ') AS month_name, {r('avg(seasonal_index)')} AS avg_seasonal_index, {_in('High Season')} AS high_season_listings, {_in('Low Season')} AS low_season_listings, {r('avg(occupancy_rate)')} AS avg_occupancy FROM fin GROUP BY 1, 2")
ask("weekend_premium", finance, analyses.weekend_premium, f"SELECT property_type, {r('avg(weekend_pricing_premium_pct)')} AS avg_weekend_premium, {_L} AS listing_count FROM fin GROUP BY 1 HAVING {_L} > 5")
_M = "count(DISTINCT month_date)"
_R = "sum(estimated_revenue)"
ask("host_consistency", hosts, analyses.host_consistency, f"""SELECT host_id, host_name, active_months, {r('ao', 1)} AS avg_occupancy, {r('ov', 1)} AS occupancy_volatility, {r('rv', 1)} AS revenue_volatility, {r('t')} AS total_revenue, CASE k WHEN 1 THEN 'Highly Consistent' WHEN 2 THEN 'Consistent' WHEN 3 THEN 'Moderately Consistent' WHEN 4 THEN 'Volatile' ELSE 'Low Performer' END AS consistency_rating FROM
  (SELECT *, CASE WHEN ov < 5 AND ao > 70 THEN 1 WHEN ov < 10 AND ao > 60 THEN 2 WHEN ov < 15 AND ao > 50 THEN 3 WHEN ov >= 15 THEN 4 ELSE 5 END AS k FROM (SELECT host_id, host_name, {_M} AS active_months, stddev(occupancy_rate) AS ov, stddev(revenue_growth_pct) AS rv, avg(occupancy_rate) AS ao, {_R} AS t FROM hp GROUP BY 1, 2 HAVING {_M} >= 3)) ORDER BY k, t DESC, host_id LIMIT 100""")
_g = lambda c: r(_ratio(f"{c}::DOUBLE - (lag({c}) OVER (ORDER BY month_date))::DOUBLE", f"lag({c}) OVER (ORDER BY month_date)", "100.0"), 1)
ask("platform_growth", hosts, lambda h: analyses.platform_growth(h, AS_OF), f"SELECT month_date, strftime(month_date, '%Y-%m') AS month, active_hosts, total_listings, {r('o', 1)} AS avg_occupancy, {r('t')} AS total_revenue, {_g('t')} AS platform_revenue_growth, {_g('o')} AS platform_occupancy_growth FROM (SELECT month_date, count(DISTINCT host_id) AS active_hosts, {n_('active_listings', 'total_listings')}, avg(occupancy_rate) AS o, {_R} AS t FROM hp WHERE month_date <= DATE '{AS_OF}' GROUP BY 1)")
ask("host_growth_trajectory", hosts, analyses.host_growth_trajectory, f"""SELECT host_id, host_name, active_months, {r('g', 1)} AS avg_monthly_growth_pct, initial_listings, latest_listings, m AS listing_growth, {r('t')} AS total_revenue, CASE WHEN g > 10 AND m > 0 THEN 'High Growth' WHEN g > 5 OR m > 0 THEN 'Growing' WHEN g BETWEEN -5 AND 5 AND m = 0 THEN 'Stable' WHEN g < -5 OR m < 0 THEN 'Declining' ELSE 'Inconsistent' END AS growth_trajectory FROM
  (SELECT *, latest_listings - initial_listings AS m FROM (SELECT host_id, host_name, {_M} AS active_months, avg(revenue_growth_pct) AS g, arg_min(active_listings, month_date) AS initial_listings, arg_max(active_listings, month_date) AS latest_listings, {_R} AS t FROM hp GROUP BY 1, 2 HAVING {_M} >= 3))""")
_own = _ratio("estimated_revenue", "active_listings")
ask("host_vs_platform", hosts, lambda h: analyses.host_vs_platform(h, HOST), f"SELECT host_id, host_name, month_date, active_listings, occupancy_rate, {r('po')} AS avg_platform_occupancy, {r('occupancy_rate - po', 1)} AS occupancy_vs_platform, {r(_own)} AS revenue_per_listing, {r('pr')} AS avg_platform_revenue_per_listing, {r(_ratio(f'{_own} - pr', 'pr', '100.0'), 1)} AS revenue_pct_vs_platform, positive_review_percentage, {r('pp')} AS avg_platform_positive_reviews, {r('positive_review_percentage - pp', 1)} AS reviews_vs_platform FROM hp JOIN (SELECT month_date, avg(occupancy_rate) AS po, avg({_own}) AS pr, avg(positive_review_percentage) AS pp FROM hp GROUP BY 1) USING (month_date) WHERE host_id = {HOST}")
_kpi = lambda w: f"SELECT count(DISTINCT host_id) AS active_hosts, {n_('active_listings', 'total_listings')}, {_R} AS total_revenue, {r('avg(occupancy_rate)', 1)} AS avg_occupancy, {r('avg(revenue_per_listing)', 2)} AS avg_revenue_per_listing, {r('avg(positive_review_percentage)', 1)} AS avg_positive_reviews, {n_('review_count', 'total_reviews')} FROM hp WHERE month_date = ({w})"
_gr = lambda c: r(_ratio(f"n.{c}::DOUBLE - p.{c}::DOUBLE", f"p.{c}", "100.0"), 1)
ask("host_kpis", hosts, analyses.host_kpis, f"SELECT n.active_hosts, {_gr('active_hosts')} AS active_hosts_growth, n.total_listings, {_gr('total_listings')} AS listings_growth, {r('n.total_revenue')} AS total_revenue, {_gr('total_revenue')} AS revenue_growth, n.avg_occupancy, {r('n.avg_occupancy - p.avg_occupancy', 2)} AS occupancy_change, n.avg_revenue_per_listing, {_gr('avg_revenue_per_listing')} AS revenue_per_listing_growth, n.avg_positive_reviews, {r('n.avg_positive_reviews - p.avg_positive_reviews', 2)} AS positive_reviews_change, n.total_reviews, {_gr('total_reviews')} AS reviews_growth FROM ({_kpi('SELECT max(month_date) FROM hp')}) n, ({_kpi('SELECT max(month_date) FROM hp WHERE month_date < (SELECT max(month_date) FROM hp)')}) p")
ask("host_segments", hosts, analyses.host_segments, f"""SELECT host_id, host_name, active_months, {r('al', 1)} AS avg_listings, {r('ao', 1)} AS avg_occupancy, {r('am', 2)} AS avg_monthly_revenue, {r('t')} AS total_revenue, {r('ap', 1)} AS avg_positive_reviews, CASE k WHEN 1 THEN 'Premium Performer' WHEN 2 THEN 'High Performer' WHEN 3 THEN 'Professional Multi-listing' WHEN 4 THEN 'Efficient Single-listing' WHEN 5 THEN 'High-value Low-occupancy' WHEN 7 THEN 'Needs Improvement' ELSE 'Average Performer' END AS host_segment FROM
  (SELECT *, CASE WHEN ao >= 70 AND ap >= 80 AND am >= 5000 THEN 1 WHEN ao >= 60 AND ap >= 70 AND am >= 3000 THEN 2 WHEN ao >= 50 AND al > 3 THEN 3 WHEN ao >= 50 AND al <= 3 AND am >= 2000 THEN 4 WHEN ao < 50 AND am >= 3000 THEN 5 WHEN ao < 40 AND ap < 70 THEN 7 ELSE 6 END AS k FROM
  (SELECT host_id, host_name, {_M} AS active_months, avg(active_listings) AS al, avg(occupancy_rate) AS ao, {_mean('estimated_revenue')} AS am, {_R} AS t, avg(positive_review_percentage) AS ap FROM hp GROUP BY 1, 2 HAVING {_M} >= 3)) ORDER BY k, t DESC, host_id LIMIT 100""")
ask("occupancy_revenue_matrix", hosts, analyses.occupancy_revenue_matrix, f"SELECT {_band('ao', analyses.OCCUPANCY_BANDS)} AS occupancy_bucket, {_band('am', analyses.REVENUE_BANDS)} AS revenue_bucket, count(*) AS host_count, {r('avg(ao)', 1)} AS avg_occupancy_in_group, {r('avg(am)', 2)} AS avg_revenue_in_group FROM (SELECT host_id, avg(occupancy_rate) AS ao, {_mean('estimated_revenue')} AS am FROM hp GROUP BY 1) GROUP BY 1, 2")
_p = "positive_review_percentage"
ask("satisfaction_trends", hosts, analyses.satisfaction_trends, f"""SELECT host_id, host_name, m AS months_with_reviews, {b('n')} AS total_reviews, {r('pa', 1)} AS avg_positive_review_pct, {r('la', 0)} AS avg_review_length, {r('oa', 1)} AS avg_occupancy, {r('c1', 3)} AS review_occupancy_correlation, {r('c2', 3)} AS review_revenue_correlation, CASE WHEN m >= 3 AND t > 0.3 THEN 'Improving' WHEN m >= 3 AND t < -0.3 THEN 'Declining' ELSE 'Stable' END AS satisfaction_trend FROM
  (SELECT host_id, host_name, {_M} AS m, sum(review_count) AS n, avg({_p}) AS pa, avg(avg_review_length) AS la, avg(occupancy_rate) AS oa, corr({_p}, occupancy_rate) AS c1, corr({_p}, estimated_revenue::DOUBLE) AS c2, corr({_p}, epoch(month_date)) AS t FROM hp WHERE review_count > 0 GROUP BY 1, 2 HAVING {_M} >= 2) ORDER BY n DESC, host_id LIMIT 50""")
ask("seasonal_host_performance", hosts, analyses.seasonal_host_performance, f"SELECT month(month_date)::INT AS month_num, rpad(monthname(month_date), 9, ' ') AS month_name, count(DISTINCT host_id) AS active_hosts, {r('avg(occupancy_rate)', 1)} AS avg_occupancy, {r('avg(active_listings)', 1)} AS avg_listings_per_host, {r(_mean('estimated_revenue'), 2)} AS avg_host_revenue, {r(_R)} AS total_platform_revenue, {r(f'avg({_p})', 1)} AS avg_positive_review_pct FROM hp GROUP BY 1, 2")
ask("top_hosts", hosts, analyses.top_hosts, f"SELECT host_id, host_name, {_M} AS active_months, {r('avg(active_listings)', 1)} AS avg_listings, {r(_R)} AS total_revenue, {r('avg(occupancy_rate)', 1)} AS avg_occupancy, {r('avg(revenue_growth_pct)', 1)} AS avg_monthly_growth FROM hp GROUP BY 1, 2 ORDER BY {_R} DESC, host_id LIMIT 20")
