"""Raw entities of the warehouse (listings, calendar, reviews, bookings, ledgers) from the star-schema tables.

The select lists are plain SQL expressions, the same text for Spark and for the SQL that results are compared with.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a task gets at most on average, where a large table is dealt, and rows with a whole text.
ROWS, TEXTS = 1 << 19, 1 << 16
INGESTED = "timestamp '2001-11-05 00:00:00'"


def pick(key: str, values: list[str]) -> str:
    """The value at key modulo their number."""
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


#: Listing fields that the star schema has no source for, by supplier key.
LISTING_COLUMNS: dict[str, str] = {
    "id": "s_suppkey",
    "host_id": "s_nationkey",
    "name": "CASE WHEN s_suppkey % 41 = 40 THEN NULL ELSE s_name END",
    "host_name": "n_name",
    "host_since": pick("s_suppkey", ["'2014-05-06'", "'07/21/2016'", "'2012-11-30'", "'31/31/2024'", "NULL"]),
    "host_location": pick("s_suppkey", ["'Berlin, Germany'", "'Lyon, Rhone, France'", "'Leeds, UK'", "'Austin, Texas, United States'", "'Graz, Austria'", "'Porto, Portugal'", "'Spain'", "NULL"]),
    "host_response_time": pick("s_suppkey", ["'within an hour'", "'within a few hours'", "'within a day'", "'within a few days'", "'a few days or more'", "NULL"]),
    "host_response_rate": pick("s_suppkey", ["'100%'", "'95%'", "'72%'", "'55%'", "'20%'", "'N/A'", "''", "'95'"]),
    "host_acceptance_rate": pick("s_suppkey", ["'99%'", "'85%'", "'64%'", "'N/A'", "'40%'"]),
    "host_is_superhost": pick("s_suppkey", ["'t'", "'f'", "'f'", "NULL"]),
    "host_listings_count": "s_suppkey % 7 + 1",
    "neighbourhood_cleansed": "r_name",
    "latitude": "52.0 + (s_suppkey % 1000) / 10000.0",
    "longitude": "13.0 + (s_suppkey % 777) / 10000.0",
    "property_type": pick("s_suppkey", ["' Apartment'", "'House '", "'Loft'", "'Condo'"]),
    "room_type": pick("s_suppkey", ["'Entire home'", "'Private room'", "'Shared room '"]),
    "accommodates": "CASE WHEN s_suppkey % 23 = 22 THEN 0 ELSE s_suppkey % 6 + 1 END",
    "bathrooms_text": pick("s_suppkey", ["'1 bath'", "'2 baths'"]),
    "bedrooms": "s_suppkey % 4",
    "beds": "s_suppkey % 5 + 1",
    "amenities": pick("s_suppkey", ["'[\"Wifi\", \"Kitchen\"]'", "'{Wifi,Heating}'", "'Wifi'"]),
    "price": "CASE WHEN s_suppkey % 17 = 16 THEN '' ELSE concat('$', CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR(20))) END",
    "minimum_nights": "CASE WHEN s_suppkey % 29 = 28 THEN -1 ELSE s_suppkey % 4 + 1 END",
    "maximum_nights": "CASE WHEN s_suppkey % 31 = 30 THEN 0 ELSE 30 END",
    "license": pick("s_suppkey", ["'L-1'", "NULL"]),
    "instant_bookable": pick("s_suppkey", ["'t'", "'f'"]),
    "calculated_host_listings_count": "s_suppkey % 3 + 1",
    "calculated_host_listings_count_entire_homes": "s_suppkey % 3",
    "calculated_host_listings_count_private_rooms": pick("s_suppkey", ["1", "0", "NULL"]),
    "calculated_host_listings_count_shared_rooms": "s_suppkey % 2",
    "last_scraped": "timestamp '2001-11-04 12:00:00'",
    "_ingested_at": INGESTED,
}
LISTINGS_SQL = f"SELECT {', '.join(f'{e} AS {n}' for n, e in LISTING_COLUMNS.items())} FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"

CALENDAR_COLUMNS = {
    "listing_id": "listing_id",
    "date": "CAST(d AS VARCHAR(10))",
    "available": "CASE WHEN shipped IS NULL THEN 't' ELSE 'f' END",
    "price": "concat('$', CAST(coalesce(day_price, low_price) AS VARCHAR(20)))",
    "adjusted_price": "CASE WHEN day_price IS NULL THEN '' ELSE concat('$', CAST(day_price AS VARCHAR(20))) END",
    "minimum_nights": "CAST(listing_id % 4 + 1 AS INT)",
    "maximum_nights": "30",
    "_ingested_at": INGESTED,
}
CALENDAR_SQL = f"""SELECT {', '.join(f'{e} AS {n}' for n, e in CALENDAR_COLUMNS.items())} FROM
  (SELECT s_suppkey AS listing_id, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM supplier, (SELECT CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem))
  LEFT JOIN (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS k1, max(CAST(l_extendedprice AS DECIMAL(12,2))) AS day_price, count(*) AS shipped FROM lineitem GROUP BY ALL) ON k = listing_id AND k1 = d
  LEFT JOIN (SELECT l_suppkey AS k2, min(CAST(l_extendedprice AS DECIMAL(12,2))) AS low_price FROM lineitem GROUP BY ALL) m ON k2 = listing_id"""

REVIEW_COLUMNS = {
    "id": "o_orderkey",
    "listing_id": "listing_id",
    "reviewer_id": "o_custkey",
    "reviewer_name": "concat(' ', c_name)",
    "date": "CASE WHEN o_orderkey % 97 = 96 THEN 'soon' WHEN o_orderkey % 2 = 0 THEN day ELSE concat(substring(day, 6, 2), '/', substring(day, 9, 2), '/', substring(day, 1, 4)) END",
    "comments": "text",
    "_ingested_at": INGESTED,
}
REVIEWS_SQL = f"""SELECT {', '.join(f'{e} AS {n}' for n, e in REVIEW_COLUMNS.items())} FROM
  (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS day FROM orders)
  JOIN (SELECT l_orderkey, min(l_suppkey) AS listing_id FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey
  LEFT JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)"""

#: Words that decide a review's sentiment in the invented prose of the test tables.
POSITIVE, NEGATIVE = ("than", "avec", "keit"), ("stupid", "idiot", "para")

BOOKINGS_SQL = "SELECT l_suppkey AS listing_id, CAST(o_orderdate AS DATE) AS booked_at, CAST(l_shipdate AS DATE) AS check_in, l_returnflag = 'R' AS cancelled FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE)"

LEDGER_COLUMNS = {
    "file_name": "concat('file_', CAST(user_id % 500 AS VARCHAR(20)), '.csv.gz')",
    "table_name": "CASE user_id % 3 WHEN 0 THEN 'raw_listings' WHEN 1 THEN 'raw_reviews' ELSE 'raw_calendar' END",
    "batch_id": "concat('b', CAST(user_id % 50 AS VARCHAR(20)))",
    "start_time": "ts",
    "processing_status": "CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'IN_PROGRESS' END",
    "rows_processed": "CAST(floor(value) AS BIGINT)",
    "rows_inserted": "CAST(floor(value / 2) AS BIGINT)",
    "rows_failed": "CAST(event_id % 3 AS BIGINT)",
    "file_size_bytes": "CAST(floor(value * 1000) AS BIGINT)",
    "retry_count": "CAST(event_id % 5 AS INT)",
    "error_message": "CASE WHEN event_type = 'error' THEN concat('row ', CAST(event_id % 997 AS VARCHAR(20)), ' is ', props) END",
    "event_id": "event_id",
}
LEDGER_SQL = f"SELECT {', '.join(f'{e} AS {n}' for n, e in LEDGER_COLUMNS.items())} FROM events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")  # 25 and 5 rows
    places = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    supplier = table(spark, sf_dir, "supplier")
    return _select(supplier.join(F.broadcast(places), supplier.s_nationkey == nation.n_nationkey), LISTING_COLUMNS)


def parts(spark: SparkSession, rows: int, most: int | None = None) -> int:
    """Partitions for so many rows: the session's number, and more where a task would get over `most` (ROWS) of them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // (most or ROWS)))


class Span(NamedTuple):
    first: object
    last: object
    tasks: int


def span(spark: SparkSession, sf_dir: str) -> Span:
    """The first and the last day of the calendar, and the tasks that its days ask for."""
    first, last = table(spark, sf_dir, "lineitem").agg(F.min(F.to_date("l_shipdate")), F.max(F.to_date("l_shipdate"))).first()
    return Span(first, last, parts(spark, table(spark, sf_dir, "supplier").count() * ((last - first).days + 1) if last else 0))


def raw_calendar(spark: SparkSession, sf_dir: str, parsed: dict[str, Column] | None = None, over: Span | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Every day of every supplier, from the first shipment of all to the last; days with a shipment are taken. since, until: the
    first day wanted and the one after the last, so that no other days are made.

    Shipments and suppliers are dealt by listing once, over as many tasks as the days ask for, and summed by day there. Each
    day with a shipment makes itself and the free days up to the next one, so days are never joined, come in their order, and
    what is grouped by listing later needs no exchange of them. parsed: what the texts of a row say, by name, worked out once a
    stretch; the day is then there as parsed_date too."""
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    items = lineitem.select(F.col("l_suppkey").alias("listing_id"), F.to_date("l_shipdate").alias("d"), F.col("l_extendedprice").cast("decimal(12,2)").alias("p"), F.lit(0).alias("listed"))
    first, last, n = over or span(spark, sf_dir)
    # a supplier's own row, on the first day
    own = supplier.select(F.col("s_suppkey").alias("listing_id"), F.lit(first).cast("date").alias("d"), F.lit(None).cast("decimal(12,2)").alias("p"), F.lit(1).alias("listed"))
    dealt = items.where("listing_id IS NOT NULL").unionByName(own).repartition(n, "listing_id")
    summed = dealt.groupBy("listing_id", "d").agg(F.max("p").alias("day_price"), F.min("p").alias("least"), F.nullif(F.count_if(F.col("listed") == 0), F.lit(0)).alias("shipped"), F.sum("listed").alias("listed"))
    w = Window.partitionBy("listing_id").orderBy("d")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = summed.withColumns({"low_price": F.min("least").over(whole), "copies": F.sum("listed").over(whole).cast("int"), "after": F.lead("d").over(w)})
    stop = F.coalesce(F.date_sub("after", 1), F.lit(last).cast("date"))
    taken = F.struct(F.col("d").alias("start"), F.col("d").alias("stop"), "day_price", "shipped")
    free = F.when(stop > F.col("d"), F.struct(F.date_add("d", 1).alias("start"), stop.alias("stop"), F.lit(None).cast("decimal(12,2)").alias("day_price"), F.lit(None).cast("long").alias("shipped")))
    both = F.when(free.isNotNull(), F.array(taken, free)).otherwise(F.array(taken))
    stretches = summed.where("d IS NOT NULL AND copies > 0").select("listing_id", "low_price", "copies", F.inline(both))
    if since or until:
        low, high = F.lit(since).cast("date"), F.date_sub(F.lit(until).cast("date"), 1)
        stretches = stretches.withColumns({"start": F.greatest("start", low), "stop": F.least("stop", high)}).where("start <= stop")
    days = F.sequence(F.unix_date("start"), F.unix_date("stop"))  # numbers, as a sequence of dates goes by time zone
    days = F.when(F.col("copies") == 1, days).otherwise(F.flatten(F.array_repeat(days, F.col("copies"))))
    written = stretches.select(*[F.expr(e).alias(c) for c, e in CALENDAR_COLUMNS.items() if c != "date"], days.alias("days"))  # texts once a stretch
    each = written.withColumns(parsed or {}).withColumn("n", F.explode("days")).withColumn("d", F.date_from_unix_date("n"))
    return each.select(*[F.expr(CALENDAR_COLUMNS[c]).alias(c) if c == "date" else c for c in CALENDAR_COLUMNS], *([*parsed, F.col("d").alias("parsed_date")] if parsed else []))


def raw_reviews(spark: SparkSession, sf_dir: str, read: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A review of each order. Texts meet the orders last, dealt by document over as many tasks as the reviews ask for and in its
    order, so that no task writes or reads all texts, and equal ones lie side by side in what is stored. Every exchange has tasks
    by the rows of its tables. read: adds columns to the documents (doc_id, text), so once a document and not once a review."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = documents.count()
    documents = read(documents) if read else documents
    items, orders = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"), table(spark, sf_dir, "orders")
    many = orders.count()
    tasks, dealt = parts(spark, many, TEXTS), parts(spark, max(many, items.count()))
    owner = items.repartition(dealt, "l_orderkey").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("listing_id"))
    orders = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").cast("string").alias("day")).repartition(dealt, "o_orderkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name").repartition(dealt, "c_custkey")
    owned = orders.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).repartition(dealt, "o_custkey")
    joined = owned.join(customer, F.col("c_custkey") == F.col("o_custkey"))
    texts = documents.repartition(tasks, "doc_id").hint("merge")
    both = joined.withColumn("doc", F.col("o_orderkey") % n).repartition(tasks, "doc").join(texts, F.col("doc_id") == F.col("doc"), "left")
    return both.select(*[F.expr(e).alias(c) for c, e in REVIEW_COLUMNS.items()], *[c for c in documents.columns if c not in ("doc_id", "text")])


def bookings(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """A shipment's order and day. They are dealt by listing last, over the tasks given or as many as the shipments ask for, so that
    what is grouped by listing holds no listing in more than one task and needs no exchange."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("listing_id"), F.to_date("l_shipdate").alias("check_in"), (F.col("l_returnflag") == "R").alias("cancelled"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("booked_at"))
    n = parts(spark, items.count())
    both = items.repartition(n, "l_orderkey").join(orders.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).where("check_in >= booked_at")
    return both.select("listing_id", "booked_at", "check_in", "cancelled").repartition(tasks or n, "listing_id")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load metrics, one row a load."""
    return _select(table(spark, sf_dir, "events"), LEDGER_COLUMNS)
