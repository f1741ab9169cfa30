"""Incremental loads, versioned dimensions, checks, ledgers, files and streams on the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay import sources, streaming
from lodestay.functions import record_hash
from lodestay.operators import checks, incremental, marts, reporting
from lodestay.plans import bridge
from lodestay.plans.bridge import LEDGER_SQL, table
from lodestay.queries import Registry, b, flat, r
from lodestay.sources import loading
from lodestay.sources.history import History
from lodestay.sources.keyed import Keyed, upsert_latest

registry = Registry()
FIRST, SECOND, THIRD = "2002-01-01 00:00:00", "2002-02-01 00:00:00", "2002-03-01 00:00:00"
NOW = "2024-01-20 00:00:00"


def add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    registry.add(name, lambda spark, d: flat(query(spark, d)), sql)


def at(stamp: str) -> Column:
    return F.lit(stamp).cast("timestamp")


# Two batches of customers: the second changes every tenth balance and brings new keys.


def batch(spark: SparkSession, d: str, n: int) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("decimal(12,2)").alias("price"), F.col("c_mktsegment").alias("room_type"), (F.col("c_custkey") % 2 == 0).alias("host_is_superhost"), (F.col("c_custkey") % 5).cast("int").alias("minimum_nights"))
    if n > 1:
        changed = c.withColumn("price", F.when(F.col("id") % 10 == 0, F.col("price") + (n - 1) * 100).otherwise(F.col("price")))
        new = c.where(F.col("id") % 50 == 0).withColumn("id", F.col("id") + 10_000_000 * (n - 1))
        c = changed.union(new)
    return c.withColumns({"_ingested_at": at((FIRST, SECOND, THIRD)[n - 1]), "record_hash": record_hash("price", "room_type", "host_is_superhost", "minimum_nights")})


BATCH = {
    1: f"SELECT c_custkey AS id, c_acctbal::DECIMAL(12,2) AS price, c_mktsegment AS room_type, c_custkey % 2 = 0 AS host_is_superhost, (c_custkey % 5)::INT AS minimum_nights, TIMESTAMP '{FIRST}' AS _ingested_at FROM customer",
}
for _n, _stamp in ((2, SECOND), (3, THIRD)):
    BATCH[_n] = f"SELECT id, CASE WHEN id % 10 = 0 THEN price + {_n - 1} * 100 ELSE price END AS price, room_type, host_is_superhost, minimum_nights, TIMESTAMP '{_stamp}' AS _ingested_at FROM ({BATCH[1]}) UNION ALL SELECT id + {10_000_000 * (_n - 1)}, price, room_type, host_is_superhost, minimum_nights, TIMESTAMP '{_stamp}' FROM ({BATCH[1]}) WHERE id % 50 = 0"
PLAIN = ("id", "price", "room_type")


def dim(spark: SparkSession, d: str, n: int) -> DataFrame:
    out = incremental.scd2(None, batch(spark, d, 1), "id", FIRST)
    for k, stamp in ((2, SECOND), (3, THIRD))[: n - 1]:
        out = incremental.scd2(out, batch(spark, d, k), "id", stamp)
    return out


_OPEN = "'9999-12-31 23:59:59'"
_show = lambda df: df.select("id", "price", F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss").alias("valid_from"), F.date_format("valid_to", "yyyy-MM-dd HH:mm:ss").alias("valid_to"), "is_current", "version_sk")
_sk = lambda i, v: f"md5(({i})::VARCHAR || '-' || {v})"
_V1 = f"SELECT id, {r('price')} AS price, '{FIRST}' AS valid_from, {_OPEN} AS valid_to, TRUE AS is_current, {_sk('id', chr(39) + FIRST + chr(39))} AS version_sk FROM ({BATCH[1]})"
_V2 = f"""SELECT id, {r('price')} AS price, '{FIRST}' AS valid_from, CASE WHEN id % 10 = 0 THEN '{SECOND}' ELSE {_OPEN} END AS valid_to, id % 10 <> 0 AS is_current, {_sk('id', chr(39) + FIRST + chr(39))} AS version_sk FROM ({BATCH[1]})
  UNION ALL SELECT id, {r('price')}, '{SECOND}', {_OPEN}, TRUE, {_sk('id', chr(39) + SECOND + chr(39))} FROM ({BATCH[2]}) WHERE id % 10 = 0"""
add("scd2_build", lambda s, d: _show(dim(s, d, 1)), _V1)
add("scd2_apply_change", lambda s, d: _show(dim(s, d, 2)), _V2)


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """Three batches into a stored dimension."""
    history = History(spark, f"{sources.work_dir(spark)}/customers", "id")
    for n, stamp in enumerate((FIRST, SECOND, THIRD), 1):
        history.apply(batch(spark, d, n), stamp)
    return history.read()


_V3 = f"""SELECT id, {r('price')} AS price, '{FIRST}' AS valid_from, CASE WHEN id % 10 = 0 THEN '{SECOND}' ELSE {_OPEN} END AS valid_to, id % 10 <> 0 AS is_current, {_sk('id', chr(39) + FIRST + chr(39))} AS version_sk FROM ({BATCH[1]})
  UNION ALL SELECT id, {r('price')}, '{SECOND}', CASE WHEN id < 10000000 THEN '{THIRD}' ELSE {_OPEN} END, id >= 10000000, {_sk('id', chr(39) + SECOND + chr(39))} FROM ({BATCH[2]}) WHERE id % 10 = 0
  UNION ALL SELECT id, {r('price')}, '{THIRD}', {_OPEN}, TRUE, {_sk('id', chr(39) + THIRD + chr(39))} FROM ({BATCH[3]}) WHERE id % 10 = 0"""
add("scd2_stored", lambda s, d: _show(_stored(s, d)), _V3)
add("scd1_current", lambda s, d: incremental.scd1(dim(s, d, 2)).select("id", "price", F.date_format("last_updated_at", "yyyy-MM-dd").alias("last_updated_at")), f"SELECT id, price, substr(valid_from, 1, 10) AS last_updated_at FROM ({_V2}) WHERE is_current")
add("scd3_prev_original", lambda s, d: incremental.scd3(dim(s, d, 3), "id").select("id", "current_price", "previous_price", "original_price", "price_changed", "price_percent_change", "room_type_changed"),
    f"""SELECT id, {r('c')} AS current_price, {r('p')} AS previous_price, {r('o')} AS original_price, coalesce(c <> coalesce(p, c), FALSE) AS price_changed, CASE WHEN p IS NOT NULL AND c <> p THEN coalesce({r('(c::DOUBLE - p::DOUBLE) / nullif(p::DOUBLE, 0) * 100', 2)}, NULL) ELSE 0 END AS price_percent_change, FALSE AS room_type_changed FROM
    (SELECT id, CASE WHEN id % 10 = 0 AND id < 10000000 THEN price + 200 ELSE price END AS c, CASE WHEN id % 10 = 0 AND id < 10000000 THEN price + 100 END AS p, price AS o FROM ({BATCH[1]})
     UNION ALL SELECT id, price, NULL, price FROM ({BATCH[2]}) WHERE id >= 10000000 UNION ALL SELECT id, price, NULL, price FROM ({BATCH[3]}) WHERE id >= 10000000)""")
add("change_detection", lambda s, d: incremental.detect_changes(batch(s, d, 2), batch(s, d, 1), "id").select("id", "requires_change"), f"SELECT id, id % 10 = 0 AS requires_change FROM ({BATCH[2]})")
add("incremental_watermark", lambda s, d: incremental.above_watermark(table(s, d, "events"), table(s, d, "events").where("event_id % 3 = 0 AND ts < timestamp '2024-01-15 00:00:00'"), "ts").select("event_id"),
    "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 3 = 0 AND ts < TIMESTAMP '2024-01-15 00:00:00')")
add("upsert_single_key", lambda s, d: incremental.upsert(batch(s, d, 1), batch(s, d, 2).where("id % 10 = 0"), ["id"]).select(*PLAIN), f"SELECT id, {r('price')} AS price, room_type FROM ({BATCH[2]})")
_lines = lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
add("upsert_composite_key", lambda s, d: incremental.upsert(_lines(s, d), _lines(s, d).where("l_linenumber = 2").withColumn("l_quantity", F.col("l_quantity") + 1), ["l_orderkey", "l_linenumber"]), f"SELECT l_orderkey, l_linenumber, {r('l_quantity + CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END')} AS l_quantity FROM lineitem")
add("merge_upsert", lambda s, d: incremental.merge(batch(s, d, 1), batch(s, d, 2), ["id"], ["price"]).select(*PLAIN), f"SELECT id, {r('price')} AS price, room_type FROM ({BATCH[2]})")
add("schema_append_columns", lambda s, d: incremental.append_new_columns(table(s, d, "nation").select("n_nationkey"), table(s, d, "nation").select("n_nationkey", "n_name")), "SELECT n_nationkey, NULL AS n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
_rev = lambda s, d, cond: marts.dim_reviewers(bridge.raw_reviews(s, d).where(cond).select("reviewer_id", "reviewer_name", F.col("date").alias("review_date"), "listing_id"))
add("dim_refresh_changed", lambda s, d: incremental.refresh_changed(_rev(s, d, "TRUE"), _rev(s, d, "id % 5 <> 0"), ["reviewer_id", "reviewer_name"], "last_review_date", "total_reviews").select("reviewer_id", "total_reviews"),
    f"WITH v AS ({bridge.REVIEWS_SQL}) SELECT reviewer_id, count(*) AS total_reviews FROM v GROUP BY reviewer_id, reviewer_name HAVING count(*) FILTER (id % 5 = 0) > 0")

# Checks.
_c = lambda s, d, t: table(s, d, t)
_day = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))"
_WHEN = f"CASE WHEN o_orderkey % 97 = 0 THEN 'soon' WHEN o_orderkey % 3 = 0 THEN {_day} WHEN o_orderkey % 3 = 1 THEN concat({_day}, ' 10:20:30') ELSE concat({_day}, 'T10:20:30.25') END"
_bad = lambda f: f"count(*) FILTER (try_strptime(t, '{f}') IS NULL)"
add("check_timestamp", lambda s, d: checks.timestamp_formats(table(s, d, "orders").select(F.expr(_WHEN).alias("t")), "t"),
    f"SELECT *, least(bad_0, bad_1, bad_2) = 0 AS valid FROM (SELECT {_bad('%Y-%m-%dT%H:%M:%S.%f')} AS bad_0, {_bad('%Y-%m-%d %H:%M:%S')} AS bad_1, {_bad('%Y-%m-%d')} AS bad_2 FROM (SELECT {_WHEN} AS t FROM orders))")
add("check_json", lambda s, d: checks.bad_json(table(s, d, "events").select("event_id", F.when(F.col("event_id") % 100 == 0, F.lit("{bad")).otherwise(F.col("props")).alias("props")), "props").select("event_id"), "SELECT event_id FROM events WHERE event_id % 100 = 0")
_amen = lambda s, d: bridge.raw_listings(s, d).withColumn("amenities", F.when(F.col("id") % 7 == 0, "[x").otherwise(F.col("amenities")))
add("check_array", lambda s, d: _amen(s, d).select("id", F.array_join(checks.array_items("amenities"), "|").alias("items")).select("id", F.regexp_replace("items", '"', "").alias("items")),
    "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CASE s_suppkey % 3 WHEN 0 THEN 'Wifi|Kitchen' WHEN 1 THEN 'Wifi|Heating' ELSE 'Wifi' END END AS items FROM supplier")
add("check_future_dates", lambda s, d: checks.future_dates(table(s, d, "orders"), "o_orderdate", "2000-01-01 00:00:00").select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'")
add("check_negative", lambda s, d: checks.negative(table(s, d, "customer"), ["c_acctbal", "c_nationkey"]), "SELECT count(*) FILTER (c_acctbal < 0) AS c_acctbal, count(*) FILTER (c_nationkey < 0) AS c_nationkey FROM customer")
add("check_email", lambda s, d: checks.bad_emails(table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 == 0, F.col("c_name")).otherwise(F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@example.com"))).alias("e")), "e").select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_custkey % 9 = 0")
add("check_unique", lambda s, d: checks.not_unique(table(s, d, "orders"), "o_custkey"), "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
add("check_not_null", lambda s, d: checks.is_null(table(s, d, "customer").withColumn("x", F.nullif(F.col("c_nationkey"), F.lit(3))), "x").select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_nationkey = 3")
add("check_accepted_values", lambda s, d: checks.not_accepted(table(s, d, "orders"), "o_orderstatus", ["F", "O"]), "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
add("check_relationships", lambda s, d: checks.orphans(table(s, d, "customer"), "c_custkey", table(s, d, "orders").where("o_orderstatus = 'P'"), "o_custkey").select("c_custkey"), "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
add("check_expression", lambda s, d: checks.breaks(table(s, d, "lineitem"), "l_quantity >= 3").groupBy("l_linestatus").agg(F.count("*").alias("n")), "SELECT l_linestatus, count(*) AS n FROM lineitem WHERE NOT l_quantity >= 3 GROUP BY 1")
add("check_range", lambda s, d: checks.out_of_range(table(s, d, "part"), "p_size", 5, 45).select("p_partkey"), "SELECT p_partkey FROM part WHERE p_size < 5 OR p_size > 45")
add("check_not_null_proportion", lambda s, d: checks.not_null_proportion(table(s, d, "customer").withColumn("x", F.nullif(F.col("c_nationkey"), F.lit(3))), "x", 0.9), f"SELECT {r('count(nullif(c_nationkey, 3))::DOUBLE / count(*)')} AS proportion, count(nullif(c_nationkey, 3))::DOUBLE / count(*) >= 0.9::DOUBLE AS valid FROM customer")
add("check_unique_combination", lambda s, d: checks.not_unique(table(s, d, "lineitem"), "l_suppkey", "l_partkey"), "SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
_fresh = lambda s, d: table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
add("check_freshness", lambda s, d: checks.freshness_status(_fresh(s, d).withColumns({"b": F.col("ts") + F.expr("interval 24 hours"), "c": F.col("ts") + F.expr("interval 23 hours")}), "ts", "b", "c", at(NOW)).groupBy("freshness_status").agg(F.count("*").alias("n")),
    f"SELECT CASE WHEN ts < TIMESTAMP '{NOW}' - INTERVAL 24 HOURS THEN 'stale_scrape' WHEN ts + INTERVAL 24 HOURS < TIMESTAMP '{NOW}' - INTERVAL 1 HOUR THEN 'stale_ingest' WHEN ts + INTERVAL 23 HOURS < TIMESTAMP '{NOW}' - INTERVAL 1 HOUR THEN 'stale_load' ELSE 'fresh' END AS freshness_status, count(*) AS n FROM events GROUP BY 1")
add("freshness_metrics", lambda s, d: marts.freshness(_fresh(s, d).withColumn("b", F.col("ts") + F.expr("interval 24 hours")), "ts", "b", "b", at(NOW)).select("record_count", "fresh_records_24h", "record_span_hours", "ingestion_span_hours", "fresh_records_percentage"),
    f"SELECT count(*) AS record_count, count(*) FILTER (ts + INTERVAL 24 HOURS >= TIMESTAMP '{NOW}' - INTERVAL 24 HOURS) AS fresh_records_24h, {r('(epoch_us(max(ts)) - epoch_us(min(ts)))::DOUBLE / 3.6e9')} AS record_span_hours, {r('(epoch_us(max(ts)) - epoch_us(min(ts)))::DOUBLE / 3.6e9')} AS ingestion_span_hours, {r('count(*) FILTER (ts + INTERVAL 24 HOURS >= TIMESTAMP ' + chr(39) + NOW + chr(39) + ' - INTERVAL 24 HOURS)::DOUBLE / count(*) * 100.0')} AS fresh_records_percentage FROM events")
add("verify_range", lambda s, d: checks.verify_range(table(s, d, "orders"), "o_orderkey", 100, 1100, [("o_totalprice", "o_totalprice > 50000", "too cheap"), ("o_orderstatus", "o_orderstatus = 'F'", "not final")]),
    "SELECT count(*) AS rows, 'o_totalprice' AS column_name, 'too cheap' AS message, count(*) FILTER (NOT o_totalprice > 50000) AS failures FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 1100 UNION ALL SELECT count(*), 'o_orderstatus', 'not final', count(*) FILTER (o_orderstatus <> 'F') FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 1100")
ASKED = {"order_id": "CAST(o_orderkey AS VARCHAR(20))", "placed": _day, "settled": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 't' END", "customer": "concat('{', CAST(o_custkey AS VARCHAR(20)), '}')", "status": "o_orderstatus", "price": "o_totalprice"}
_asked = lambda s, d: table(s, d, "orders").select(*[F.expr(e).alias(n) for n, e in ASKED.items()])
_kind = lambda c: "'DOUBLE PRECISION'" if c == "price" else "CASE " + " ".join(f"WHEN count({c}) > 0 AND count(*) FILTER (regexp_matches({c}, '{p}')) = count({c}) THEN '{k}'" for k, p in checks.TEXT_TYPES.items()) + " ELSE 'TEXT' END"
INFERRED = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS filled, {_kind(c)} AS logical_type FROM (SELECT {e} AS {c} FROM orders)" for c, e in ASKED.items())
add("infer_types", lambda s, d: checks.infer_types(_asked(s, d)), INFERRED)
_STORED = {"order_id": "INTEGER", "placed": "TIMESTAMP", "settled": "BOOLEAN", "customer": "JSON", "status": "BIGINT", "price": "NUMERIC"}
add("schema_compatible", lambda s, d: checks.compatible(checks.infer_types(_asked(s, d)), _STORED),
    f"""SELECT column_name, logical_type, stored, CASE WHEN stored = logical_type THEN 'same' WHEN stored = 'INTEGER' AND logical_type = 'BIGINT' THEN 'narrowing'
      WHEN stored = 'NUMERIC' AND logical_type IN ('BIGINT', 'DOUBLE PRECISION') OR stored = 'JSON' AND logical_type = 'JSONB' THEN 'compatible' ELSE 'incompatible' END AS verdict
    FROM ({INFERRED}) JOIN (VALUES {', '.join(f"('{c}', '{t}')" for c, t in _STORED.items())}) AS v(column_name, stored) USING (column_name)""")
add("check_required_columns", lambda s, d: checks.required_columns(_asked(s, d), ["order_id", "settled", "comment"]), f"SELECT 'order_id' AS column_name, TRUE AS present, count(*) AS filled FROM orders UNION ALL SELECT 'settled', TRUE, count({ASKED['settled']}) FROM orders UNION ALL SELECT 'comment', FALSE, 0")

# Ledgers.
_L = lambda s, d: bridge.ledger(s, d).withColumn("start_time", F.col("start_time").cast("timestamp"))
L = f"({LEDGER_SQL})"
_cnt = lambda v: f"count(*) FILTER (processing_status = '{v}')"
add("metrics_summary", lambda s, d: reporting.metrics_summary(_L(s, d)), f"SELECT count(DISTINCT file_name) AS total_files, {b('sum(rows_processed)')} AS total_rows_processed, {b('sum(rows_inserted)')} AS total_rows_inserted, {b('sum(rows_failed)')} AS total_rows_failed, {_cnt('COMPLETED')} AS successful_files, {_cnt('FAILED')} AS failed_files FROM {L}")
add("load_summary", lambda s, d: reporting.load_summary(_L(s, d)), f"SELECT count(DISTINCT file_name) AS total_files, {b('sum(rows_processed)')} AS total_rows, max(file_size_bytes) AS max_file_size, {r('sum(file_size_bytes)::DOUBLE / count(*)')} AS avg_file_size FROM {L} WHERE processing_status = 'COMPLETED'")
add("load_operations", lambda s, d: reporting.load_operations(_L(s, d), "raw_reviews", ["b1", "b4", "b7"]).select("event_id", "file_name", "batch_id", "rows_processed"), f"SELECT event_id, file_name, batch_id, rows_processed FROM {L} WHERE table_name = 'raw_reviews' AND batch_id IN ('b1', 'b4', 'b7')")
add("batch_status", lambda s, d: reporting.batch_status(_L(s, d)), f"SELECT batch_id, count(*) AS total, {_cnt('COMPLETED')} AS completed, {_cnt('FAILED')} AS failed, {_cnt('IN_PROGRESS')} AS in_progress, {_cnt('PENDING')} AS pending, {b('sum(rows_processed)')} AS rows, CASE WHEN {_cnt('FAILED')} > 0 THEN 'FAILED' WHEN {_cnt('COMPLETED')} = count(*) THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS status FROM {L} GROUP BY batch_id")
add("retry_candidates", lambda s, d: reporting.retry_candidates(_L(s, d), at(NOW)).select("event_id", "processing_status"), f"SELECT event_id, processing_status FROM {L} WHERE processing_status = 'PENDING' OR processing_status = 'FAILED' AND retry_count < 3 AND start_time + to_minutes(retry_count * 5) <= TIMESTAMP '{NOW}' ORDER BY start_time, event_id LIMIT 100")
add("retry_state", lambda s, d: reporting.retry_state(_L(s, d).where("processing_status = 'FAILED'")).select("file_name", "batch_id", "retry_count", "last_failure", "last_error", F.date_format("next_retry_at", "yyyy-MM-dd HH:mm:ss").alias("next_retry_at")),
    f"SELECT file_name, batch_id, count(*) AS retry_count, arg_max(event_id, (start_time, event_id)) AS last_failure, arg_max(error_message, (start_time, event_id)) AS last_error, CASE WHEN count(*) < 3 THEN strftime(max(start_time) + INTERVAL 5 MINUTES, '%Y-%m-%d %H:%M:%S') END AS next_retry_at FROM {L} WHERE processing_status = 'FAILED' GROUP BY 1, 2")
add("recovery_prune", lambda s, d: reporting.recovery_prune(_L(s, d), at(NOW)).select("event_id"), f"SELECT event_id FROM {L} WHERE start_time < TIMESTAMP '{NOW}' - INTERVAL 7 DAYS AND (processing_status = 'COMPLETED' OR retry_count >= 3)")
add("table_metadata", lambda s, d: reporting.table_metadata(_L(s, d)).withColumn("processed_at", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss")), f"SELECT table_name, arg_max(file_name, (start_time, event_id)) AS last_file_processed, strftime(max(start_time), '%Y-%m-%d %H:%M:%S') AS processed_at, {b('sum(rows_processed)')} AS total_rows FROM {L} GROUP BY 1")
add("file_status", lambda s, d: reporting.file_status(_L(s, d), "b7"), f"SELECT file_name, processing_status, rows_processed FROM {L} WHERE batch_id = 'b7' QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY start_time DESC, event_id DESC) = 1")
add("ledger_latest", lambda s, d: reporting.ledger_latest(_L(s, d)).select("file_name", "batch_id", "event_id", "processing_status"), f"SELECT file_name, batch_id, event_id, processing_status FROM {L} QUALIFY row_number() OVER (PARTITION BY file_name, batch_id ORDER BY start_time DESC, event_id DESC) = 1")
_part = lambda s, d, k: _L(s, d).where(F.col("event_id") % 3 == k)
_newest = lambda: (F.desc("start_time"), F.desc("event_id"))
add("ledger_upsert", lambda s, d: incremental.upsert_log(incremental.upsert_log(reporting.ledger_latest(_part(s, d, 1)), _part(s, d, 0), ["file_name", "batch_id"], *_newest()), _part(s, d, 2), ["file_name", "batch_id"], *_newest()).select("file_name", "batch_id", "event_id", "processing_status"),
    f"SELECT file_name, batch_id, event_id, processing_status FROM {L} QUALIFY row_number() OVER (PARTITION BY file_name, batch_id ORDER BY start_time DESC, event_id DESC) = 1")
_DAILY = "concat(batch_id, '-', file_name, '-', CAST(CAST(start_time AS DATE) AS VARCHAR(10)))"
add("retention_expired", lambda s, d: reporting.retention_expired(_L(s, d).withColumn("batch_id", F.expr(_DAILY)), at("2024-04-20 00:00:00")).select("table_name", "batch_id"), f"SELECT table_name, {_DAILY} AS batch_id FROM {L} GROUP BY ALL HAVING count(*) FILTER (processing_status = 'IN_PROGRESS') = 0 AND max(start_time) < TIMESTAMP '2024-04-20 00:00:00' - INTERVAL 90 DAYS")

# Files, written from the tables first, and batches.
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
_orders = lambda s, d: table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def written(spark: SparkSession, d: str) -> str:
    """The orders as gzipped CSV in a folder named for the entity."""
    path = f"{sources.work_dir(spark)}/raw"
    _orders(spark, d).write.option("header", True).option("compression", "gzip").csv(f"{path}/orders")
    return path


add("null_nan_normalize", lambda s, d: sources.nan_to_null(table(s, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("s_acctbal")).alias("v"))), f"SELECT s_suppkey, CASE WHEN s_suppkey % 3 <> 0 THEN {r('s_acctbal')} END AS v FROM supplier")
add("scan_csv_gz", lambda s, d: sources.read_csv_gz(s, written(s, d), ORDERS, 8), f"SELECT o_orderkey, o_custkey, o_orderstatus, {r('o_totalprice')} AS o_totalprice FROM orders")
def _scan(spark: SparkSession, d: str) -> DataFrame:
    path = written(spark, d)
    rows = sources.read_csv_gz(spark, path, ORDERS).groupBy("o_orderstatus").agg(F.count("*").alias("rows"))
    return rows.crossJoin(sources.fingerprints(spark, path).agg((F.count("*") > 0).alias("found"), F.bool_and(F.col("file_name").endswith(".csv.gz")).alias("all_gz")))


add("scan_glob", _scan, "SELECT o_orderstatus, count(*) AS rows, TRUE AS found, TRUE AS all_gz FROM orders GROUP BY 1")
add("entity_from_path", lambda s, d: table(s, d, "orders").groupBy(sources.entity(F.concat(F.lit("s3://in/2024/Orders_"), "o_orderstatus", F.lit(".v1.csv.gz"))).alias("entity")).agg(F.count("*").alias("n")), "SELECT 'orders_' || lower(o_orderstatus) AS entity, count(*) AS n FROM orders GROUP BY 1")


def _by_status(spark: SparkSession, d: str) -> str:
    """The orders as gzipped CSV, a file for each status."""
    path = f"{sources.work_dir(spark)}/raw"
    for (status,) in _orders(spark, d).select("o_orderstatus").distinct().collect():
        _orders(spark, d).where(F.col("o_orderstatus") == status).coalesce(1).write.option("header", True).option("compression", "gzip").csv(f"{path}/orders_{status}")
    return path


def _skip(spark: SparkSession, d: str) -> DataFrame:
    """Files of final orders are in; those of open ones are not, as their load failed."""
    path = _by_status(spark, d)
    files = sources.fingerprints(spark, path)
    done = files.withColumn("status", F.when(F.col("file_name").contains("orders_F"), "COMPLETED").otherwise("FAILED"))
    left = [r[0] for r in sources.new_files(files, done).select("file_name").collect()]  # a file each
    return sources.read_csv_gz(spark, left, ORDERS).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


add("skip_processed_files", _skip, f"SELECT o_orderstatus, count(*) AS n, {b('sum(o_custkey)')} AS keys FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")


def _changed(spark: SparkSession, d: str) -> DataFrame:
    """Files by status are loaded; then one comes again under another name, and another is replaced under its own."""
    path, work = _by_status(spark, d), sources.work_dir(spark)
    run = lambda: loading.ingest_changed(spark, path, ORDERS, f"{work}/bronze", f"{work}/files")
    run()
    put = lambda rows, name, mode: rows.coalesce(1).write.mode(mode).option("header", True).option("compression", "gzip").csv(f"{path}/{name}")
    put(_orders(spark, d).where("o_orderstatus = 'F'"), "again", "append")
    files, at = sources.folder(spark, next(f for f in spark.read.parquet(f"{work}/files").select("file_name").toPandas().file_name if "orders_O" in f))
    more = _orders(spark, d).where("o_orderstatus = 'O' AND o_custkey % 2 = 0")
    put(more, "replacement", "append")
    new = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").load(f"{path}/replacement").select("path").first()[0]
    files.delete(at, False)
    files.rename(sources.folder(spark, new)[1], at)
    run()
    run()  # finds nothing
    stored = spark.read.parquet(f"{work}/bronze").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    logged = loading.read_files(spark, f"{work}/files").agg(F.count_if(F.col("status") == "SKIPPED").alias("skipped"), F.sum("rows_processed").alias("logged"))
    return stored.join(F.broadcast(logged))


add("ingest_changed_files", _changed, f"""SELECT o_orderstatus, count(*) + count(*) FILTER (o_orderstatus = 'O' AND o_custkey % 2 = 0) AS n, 1 AS skipped,
  (SELECT {b("count(*) + count(*) FILTER (o_orderstatus = 'O' AND o_custkey % 2 = 0)")} FROM orders) AS logged FROM orders GROUP BY 1""")


def _inferred(spark: SparkSession, d: str) -> DataFrame:
    """CSV without a schema: the types are found in the values, and sums need no cast."""
    df = sources.read_csv_gz(spark, written(spark, d))
    kinds = F.concat_ws(",", *[F.typeof(c) for c in df.columns])
    return df.groupBy("o_orderstatus", kinds.alias("types")).agg(F.sum("o_orderkey").alias("order_keys"), F.sum("o_totalprice").alias("price"), F.max("o_custkey").cast("long").alias("customer"))


_kind_of = lambda c: f"(SELECT CASE WHEN max({c}) < 2147483648 THEN 'int' ELSE 'bigint' END FROM orders)"
add("scan_csv_inferred", _inferred, f"SELECT o_orderstatus, {_kind_of('o_orderkey')} || ',' || {_kind_of('o_custkey')} || ',string,double' AS types, {b('sum(o_orderkey)')} AS order_keys, {r('sum(o_totalprice)')} AS price, max(o_custkey) AS customer FROM orders GROUP BY 1")


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    path = f"{sources.work_dir(spark)}/bronze"
    for k in (0, 1):
        loading.append_batch(_orders(spark, d).where(F.col("o_orderkey") % 2 == k), path, f"b{k}", f"orders_{k}.csv.gz", at(FIRST))
    loading.append_batch(_orders(spark, d).where("o_orderkey % 2 = 1"), path, "b1", "orders_1.csv.gz", at(FIRST))  # again: replaces itself
    return spark.read.parquet(path)


add("bronze_append", lambda s, d: _bronze(s, d).select("o_orderkey", "_batch_id", "_file_name"), "SELECT o_orderkey, 'b' || (o_orderkey % 2) AS _batch_id, 'orders_' || (o_orderkey % 2) || '.csv.gz' AS _file_name FROM orders")
add("batch_row_count", lambda s, d: sources.batch_counts(_bronze(s, d)), "SELECT 'b' || (o_orderkey % 2) AS _batch_id, count(*) AS rows FROM orders GROUP BY 1")


def _rollback(spark: SparkSession, d: str) -> DataFrame:
    """A batch that fails while it is written leaves no rows."""
    path = f"{sources.work_dir(spark)}/bronze"
    loading.append_batch(_orders(spark, d), path, "good", "orders.csv.gz", at(FIRST))
    broken = _orders(spark, d).withColumn("o_orderstatus", F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("broken row"))).otherwise(F.col("o_orderstatus")))
    try:
        loading.append_batch(broken, path, "bad", "orders.csv.gz", at(FIRST))
    except Exception as e:  # noqa: BLE001  the point of the query
        if "broken row" not in str(e):
            raise
    return sources.batch_counts(spark.read.parquet(path))


add("bronze_rollback", _rollback, "SELECT 'good' AS _batch_id, count(*) AS rows FROM orders")
add("materialize", lambda s, d: sources.materialize(_orders(s, d), "table", "orders", sources.work_dir(s)).join(sources.materialize(_orders(s, d), "view", "orders_view").select("o_orderkey"), "o_orderkey").agg(F.count("*").alias("n")), "SELECT count(*) AS n FROM orders")


def _loads(spark: SparkSession, d: str) -> tuple[str, str, str]:
    """Gzipped files of orders by remainder of four, with their digests. Two are loaded, the second once more; the next is
    refused as its price is text, the last as some of its orders are too cheap."""
    work = sources.work_dir(spark)
    path, metrics, snapshots = (f"{work}/{x}" for x in ("bronze", "metrics", "snapshots"))
    rules = [checks.row_rule("cheap", "o_totalprice < 1500 AND o_orderkey % 4 = 3"), checks.row_rule("dear", "o_totalprice > 300000", fatal=False), checks.not_null_rule("o_custkey")]
    for k in (0, 1, 1, 2, 3):
        name = f"orders_{k}.csv.gz"
        if not sources.exists(spark, f"{work}/raw/{name}"):
            _orders(spark, d).where(F.col("o_orderkey") % 4 == k).coalesce(1).write.option("header", True).option("compression", "gzip").csv(f"{work}/raw/{name}")
        file = sources.fingerprints(spark, f"{work}/raw/{name}").first()  # one
        rows = sources.read_csv_gz(spark, file.file_name, ORDERS)
        rows = rows.withColumn("o_totalprice", F.col("o_totalprice").cast("string")) if k == 2 else rows.withColumn("source_quarter", F.lit(k)) if k == 1 else rows
        try:
            loading.load(rows, path, metrics, "orders", f"b{k}", name, file.file_hash, file.file_size_bytes, at(FIRST), ["o_orderkey", "o_custkey"], rules, snapshots)
        except ValueError as e:
            if "o_totalprice" not in str(e) and "cheap" not in str(e):
                raise
    return path, metrics, snapshots


def _recorded(spark: SparkSession, d: str) -> DataFrame:
    path, metrics, _ = _loads(spark, d)
    counts = sources.batch_counts(spark.read.parquet(path)).withColumnRenamed("rows", "stored")
    shown = loading.read_metrics(spark, metrics).join(counts, F.col("batch_id") == F.col("_batch_id"), "left")
    return shown.select("file_name", "table_name", "batch_id", "processing_status", "rows_processed", "rows_inserted", "rows_failed", "failed_rules", F.col("error_message").isNotNull().alias("failed"), F.length("file_hash").alias("digest"), F.coalesce("stored", F.lit(0)).alias("stored"))


_CHEAP = "count(*) FILTER (o_totalprice < 1500 AND o_orderkey % 4 = 3)"


def _quarter(k: int, status: str) -> str:
    """The metrics of a file, from its orders; a file of which none breaks a rule would be stored in any case."""
    n, read = f"count(*) FILTER (o_orderkey % 4 = {k})", status == "COMPLETED" or k == 3
    dear = f"count(*) FILTER (o_totalprice > 300000 AND o_orderkey % 4 = {k})"
    rules = [f"CASE WHEN {c} > 0 THEN '\"{name}\":' || {c} END" for name, c in (("cheap", _CHEAP if k == 3 else "0"), ("dear", dear))]
    ok = f"({_CHEAP} = 0)" if k == 3 else str(status == "COMPLETED").upper()
    stored = f"CASE WHEN {ok} THEN {n} ELSE 0 END"
    return f"""SELECT 'orders_{k}.csv.gz' AS file_name, 'orders' AS table_name, 'b{k}' AS batch_id, {f"CASE WHEN {ok} THEN 'COMPLETED' ELSE 'FAILED' END" if k == 3 else f"'{status}'"} AS processing_status, {n if read else 0} AS rows_processed, {stored} AS rows_inserted,
      {_CHEAP if k == 3 else 0} AS rows_failed, {f"'{{' || concat_ws(',', {', '.join(rules)}) || '}}'" if read else "'{}'"} AS failed_rules, {f"NOT {ok}" if k == 3 else str(status == "FAILED").upper()} AS failed, 32 AS digest, {n if k < 2 else stored} AS stored FROM orders"""


add("load_with_metrics", _recorded, " UNION ALL ".join([_quarter(0, "COMPLETED"), _quarter(1, "COMPLETED"), _quarter(1, "SKIPPED"), _quarter(2, "FAILED"), _quarter(3, "FAILED")]))


def _schemas(spark: SparkSession, d: str) -> DataFrame:
    """What the loads left of the table's schema, and where the table stands."""
    _, metrics, snapshots = _loads(spark, d)
    kept = loading.read_snapshots(spark, snapshots)
    now = loading.table_state(loading.read_metrics(spark, metrics), kept).select("table_name", "total_rows", F.col("last_file_processed").alias("last_file"), F.col("processed_at").isNotNull().alias("processed"))
    return kept.select("table_name", "number", F.array_join("added", ",").alias("added"), F.size("removed").alias("removed"), F.col("last_file_processed").alias("file_name"), F.size(F.map_keys(F.from_json("schema_snapshot", "map<string,string>"))).alias("columns")).join(now, "table_name")


_OKS = f"(SELECT {_CHEAP} = 0 FROM orders)"
_rows = f"(SELECT count(*) FROM orders WHERE o_orderkey % 4 < 2 OR {_OKS} AND o_orderkey % 4 = 3)"
_cols = "(SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders))"
add("schema_snapshots", _schemas, f"""SELECT 'orders' AS table_name, number, CASE number WHEN 1 THEN {_cols} ELSE 'source_quarter' END AS added, 0 AS removed, 'orders_' || (number - 1) || '.csv.gz' AS file_name, number + 3 AS columns,
  {_rows} AS total_rows, CASE WHEN {_OKS} THEN 'orders_3.csv.gz' ELSE 'orders_1.csv.gz' END AS last_file, TRUE AS processed FROM (SELECT unnest([1, 2]) AS number)""")


def _expire(spark: SparkSession, d: str) -> DataFrame:
    """A year of orders is a batch; those past retention are dropped."""
    path = f"{sources.work_dir(spark)}/bronze"
    rows = table(spark, d, "orders").withColumns({"_batch_id": F.concat(F.lit("y"), F.year("o_orderdate")), "start_time": F.col("o_orderdate").cast("timestamp")})
    rows.write.partitionBy("_batch_id").parquet(path)
    ledger = rows.select(F.lit("orders").alias("table_name"), F.col("_batch_id").alias("batch_id"), "start_time", F.lit("COMPLETED").alias("processing_status"))
    sources.drop_batches(spark, path, reporting.retention_expired(ledger, at("2000-01-01 00:00:00")).select(F.col("batch_id").alias("_batch_id")))
    return sources.batch_counts(spark.read.parquet(path))


add("retention_drop", _expire, "SELECT 'y' || year(o_orderdate) AS _batch_id, count(*) AS rows FROM orders GROUP BY 1 HAVING max(o_orderdate) >= TIMESTAMP '2000-01-01 00:00:00' - INTERVAL 90 DAYS")


def _report(spark: SparkSession, d: str) -> DataFrame:
    path = f"{sources.work_dir(spark)}/report"
    sources.write_report(reporting.load_operations(_L(spark, d)), path)
    return spark.read.json(f"{path}/summary")


add("load_report", _report, f"SELECT count(*) AS operations, {b('sum(rows_processed)')} AS rows_processed, {_cnt('COMPLETED')} AS completed FROM {L}")


# Streams.


def _ingest(spark: SparkSession, d: str) -> DataFrame:
    raw, work = written(spark, d), sources.work_dir(spark)
    for _ in range(2):  # the second run finds nothing new
        streaming.ingest(spark, raw, ORDERS, f"{work}/bronze", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/bronze").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("keys"))


add("stream_ingest", _ingest, "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM orders GROUP BY 1")


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    path = f"{sources.work_dir(spark)}/{name}"
    table(spark, d, name).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def _upserts(spark: SparkSession, d: str) -> DataFrame:
    """Three files, a micro-batch each: later ones hold every second and every third customer with a newer version."""
    work = sources.work_dir(spark)
    for k in (1, 2, 3):
        rows = table(spark, d, "customer").where(F.col("c_custkey") % k == 0).select("c_custkey", F.concat("c_mktsegment", F.lit(f" {k}")).alias("segment"), F.lit(k).alias("version"))
        rows.coalesce(1).write.mode("append").parquet(f"{work}/in")
    stream = spark.readStream.schema("c_custkey bigint, segment string, version int").option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    streaming.upsert_stream(stream, f"{work}/customers", ["c_custkey"], f"{work}/checkpoint", [F.desc("version"), F.asc("segment")])
    return Keyed(spark, f"{work}/customers", ["c_custkey"]).read()


_version = "CASE WHEN c_custkey % 3 = 0 THEN 3 WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END"
add("stream_upsert", _upserts, f"SELECT c_custkey, c_mktsegment || ' ' || {_version} AS segment, {_version} AS version FROM customer")


def _dedup(spark: SparkSession, d: str) -> DataFrame:
    work = sources.work_dir(spark)
    events = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    unique = streaming.dedup_stream(events, ["event_id"], "ts", "40 days").select("event_id", "event_type")
    streaming.run(unique, lambda b_, n: b_.write.mode("overwrite").parquet(f"{work}/out/n={n}"), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").groupBy("event_type").agg(F.count("*").alias("n"))


add("stream_dedup", _dedup, "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1")


def _late(spark: SparkSession, d: str) -> DataFrame:
    """Events in three triggers, the watermark two days behind: the first half of the month; the rest, with the last day of the
    first half again; and new rows of the first days, which come too late."""
    work = sources.work_dir(spark)
    events = table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    day_ = F.dayofmonth("ts")
    late = events.where(day_ <= 5).withColumn("event_id", F.col("event_id") + 1_000_000_000)
    for part in (events.where(day_ <= 15), events.where(day_ >= 15), late):
        part.coalesce(1).write.mode("append").parquet(f"{work}/in")
    stream = spark.readStream.schema("event_id long, event_type string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
    query = streaming.run(streaming.dedup_stream(stream, ["event_id"], "ts", "2 days"), lambda b_, n: b_.write.mode("overwrite").parquet(f"{work}/out/n={n}"), f"{work}/checkpoint")
    seen = streaming.progress(query)
    shown = spark.createDataFrame([(sum(p["late"] for p in seen), sum(p["repeated"] for p in seen), max(p["held"] for p in seen) > seen[-1]["held"])], "late long, repeated long, shrank boolean")
    return spark.read.parquet(f"{work}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids")).join(F.broadcast(shown))


add("stream_late_rows", _late, "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, (SELECT count(*) FILTER (day(ts) <= 5) FROM events) AS late, (SELECT count(*) FILTER (day(ts) = 15) FROM events) AS repeated, TRUE AS shrank FROM events GROUP BY 1")


def _newer(spark: SparkSession, d: str) -> DataFrame:
    """Orders of the first years stored; newer ones by the stored table's own watermark."""
    orders = table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    stored = Keyed(spark, f"{sources.work_dir(spark)}/orders", ["o_orderkey"], stamp="o_orderdate")
    for low, high in (("1990-01-01", "1998-01-01"), ("1998-01-01", "1999-06-15")):
        stored.merge(orders.where(f"o_orderdate >= '{low}' AND o_orderdate < '{high}'"), upsert_latest(["o_orderkey"], F.desc("o_orderdate")))
    return stored.above(orders).select("o_orderkey", "o_custkey")


add("incremental_stored_watermark", _newer, "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-06-15 00:00:00')")
