"""Relational operators and functions on the star schema: one query for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestay.functions import column_or, day, day_of_week, flag, mean, month_name, percent, ratio, record_hash, rounded, surrogate_key, weekday_name, whole_number
from lodestay.operators import sketches
from lodestay.plans.bridge import table
from lodestay.queries import Registry, b, flat, r

registry = Registry()


class Tables:
    """Tables by attribute, read where they are first named."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.d, name)


def add(name: str, query: Callable[[Tables], DataFrame], sql: str) -> None:
    registry.add(name, lambda spark, d: flat(query(Tables(spark, d))), sql)


P = "l_extendedprice::DECIMAL(12,2)"
SHIP = "l_shipdate::DATE"


def items(t: Tables) -> DataFrame:
    return t.lineitem.withColumns({"price": F.col("l_extendedprice").cast("decimal(12,2)"), "ship": F.to_date("l_shipdate")})


# Projections, predicates and nulls.
add("case_bucketing", lambda t: t.part.groupBy(F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large").alias("bucket")).agg(F.count("*").alias("n")),
    "SELECT CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS bucket, count(*) AS n FROM part GROUP BY 1")
add("argmax_label", lambda t: t.lineitem.groupBy("l_suppkey").agg(*[F.sum(F.when(F.col("l_returnflag") == f, 1).otherwise(0)).alias(f) for f in "ANR"]).select("l_suppkey", F.when(F.greatest("A", "N", "R") == F.col("A"), "A").when(F.greatest("A", "N", "R") == F.col("N"), "N").otherwise("R").alias("label")),
    "SELECT l_suppkey, CASE greatest(a, n, r) WHEN a THEN 'A' WHEN n THEN 'N' ELSE 'R' END AS label FROM (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)")
add("boolean_3vl", lambda t: t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, True).when(F.col("c_custkey") % 3 == 1, False).alias("x"), (F.col("c_acctbal") > 0).alias("y")).select("c_custkey", (F.col("x") & F.col("y")).alias("both"), (F.col("x") | F.col("y")).alias("either"), (~F.col("x")).alias("neither")),
    "SELECT c_custkey, x AND y AS both, x OR y AS either, NOT x AS neither FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS x, c_acctbal > 0 AS y FROM customer)")
add("predicate_in_list", lambda t: t.orders.where(F.col("o_orderstatus").isin("F", "P")).groupBy("o_orderstatus").agg(F.count("*").alias("n")), "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1")
add("predicate_like_ilike", lambda t: t.part.select("p_partkey", F.col("p_type").like("%E%").alias("a"), F.col("p_name").ilike("%PART%").alias("c")), "SELECT p_partkey, p_type LIKE '%E%' AS a, p_name ILIKE '%PART%' AS c FROM part")
add("predicate_regex", lambda t: t.customer.where(F.col("c_name").rlike("[0-9]*7$")).select("c_custkey"), "SELECT c_custkey FROM customer WHERE regexp_matches(c_name, '[0-9]*7$')")
add("null_handling", lambda t: t.supplier.withColumn("x", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey"))).select("s_suppkey", F.coalesce("x", F.lit(-1)).alias("c"), F.nullif(F.col("s_nationkey"), F.lit(3)).alias("n"), F.greatest("x", F.lit(5)).alias("g"), F.col("x").isNull().alias("i")),
    "SELECT s_suppkey, coalesce(x, -1) AS c, nullif(s_nationkey, 3) AS n, greatest(x, 5) AS g, x IS NULL AS i FROM (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS x FROM supplier)")


def filtered(df: DataFrame, status: str | None = None, priorities: list[str] | None = None) -> DataFrame:
    """Filters for the parameters that are given."""
    if status is not None:
        df = df.where(F.col("o_orderstatus") == status)
    return df.where(F.col("o_orderpriority").isin(priorities)) if priorities is not None else df


add("optional_filter", lambda t: filtered(t.orders, "F").agg(F.count("*").alias("n_status")).crossJoin(filtered(t.orders).agg(F.count("*").alias("n_all"))), "SELECT count(*) FILTER (o_orderstatus = 'F') AS n_status, count(*) AS n_all FROM orders")
add("range_scan", lambda t: t.orders.where((F.col("o_orderkey") >= 100) & (F.col("o_orderkey") < 1100)).select("o_orderkey", "o_custkey").orderBy("o_orderkey"), "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 1100")
add("record_hash", lambda t: t.customer.select("c_custkey", record_hash("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))).alias("h")), "SELECT c_custkey, md5(concat_ws('|', c_custkey::VARCHAR, c_name, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, ''))) AS h FROM customer")
add("surrogate_key", lambda t: t.customer.select("c_custkey", surrogate_key("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))).alias("sk")), "SELECT c_custkey, md5(concat_ws('-', c_custkey::VARCHAR, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, '_null_'))) AS sk FROM customer")
add("optional_column", lambda t: (lambda df: df.select("r_regionkey", *[column_or(df, c, F.concat(F.lit("no "), "r_name")).alias(c) for c in ("r_name", "r_comment")]))(t.region), "SELECT r_regionkey, r_name, 'no ' || r_name AS r_comment FROM region")

# Joins. A side is hinted for broadcast only where its size is fixed (nations, regions, one-row aggregates).
add("join_inner", lambda t: t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n")), "SELECT n_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
add("join_multi_key", lambda t: (lambda x: x.select("l_suppkey", "y", "m").distinct().join(x, ["l_suppkey", "y", "m"]).groupBy("l_suppkey", "y", "m").agg(F.count("*").alias("n")))(items(t).select("l_suppkey", F.year("ship").alias("y"), F.month("ship").alias("m"))),
    f"SELECT l_suppkey, year({SHIP})::INT AS y, month({SHIP})::INT AS m, count(*) AS n FROM lineitem GROUP BY ALL")
add("join_left", lambda t: t.customer.join(t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n")), "SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
_by = lambda t, cond, n: items(t).where(cond).groupBy("l_suppkey", F.trunc("ship", "month").alias("m")).agg(F.count("*").alias(n))
_bys = lambda cond, n: f"(SELECT l_suppkey, date_trunc('month', {SHIP})::DATE AS m, count(*) AS {n} FROM lineitem WHERE {cond} GROUP BY ALL)"
add("join_left_composite", lambda t: _by(t, F.lit(True), "n").join(_by(t, F.col("l_returnflag") == "R", "k"), ["l_suppkey", "m"], "left"), f"SELECT l_suppkey, m, n, k FROM {_bys('TRUE', 'n')} LEFT JOIN {_bys(chr(39).join(['l_returnflag = ', 'R', '']), 'k')} USING (l_suppkey, m)")
add("join_month_bucket", lambda t: _by(t, F.lit(True), "n").join(t.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("m")).agg(F.count("*").alias("o")), "m").groupBy("m").agg(F.sum("n").alias("n"), F.max("o").alias("o")),
    f"SELECT m, {b('sum(n)')} AS n, max(o) AS o FROM {_bys('TRUE', 'n')} JOIN (SELECT date_trunc('month', o_orderdate)::DATE AS m, count(*) AS o FROM orders GROUP BY 1) USING (m) GROUP BY m")
add("join_group_average", lambda t: t.supplier.join(t.supplier.groupBy("s_nationkey").agg(mean(F.col("s_acctbal").cast("decimal(12,2)")).alias("a")), "s_nationkey").select("s_suppkey", (F.col("s_acctbal") - F.col("a")).alias("d")),
    f"SELECT s_suppkey, {r('s_acctbal - a')} AS d FROM supplier JOIN (SELECT s_nationkey, sum(s_acctbal::DECIMAL(12,2))::DOUBLE / count(*) AS a FROM supplier GROUP BY 1) USING (s_nationkey)")
add("cross_join_scalars", lambda t: t.customer.agg(F.count("*").alias("c")).crossJoin(t.orders.agg(F.count("*").alias("o"))), "SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM orders) AS o")
add("semi_join", lambda t: t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")


def _not_in(t: Tables) -> DataFrame:
    """NOT IN, which Catalyst plans as a null-aware anti join."""
    t.customer.createOrReplaceTempView("customers_asked")
    t.orders.createOrReplaceTempView("orders_asked")
    return t.spark.sql("SELECT c_custkey FROM customers_asked WHERE c_custkey NOT IN (SELECT o_custkey FROM orders_asked WHERE o_orderstatus = 'P')")


add("anti_join_null_aware", _not_in, "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
add("scalar_subquery", lambda t: t.customer.crossJoin(F.broadcast(t.customer.agg(F.avg("c_acctbal").alias("a")))).where("c_acctbal > a").select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)")
add("correlated_subquery", lambda t: t.customer.join(t.orders.groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("last")), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "last"), "SELECT c_custkey, (SELECT max(o_orderdate::DATE) FROM orders WHERE o_custkey = c_custkey) AS last FROM customer")

# Aggregates.
add("agg_basic", lambda t: items(t).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("price").alias("s"), mean("price").alias("a"), F.min("price").alias("lo"), F.max("price").alias("hi")), f"SELECT l_returnflag, count(*) AS n, {r(f'sum({P})')} AS s, {r(f'sum({P})::DOUBLE / count(*)')} AS a, {r(f'min({P})')} AS lo, {r(f'max({P})')} AS hi FROM lineitem GROUP BY 1")
add("agg_global", lambda t: items(t).agg(F.count("*").alias("n"), F.sum("price").alias("s")), f"SELECT count(*) AS n, {r(f'sum({P})')} AS s FROM lineitem")
add("agg_count_distinct", lambda t: t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("s"), F.countDistinct("l_partkey").alias("p")), "SELECT l_returnflag, count(DISTINCT l_suppkey) AS s, count(DISTINCT l_partkey) AS p FROM lineitem GROUP BY 1")
add("agg_conditional", lambda t: items(t).groupBy("l_suppkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"), F.count_if(F.col("l_discount") > 0.05).alias("cheap")), "SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_discount > 0.05::DOUBLE) AS cheap FROM lineitem GROUP BY 1")
add("agg_conditional_distinct", lambda t: t.lineitem.groupBy("l_linestatus").agg(*[F.countDistinct(F.when(F.col("l_returnflag") == f, F.col("l_suppkey"))).alias(f"s_{f}") for f in "ANR"]), "SELECT l_linestatus, " + ", ".join(f"count(DISTINCT CASE WHEN l_returnflag = '{f}' THEN l_suppkey END) AS s_{f}" for f in "ANR") + " FROM lineitem GROUP BY 1")
add("agg_conditional_avg", lambda t: items(t).groupBy("l_suppkey").agg(mean(F.when(day_of_week("ship").isin(0, 6), F.col("price"))).alias("weekend")), f"SELECT l_suppkey, {r(f'(sum({P}) FILTER (date_part({chr(39)}dow{chr(39)}, {SHIP}) IN (0, 6)))::DOUBLE / count(*) FILTER (date_part({chr(39)}dow{chr(39)}, {SHIP}) IN (0, 6))')} AS weekend FROM lineitem GROUP BY 1")
add("agg_having", lambda t: t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 12"), "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")
add("agg_median", lambda t: items(t).groupBy("l_returnflag").agg(F.percentile("l_quantity", 0.5).alias("m")), f"SELECT l_returnflag, {r('quantile_cont(l_quantity, 0.5)')} AS m FROM lineitem GROUP BY 1")


def _distinct_sketches(t) -> DataFrame:
    """Customers by month in sketches, put together by year: how many there are, and whether the estimates keep to their bound."""
    orders = t.orders.withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    months = sketches.distinct_sketches(orders, ["o_orderstatus", "y", "m"], "o_custkey")
    years = sketches.merge_distinct(months, ["y"]).select("y", sketches.distinct().alias("estimate"))
    exact = orders.groupBy("y").agg(F.countDistinct("o_custkey").alias("customers"))
    within = F.abs(F.col("estimate") - F.col("customers")) <= F.col("customers") * sketches.distinct_error()
    return exact.join(years, "y").select("y", "customers", within.alias("within"))


add("agg_distinct_sketch", _distinct_sketches, "SELECT year(o_orderdate) AS y, count(DISTINCT o_custkey) AS customers, TRUE AS within FROM orders GROUP BY 1")


def _quantile_sketches(t) -> DataFrame:
    """Prices by supplier in sketches, put together by return flag: the exact median, and whether the estimate's rank keeps to its bound."""
    items = t.lineitem.select("l_returnflag", "l_suppkey", "l_extendedprice")
    flags = sketches.merge_quantiles(sketches.quantile_sketches(items, ["l_returnflag", "l_suppkey"], "l_extendedprice"), ["l_returnflag"]).select("l_returnflag", sketches.quantile().alias("m"))
    ranked = items.join(F.broadcast(flags), "l_returnflag").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.percentile("l_extendedprice", 0.5).alias("median"), F.avg((F.col("l_extendedprice") <= F.col("m")).cast("int")).alias("rank")
    )
    return ranked.select("l_returnflag", "n", "median", (F.abs(F.col("rank") - 0.5) <= 2 * sketches.rank_error()).alias("within"))


add("agg_median_sketch", _quantile_sketches, f"SELECT l_returnflag, count(*) AS n, {r('quantile_cont(l_extendedprice, 0.5)')} AS median, TRUE AS within FROM lineitem GROUP BY 1")
add("agg_stddev", lambda t: t.supplier.groupBy("s_nationkey").agg(rounded(F.stddev("s_acctbal"), 3).alias("sd")), f"SELECT s_nationkey, {r('stddev_samp(s_acctbal)', 3)} AS sd FROM supplier GROUP BY 1")
add("agg_corr", lambda t: t.lineitem.groupBy("l_returnflag").agg(F.corr("l_quantity", "l_extendedprice").alias("c"), F.corr("l_quantity", F.unix_timestamp("l_shipdate").cast("double")).alias("e")), f"SELECT l_returnflag, {r('corr(l_quantity, l_extendedprice)')} AS c, {r('corr(l_quantity, epoch(l_shipdate))')} AS e FROM lineitem GROUP BY 1")
add("agg_ratio", lambda t: items(t).groupBy("l_suppkey").agg(ratio(F.sum("price"), F.sum(F.col("l_quantity").cast("decimal(12,2)"))).alias("per_unit")), f"SELECT l_suppkey, {r(f'sum({P})::DOUBLE / nullif(sum(l_quantity::DECIMAL(12,2))::DOUBLE, 0) * 1.0')} AS per_unit FROM lineitem GROUP BY 1")
add("agg_group_by_expr", lambda t: t.orders.groupBy(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(F.count("*").alias("n")), "SELECT year(o_orderdate)::INT AS y, quarter(o_orderdate)::INT AS q, count(*) AS n FROM orders GROUP BY 1, 2")
add("agg_two_level", lambda t: t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("customers")), "SELECT n, count(*) AS customers FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
add("agg_bool_and", lambda t: t.region.agg(F.bool_and(F.col("r_name").isNotNull()).alias("named"), F.bool_and(F.col("r_name") > "B").alias("late")), "SELECT bool_and(r_name IS NOT NULL) AS named, bool_and(r_name > 'B') AS late FROM region")

# Windows.
_cust = lambda: Window.partitionBy("o_custkey")
_nth = lambda t, *order: t.orders.withColumn("k", F.row_number().over(_cust().orderBy(*order))).where("k = 1").select("o_custkey", "o_orderkey")
add("win_row_number_latest", lambda t: _nth(t, F.desc("o_orderdate"), F.desc("o_orderkey")), "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
add("win_row_number_first", lambda t: _nth(t, F.asc("o_orderdate"), F.asc("o_orderkey")), "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
add("win_lag_delta", lambda t: t.orders.withColumn("p", F.col("o_totalprice").cast("decimal(12,2)")).select("o_orderkey", (F.col("p") - F.coalesce(F.lag("p").over(_cust().orderBy("o_orderkey")), F.col("p"))).alias("d")), f"SELECT o_orderkey, {r('p - coalesce(lag(p) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), p)')} AS d FROM (SELECT *, o_totalprice::DECIMAL(12,2) AS p FROM orders)")
add("win_running_sum", lambda t: t.orders.withColumn("f", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).select("o_orderkey", F.sum("f").over(_cust().orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)).alias("g")), f"SELECT o_orderkey, {b('sum(CASE WHEN o_orderstatus = ' + chr(39) + 'F' + chr(39) + ' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)')} AS g FROM orders")


def _monthly(t: Tables) -> DataFrame:
    return items(t).groupBy("l_suppkey", F.trunc("ship", "month").alias("m")).agg(F.sum("price").cast("double").alias("s"))


_MON = f"(SELECT l_suppkey, date_trunc('month', {SHIP})::DATE AS m, sum({P})::DOUBLE AS s FROM lineitem GROUP BY ALL)"
_sw = lambda: Window.partitionBy("l_suppkey").orderBy("m")
add("win_lag_growth_pct", lambda t: _monthly(t).select("l_suppkey", "m", F.when(F.lag("s").over(_sw()) > 0, (F.col("s") / F.lag("s").over(_sw()) - 1) * 100).alias("g")), f"SELECT l_suppkey, m, {r('CASE WHEN lag(s) OVER w > 0 THEN (s / lag(s) OVER w - 1) * 100 END')} AS g FROM {_MON} WINDOW w AS (PARTITION BY l_suppkey ORDER BY m)")
add("win_moving_avg_12", lambda t: _monthly(t).select("l_suppkey", "m", rounded(F.avg("s").over(_sw().rowsBetween(-11, 0)), 2).alias("a")), f"SELECT l_suppkey, m, {r('avg(s) OVER (PARTITION BY l_suppkey ORDER BY m ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)', 2)} AS a FROM {_MON}")
add("seasonal_index", lambda t: _monthly(t).withColumn("a", F.avg("s").over(_sw().rowsBetween(-11, 0))).select("l_suppkey", "m", (F.col("s") / F.col("a")).alias("i"), F.when(F.col("s") > 1.1 * F.col("a"), "High Season").when(F.col("s") < 0.9 * F.col("a"), "Low Season").otherwise("Regular Season").alias("season")),
    f"SELECT l_suppkey, m, {r('s / a')} AS i, CASE WHEN s > 1.1::DOUBLE * a THEN 'High Season' WHEN s < 0.9::DOUBLE * a THEN 'Low Season' ELSE 'Regular Season' END AS season FROM (SELECT *, avg(s) OVER (PARTITION BY l_suppkey ORDER BY m ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS a FROM {_MON})")
_all = lambda: _sw().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
add("win_first_last_value", lambda t: _monthly(t).select("l_suppkey", F.first("s").over(_all()).alias("f"), F.last("s").over(_all()).alias("l")).distinct(), f"SELECT DISTINCT l_suppkey, {r('first_value(s) OVER w')} AS f, {r('last_value(s) OVER w')} AS l FROM {_MON} WINDOW w AS (PARTITION BY l_suppkey ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
add("win_lag_over_agg", lambda t: _monthly(t).groupBy("m").agg(F.count("*").alias("n")).select("m", "n", F.lag("n").over(Window.orderBy("m")).alias("p")), f"SELECT m, count(*) AS n, lag(count(*)) OVER (ORDER BY m) AS p FROM {_MON} GROUP BY m")

# Sorts, top k, sets.
add("sort_basic", lambda t: t.nation.orderBy(F.asc_nulls_last("n_regionkey"), F.desc_nulls_first("n_name")).select("n_regionkey", "n_name"), "SELECT n_regionkey, n_name FROM nation ORDER BY n_regionkey NULLS LAST, n_name DESC NULLS FIRST")
add("sort_hidden_agg", lambda t: t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("h")).orderBy(F.desc("h")).drop("h"), "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY max(o_orderkey) DESC")
add("sort_case_priority", lambda t: t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).orderBy(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1), "o_orderstatus"), "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END, 1")
add("top_k", lambda t: t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice"), f"SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice FROM orders ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 20")
add("union_all", lambda t: t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k"))).groupBy("k").agg(F.count("*").alias("n")), "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1")
add("select_distinct", lambda t: t.part.select("p_brand", "p_type").distinct(), "SELECT DISTINCT p_brand, p_type FROM part")

# Scalar functions.
add("fn_string", lambda t: t.part.select("p_partkey", F.trim(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("a"), F.regexp_replace(F.concat(F.lit("$1,"), F.col("p_size").cast("string")), "[$,]", "").alias("c"), F.split_part("p_type", F.lit(" "), F.lit(-1)).alias("d"), F.char_length("p_name").alias("e")),
    "SELECT p_partkey, p_name AS a, '1' || p_size::VARCHAR AS c, string_split(p_type, ' ')[-1] AS d, length(p_name)::INT AS e FROM part")
add("fn_date_parse", lambda t: t.orders.select("o_orderkey", day(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("us"), day(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso"), day(F.lit("31/31/2024")).alias("none")), "SELECT o_orderkey, o_orderdate::DATE AS us, o_orderdate::DATE AS iso, NULL::DATE AS none FROM orders")
add("fn_date_parts", lambda t: t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d"), F.quarter("o_orderdate").alias("q")), "SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS d, quarter(o_orderdate)::INT AS q FROM orders")
add("fn_day_of_week", lambda t: t.orders.select("o_orderkey", day_of_week("o_orderdate").alias("w")), "SELECT o_orderkey, date_part('dow', o_orderdate)::INT AS w FROM orders")
add("fn_epoch_diff", lambda t: t.events.select("event_id", ((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 3.6e9).alias("hours")), f"SELECT event_id, {r(chr(40) + 'epoch_us(ts) - epoch_us(TIMESTAMP ' + chr(39) + '2024-01-01 00:00:00' + chr(39) + '))::DOUBLE / 3.6e9')} AS hours FROM events")
add("fn_date_trunc", lambda t: t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("m"), F.trunc("o_orderdate", "quarter").alias("q")), "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS m, date_trunc('quarter', o_orderdate)::DATE AS q FROM orders")
add("fn_make_date", lambda t: t.orders.select("o_orderkey", F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("d")), "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS d FROM orders")
add("fn_to_char", lambda t: t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("m"), month_name("o_orderdate").alias("n"), weekday_name("o_orderdate", padded=False).alias("w")), "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS m, rpad(monthname(o_orderdate), 9, ' ') AS n, dayname(o_orderdate) AS w FROM orders")
add("fn_interval_cutoff", lambda t: t.events.where(F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp") - F.expr("interval 24 hours")).agg(F.count("*").alias("n")), "SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 24 HOURS")
add("fn_round", lambda t: t.supplier.select("s_suppkey", F.round(F.col("s_acctbal").cast("decimal(14,4)") / 8, 2).alias("x")), f"SELECT s_suppkey, {r('(CASE WHEN v < 0 THEN -1 ELSE 1 END * floor(abs(v) * 100 / 8 + 0.5)) / 100')} AS x FROM (SELECT s_suppkey, s_acctbal::DECIMAL(14,4) AS v FROM supplier)")
add("fn_division", lambda t: t.part.select("p_partkey", F.expr("p_size div 3").cast("int").alias("whole"), (F.col("p_size").cast("double") / 3).alias("real")), f"SELECT p_partkey, (p_size // 3)::INT AS whole, {r('p_size::DOUBLE / 3')} AS real FROM part")
add("fn_safe_parse", lambda t: t.part.select("p_partkey", whole_number(F.when(F.col("p_partkey") % 3 == 0, "x1").otherwise(F.col("p_size").cast("string"))).alias("w"), percent(F.concat(F.col("p_size").cast("string"), F.lit("%"))).alias("p")), f"SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size::BIGINT END AS w, {r('p_size')} AS p FROM part")
add("fn_flag_parse", lambda t: t.part.select("p_partkey", flag(F.element_at(F.array(F.lit("t"), F.lit("f"), F.lit("x")), (F.col("p_partkey") % 3 + 1).cast("int"))).alias("f")), "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS f FROM part")
