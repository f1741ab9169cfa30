"""Filter interaction audit: what each of five filters removes in each of their 120 orders, from counts by failure mask.

Every document's failures are one mask of five bits. Documents are counted by part and mask (with the good and the toxic
ones among them), and only those counts go on. In an order, a mask is removed at the first step whose filter it fails, and
the orders that share the steps up to that one are neighbours: in lexicographic order, ranked by their Lehmer code, they
cover one interval of (5 - step)! ranks. So a mask's count is added where such an interval starts and taken off where it
ends, and a running sum along the 120 ranks gives the removed documents of every order and step at once. The table of
intervals has 840 rows whatever the data.

Filters: A under 200 words; B fewer than half of the words distinct; C more than 2 in 100 code points are capitals A-Z; D any
of `#$%&*|`; E the same text as a smaller doc_id anywhere in the table, removed or not (texts are compared by SHA-256).
Null text is empty: it fails A, and E where a smaller doc_id has no text either. A null doc_id is smaller than none and has
none smaller, so it never fails E; rows equal in doc_id and text don't make each other copies and count each. A text exactly
on a bound passes. A null source is the part ''. A document is good or toxic if any of its labels says so; labels without a
document, or with a null id, count nowhere. Other columns are not read, so their names can't clash; an empty table gives no
rows. Texts of any length are measured whole, in arrays of their words.

The text is read once, and goes on as bits and a digest. A group of copies is reduced to its smallest id before anything is
joined, digests with more than one row in 256 are joined by broadcast (fewer than 256 of them), and rows without an id are
dealt evenly when labels are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestay.llm.common import documents, materialize, with_common, words

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
COUNTS = ("docs", "good", "toxic")


def measured(docs: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, mask (the bits of A to D) and the text's digest."""
    t, w = F.coalesce(F.col(text), F.lit("")), F.col("__words")
    n = F.size(w)
    upper = F.length("__text") - F.length(F.translate("__text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = (n < 200, 100 * F.size(F.array_distinct(w)) < 50 * n, 100 * upper > 2 * F.length("__text"), F.col("__text").rlike(r"[#$%&*|]"))
    held = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), t.alias("__text"), words(F.col(text)).alias("__words"))
    mask = reduce(lambda a, b: a + b, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)])
    return held.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("__text", 256)).alias("digest"))


def with_copies(rows: DataFrame) -> DataFrame:
    """rows (stored) with the bit of E in their mask."""
    same = rows.groupBy("digest").agg(F.min("doc_id").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    joined = with_common(rows, materialize(same, "copies"), "digest", "__n", rows.count())
    return joined.withColumn("mask", F.col("mask") + F.when(F.col("doc_id") > F.col("__first"), 1 << 4).otherwise(0)).drop("__first", "__n", "digest")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, mask) and labels (doc_id, quality, toxic) -> part, mask, docs, good, toxic."""
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.col("quality") == 1).alias("__good"), F.max(F.col("toxic") == 1).alias("__toxic"))
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(0)
    known = rows.withColumn("__deal", spread).join(said.withColumn("__none", F.lit(0).cast("long")), (F.col("doc_id") == F.col("__id")) & (F.col("__deal") == F.col("__none")), "left")
    return known.groupBy("part", "mask").agg(F.count("*").alias("docs"), F.count_if("__good").alias("good"), F.count_if("__toxic").alias("toxic"))


def rank(order: str) -> int:
    """The place of an order among all, from 0: each letter's digit is the number of smaller letters after it."""
    return sum(sum(y < x for y in order[i + 1 :]) * factorial(len(order) - 1 - i) for i, x in enumerate(order))


def intervals() -> Iterator[tuple[int, int, int, int]]:
    """(mask, step from 1, first rank, rank after the last) of every run of orders that remove a mask at a step: one for each
    choice of steps before it, which the mask passes, and of its own filter, which it fails."""
    for mask in range(1, 1 << len(FILTERS)):
        failed = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        passed = [f for f in FILTERS if f not in failed]
        for step in range(1, len(passed) + 2):
            for before in permutations(passed, step - 1):
                for own in failed:
                    head = "".join((*before, own))
                    first = rank(head + "".join(f for f in FILTERS if f not in head))
                    yield mask, step, first, first + factorial(len(FILTERS) - step)


def removed_by_rank(counts: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic -> part, step, rank, and the docs, good and toxic that the step of that order removes."""
    spark = counts.sparkSession
    table = spark.createDataFrame(sorted(intervals()), "mask int, step int, low int, high int")
    met = counts.where("mask > 0").join(F.broadcast(table), "mask")
    ends = F.explode(F.array(F.struct(F.col("low").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("high").alias("rank"), F.lit(-1).alias("sign"))))
    steps = met.select("part", "step", *COUNTS, ends.alias("e")).where(F.col("e.rank") < ORDERS)
    steps = steps.select("part", "step", "e.rank", *[(F.col(c) * F.col("e.sign")).alias(c) for c in COUNTS])
    grid = counts.select("part").distinct().withColumn("step", F.explode(F.array(*[F.lit(s) for s in range(1, len(FILTERS) + 1)])))
    grid = grid.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))).withColumns({c: F.lit(0).cast("long") for c in COUNTS})
    differences = grid.unionByName(steps).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return differences.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])


def audit(counts: DataFrame) -> DataFrame:
    """counts (part, mask, docs, good, toxic; stored) -> a row for each part, order and step."""
    spark = counts.sparkSession
    orders = ["".join(p) for p in permutations(FILTERS)]  # in lexicographic order, so a place in this list is a rank
    names = spark.createDataFrame([(r, s, o, o[s - 1]) for r, o in enumerate(orders) for s in range(1, len(o) + 1)], "rank int, step int, filter_order string, filter string")
    steps = removed_by_rank(counts).join(F.broadcast(names), ["rank", "step"])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(1 << i).alias("bit")) for i, f in enumerate(FILTERS)])).alias("f")
    hit: Column = F.col("mask").bitwiseAND(F.col("f.bit")) != 0
    fails = counts.select("part", "mask", "docs", each).groupBy("part", "f.filter").agg(
        F.sum("docs").alias("total"), F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("failing"), F.sum(F.when(F.col("mask") == F.col("f.bit"), F.col("docs")).otherwise(0)).alias("unique_fails")
    )
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    joined = steps.join(fails, ["part", "filter"])
    return joined.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("docs").over(so_far)).alias("kept"),
        F.col("docs").alias("removed"),
        (F.col("failing") - F.col("docs")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("docs").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of docs (doc_id, text, source)."""
    rows = materialize(measured(docs), "measured")
    return audit(materialize(mask_counts(with_copies(rows), labels), "masks"))


def op12_lehmer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
        CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END,
        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN w.doc_id > first_id THEN 'E' ELSE '' END) AS mask,
        coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT f1.f || f2.f || f3.f || f4.f || f5.f AS o FROM f f1, f f2, f f3, f f4, f f5
      WHERE f1.f NOT IN (f2.f, f3.f, f4.f, f5.f) AND f2.f NOT IN (f3.f, f4.f, f5.f) AND f3.f NOT IN (f4.f, f5.f) AND f4.f <> f5.f),
s AS (SELECT part, o, step, o[step] AS f, mask, n, g, x, contains(mask, o[step]) AS fails, len(regexp_replace(mask, '[^' || o[1:step] || ']', '', 'g')) AS so_far
      FROM c, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
a AS (SELECT part, o, step, f, coalesce(sum(n) FILTER (so_far = 0), 0) AS kept, coalesce(sum(n) FILTER (fails AND so_far = 1), 0) AS removed,
        coalesce(sum(n) FILTER (fails AND so_far > 1), 0) AS redundant, coalesce(sum(n) FILTER (mask = f), 0) AS unique_fails,
        coalesce(sum(g) FILTER (fails AND so_far = 1), 0) AS good_lost, coalesce(sum(x) FILTER (fails AND so_far = 1), 0) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, o AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM a
"""
