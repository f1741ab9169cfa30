"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a seeded order, served again for a second and third epoch. A document's virtual
finish time in an epoch is the source's cumulative words divided by its target, so at virtual time 1 every source has sent
its target. What is sent whole by then, and the started part of the document in service, goes into one queue by virtual
time, dealt over ranges of it; cumulative words come from the ranges' totals and sums inside each, and the queue is
truncated where they reach the total budget. Sources take weights 5, 2, 1, repeating, by code point, null last.

Null text has size 0 and is never sent; an empty table gives no rows; equal rows are interchangeable and counted each; equal
virtual times are ordered by source, epoch and document key; a very long document is one row like any other. Other columns
pass through, and columns added here replace those of the same name. No row is dropped for skew: a source with most of the
rows is dealt over many buckets and many ranges. Only the table of sources (one row each) meets in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestay.llm.common import documents, materialize, shield, unshield, words

WEIGHTS = (5, 2, 1)
EPOCHS = 3
BUCKET_ROWS = 20_000  # of a source, summed in order by one task
RANGE_ROWS = 2_000  # of the queue, likewise
MOST_BROADCAST = 1 << 20  # rows
ADDED = ("size", "source_size", "target", "taken", "finish")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """totals (source, source_size) with weight and target: shares of all sizes by weight, none above epochs x its size.

    Sources that reach their limit at the common water level are stopped, the rest is shared again by weight: sorted by
    limit / weight, the level is where the stopped limits and the weighted rest add up to the budget. One row a source.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    t = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int")))
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    t = t.withColumns(
        {
            "budget": F.sum("source_size").over(everything).cast("double"),
            "before": F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)),
            "open": F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    # the level if this source and all after it stay open; a source stops when the level passes its ratio
    t = t.withColumn("level", (F.col("budget") - F.coalesce("before", F.lit(0.0))) / F.col("open"))
    t = t.withColumn("stopped", F.col("cap") < F.col("level") * F.col("weight"))
    t = t.withColumn("final", F.min(F.when(~F.col("stopped"), F.struct(F.col("cap") / F.col("weight"), "source", "level"))).over(everything)["level"])
    return t.select("source", "source_size", "weight", F.round(F.when(F.col("stopped"), F.col("cap")).otherwise(F.col("final") * F.col("weight")), 6).alias("target"))


class Plan:
    """What every row needs to find its place: counts and sums by source, bucket and range of virtual time."""

    def __init__(self, sizes: DataFrame, epochs: int):
        """sizes: source, size, __key of every row, stored."""
        self.epochs = epochs
        counts = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
        largest, rows, budget = counts.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
        self.budget, self.ranges = budget, max(1, math.ceil(rows / RANGE_ROWS))
        self.digits = max(1, math.ceil(math.log(max(1, largest / BUCKET_ROWS), 16)))
        # the sums of the buckets before, per source: one small row a bucket
        held = sizes.groupBy("source", F.substring("__key", 1, self.digits).alias("__at")).agg(F.sum("size").alias("held"))
        ahead = Window.partitionBy("source").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        held = held.withColumn("ahead", F.coalesce(F.sum("held").over(ahead), F.lit(0))).alias("s")
        joined = held.join(targets(counts.select("source", "source_size"), epochs=epochs).alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
        self.buckets = materialize(joined.select(F.col("s.source").alias("__source"), "__at", "ahead", "source_size", "target"), "mix-buckets")
        totals = entries(placed(sizes, self), self).groupBy("__range").agg(F.sum("__sent").alias("__held"))  # a row a range
        before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        self.offsets = materialize(totals.select(F.col("__range").alias("__r"), F.coalesce(F.sum("__held").over(before), F.lit(0)).alias("__before")), "mix-ranges")


def placed(rows: DataFrame, plan: Plan) -> DataFrame:
    """rows (source, size, __key) with source_size, target, __cum (words of the source's queue up to the row) and __nth."""
    rows = rows.withColumn("__bucket", F.substring("__key", 1, plan.digits))
    joined = rows.join(plan.buckets, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__bucket") == F.col("__at"))).drop("__source", "__at")
    order = Window.partitionBy("source", "__bucket").orderBy("__key", "size")
    inner = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumns({"__cum": F.col("ahead") + F.sum("size").over(inner), "__nth": F.row_number().over(order)}).drop("ahead")


def entries(rows: DataFrame, plan: Plan) -> DataFrame:
    """A row for each epoch in which virtual time 1 has seen some of a document, and for the first epoch always: __epoch,
    __sent (words by then), __time (virtual finish, or 1 for a document still in service) and __range of it."""
    quota = F.floor(F.col("target") + 0.5)
    epochs = F.array(*[F.struct(F.lit(e).alias("__epoch"), (F.col("__cum") + e * F.col("source_size")).alias("__through")) for e in range(plan.epochs)])
    begun = F.filter(epochs, lambda x: (x["__epoch"] == 0) | (x["__through"] - F.col("size") < quota))
    out = rows.select("*", F.explode(begun).alias("__e")).select("*", "__e.*").drop("__e")
    finish = F.when(F.col("target") > 0, F.col("__through") / F.col("target")).otherwise(F.lit(1.0))
    left = F.greatest(F.lit(0), quota - (F.col("__through") - F.col("size")))
    out = out.withColumns({"__time": F.least(F.lit(1.0), finish), "__sent": F.when(F.col("__through") <= quota, F.col("size")).otherwise(left).cast("long")})
    # what isn't sent adds nothing wherever it stands, so it is dealt over all ranges
    anywhere = F.pmod(F.xxhash64("__key"), F.lit(plan.ranges))
    return out.withColumn("__range", F.when(F.col("__sent") == 0, anywhere).otherwise(F.floor(F.col("__time") * plan.ranges)).cast("int")).drop("__through")


def truncated(queue: DataFrame, plan: Plan) -> DataFrame:
    """queue with __kept: the words of each entry before the total budget is reached, in order of virtual time."""
    order = Window.partitionBy("__range").orderBy("__time", F.col("source").asc_nulls_last(), "__epoch", "__key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    small = F.broadcast(plan.offsets) if plan.ranges <= MOST_BROADCAST else plan.offsets  # a row for RANGE_ROWS documents
    out = queue.join(small, F.col("__range") == F.col("__r"))
    before = F.col("__before") + F.sum("__sent").over(order) - F.col("__sent")
    return out.withColumn("__kept", F.greatest(F.lit(0), F.least(F.col("__sent"), F.lit(plan.budget) - before)).cast("long")).drop("__r", "__before")


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """docs with size and __key, the seeded order of its source's queue."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.md5("text"), F.lit("null"))))
    return docs.withColumns({"size": F.size(words(F.col("text"))).cast("long"), "__key": key})


def schedule(docs: DataFrame, seed: str = "mix-1", epochs: int = EPOCHS) -> DataFrame:
    """docs without the text, with size, source_size, target, taken (words of all epochs) and finish (first virtual finish)."""
    rows = sized(docs.drop(*[c for c in docs.columns if c in ADDED]), seed).drop("text")
    rows = materialize(rows, "mix-sizes")
    plan = Plan(rows.select("source", "size", "__key"), epochs)
    queue = truncated(entries(placed(rows, plan), plan), plan)
    kept = [c for c in queue.columns if c not in ("source", "__bucket", "__nth", "__epoch", "__time", "__range", "__sent", "__kept", "__key")]
    done = queue.groupBy("source", "__bucket", "__nth").agg(*[F.first(c).alias(c) for c in kept], F.sum("__kept").alias("taken"))
    done = done.withColumn("finish", F.when(F.col("target") > 0, F.round(F.least(F.lit(1.0), F.col("__cum") / F.col("target")), 9)))
    return done.drop("__bucket", "__nth", "__cum")


def mix(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """The mix itself, in order of virtual time: a row for each time a document is sent; same columns as docs.

    A document cut by the budget keeps its first words up to the cut; a column n_chars follows the text.
    """
    rows = sized(shield(docs, "doc_id", "source", "text"), seed)
    plan = Plan(materialize(rows.select("source", "size", "__key"), "mix-sizes"), EPOCHS)
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    queue = entries(placed(rows, plan), plan).where("__sent > 0").repartitionByRange(n, "__range")
    sent = truncated(queue, plan).where("__kept > 0")
    part = F.regexp_extract("text", r"^[\x20\x09-\x0D]*", 0)
    cut = F.concat(part, F.array_join(F.slice(words(F.col("text")), 1, F.greatest(F.col("__kept").cast("int"), F.lit(1))), " "))
    part_sent = F.col("__kept") < F.col("size")
    changed = {"text": F.when(part_sent, cut).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(part_sent, F.length(cut).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("__row").getField("n_chars"))
    return unshield(sent, docs, "doc_id", "source", "text", **changed)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(documents(spark, sf_dir).select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken", "finish")


OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(concat_ws('|', 'mix-1', coalesce(doc_id::VARCHAR, 'null'), coalesce(md5(text), 'null'))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM d GROUP BY source),
fill AS (
  SELECT 0 AS step, source, source_size, weight, FALSE AS stopped, (SELECT sum(source_size) FROM s)::DOUBLE AS left_words, (SELECT sum(weight) FROM s) AS left_weight FROM s
  UNION ALL
  SELECT step + 1, source, source_size, weight, now,
    (sum(source_size) OVER ())::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) FILTER (now) OVER (), 0), coalesce(sum(weight) FILTER (NOT now) OVER (), 0)
  FROM (SELECT *, stopped OR 3.0 * source_size < left_words * weight / left_weight AS now FROM fill WHERE step < 40)),
t AS (SELECT source, source_size, round(CASE WHEN stopped THEN 3.0::DOUBLE * source_size ELSE left_words / left_weight * weight END, 6) AS target FROM fill WHERE step = 40),
c AS (SELECT doc_id, d.source, k, size, source_size, target, floor(target + 0.5) AS quota, row_number() OVER () AS r,
        sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT r, source, k, size, e, CASE WHEN target > 0 THEN least(1.0::DOUBLE, (cum + e * source_size)::DOUBLE / target) ELSE 1.0::DOUBLE END AS moment,
        CASE WHEN cum + e * source_size <= quota THEN size ELSE greatest(0, quota - (cum + e * source_size - size)) END::BIGINT AS sent
      FROM c, (SELECT unnest([0, 1, 2]) AS e)),
u AS (SELECT *, sum(sent) OVER (ORDER BY moment, source NULLS LAST, e, k, size ROWS UNBOUNDED PRECEDING) - sent AS before FROM q),
v AS (SELECT r, sum(greatest(0, least(sent, (SELECT sum(size) FROM d) - before)))::BIGINT AS taken FROM u GROUP BY r)
SELECT doc_id, size, source_size, target, taken, CASE WHEN target > 0 THEN round(least(1.0::DOUBLE, cum / target), 9) END AS finish FROM c JOIN v USING (r)
"""
