"""Helpers that the text operators share: input, durable intermediate tables, components, batching."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII blanks between words.
BLANKS = " \t\n\x0b\x0c\r"
SHARE = 256  # a value in more than one of SHARE rows is joined by broadcast


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, local mode gets a fresh temporary one; a cluster can't."""
    path = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: cuts the lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that materialize() wrote, once what was read from it is itself written."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def shield(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that an operator works on, and all others in one struct, where their names can't clash with its own."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(*(others or [F.lit(0).alias("none")])).alias("__row"))


def unshield(df: DataFrame, docs: DataFrame, *needed: str, **changed: Column) -> DataFrame:
    """The columns of docs again, those in changed by their new value."""
    value = lambda c: changed[c] if c in changed else F.col(c) if c in needed else F.col("__row").getField(c)
    return df.select(*[value(c).alias(c) for c in docs.columns])


def words(text: Column) -> Column:
    """Maximal runs of anything but the six blanks; an empty array for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int, most_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each part holds at most most_bytes of column, or a single longer row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def with_common(left: DataFrame, right: DataFrame, on: str, weight: str, total: int, share: int = SHARE) -> DataFrame:
    """left joined (left) to right, which has a row for a value of `on` and in `weight` how many rows of left it meets at most.

    Values with more than a share of all `total` rows are fewer than `share`: they are broadcast, so no task gets one whole.
    """
    common = right.where(F.col(weight) > total / share)
    rest = left.join(F.broadcast(common.select(on)), on, "left_anti").join(right.where(F.col(weight) <= total / share), on, "left")
    return rest.unionByName(left.join(F.broadcast(common), on))


def components(links: DataFrame, label: str = "components", rounds: int = 60) -> DataFrame:
    """Connected components of links (u, v: long): one row (node, component), component being the smallest node.

    Alternating large-star and small-star rounds: every step groups or joins edges by one end, each round is written to
    the shared folder, and only a count and a checksum of the edges reach the driver.
    """
    edges = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, label)

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    seen = mark(edges)
    for _ in range(rounds if seen[0] else 0):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(lower, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(lower.select(F.col("k").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        before, edges = edges, materialize(small, label)
        discard(before)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"components have not settled after {rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
