"""Two-pass external shuffle: scatter rows into memory-sized buckets by a seeded hash, then Fisher-Yates in each bucket.

Pass 1 is one Spark exchange on the bucket number; pass 2 sorts a bucket's rows (so that a repeated task makes the same
permutation) and shuffles them with a generator seeded by the bucket. Whole records move: the query passes doc_id and text
through both passes, and takes size and checksum from the records that were written. A row's rank is its bucket's offset plus its place, so
dealing ranks round-robin gives shards whose counts differ by one at most (law `rows`).

Rows that are equal in their keys would share a bucket, so those with more bytes than a bucket are first counted by a hash of
their keys and dealt over several by row number: they are interchangeable. The row number is the same again only if the rows
are, so rows should come from a stored table. A task of the second pass holds one bucket, or one row that is larger.

Null texts count 8 bytes and checksum 0; equal rows are interchangeable; an empty table gives no rows; other columns pass
through, and columns added here replace those of the same name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.llm.common import documents, materialize

SHARDS = 24
#: A bucket holds about so many bytes of records; it is what one task of the second pass keeps in memory.
BUCKET_BYTES = 16 << 20
MOST_HOT = 1 << 20  # groups of equal rows that are dealt over several buckets: the table of them is broadcast
ADDED = ("bucket", "place", "shard", "slot")


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0..n-1; numpy's generator shuffles by Fisher-Yates."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def external_shuffle(rows: DataFrame, keys: list[str], size: str | Column, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """rows with bucket and place: a uniform random order is bucket, then place. keys tell rows apart; size is in bytes."""
    rows = rows.drop(*[c for c in rows.columns if c in ADDED])
    size = F.col(size) if isinstance(size, str) else size
    total = rows.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    rows = rows.withColumn("__key", F.xxhash64(F.lit(seed), *keys))
    # a bound on the bytes of a group of equal rows that no more than MOST_HOT groups can exceed
    bound = max(bucket_bytes, total / MOST_HOT)
    hot = rows.groupBy("__key").agg(F.sum(size).alias("held")).where(F.col("held") > bound)
    hot = hot.select(F.col("__key").alias("__hot"), F.ceil(F.col("held") / bound * 2).alias("__parts"))
    rows = rows.withColumn("__nth", F.monotonically_increasing_id()).join(F.broadcast(hot), F.col("__key") == F.col("__hot"), "left")
    apart = F.when(F.col("__parts").isNotNull(), F.xxhash64("__key", F.pmod(F.xxhash64("__nth"), F.col("__parts")))).otherwise(F.col("__key"))
    scattered = rows.withColumn("bucket", F.pmod(apart, F.lit(buckets)).cast("int")).drop("__key", "__nth", "__hot", "__parts")

    def shuffled(table: pa.Table) -> pa.Table:
        table = table.sort_by([(k, "ascending") for k in keys])
        bucket = table.column("bucket")[0].as_py()
        table = table.take(pa.array(fisher_yates(table.num_rows, seed, bucket)))
        return table.append_column("place", pa.array(np.arange(table.num_rows, dtype=np.int64)))

    schema = T.StructType([*scattered.schema.fields, T.StructField("place", T.LongType())])
    return scattered.groupBy("bucket").applyInArrow(shuffled, schema)


def shard(rows: DataFrame, keys: list[str], size: str | Column, shards: int = SHARDS, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """rows with bucket, place, shard and slot (gapless from 0 in each shard)."""
    return ranked(materialize(external_shuffle(rows, keys, size, seed, bucket_bytes), "shuffled"), shards)


def ranked(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """placed (with bucket and place) with shard and slot."""
    held = placed.groupBy("bucket").agg(F.count("*").alias("n"))  # a row a bucket
    before = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(F.col("bucket").alias("__b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    out = placed.join(offsets, placed.bucket == offsets["__b"]).withColumn("__rank", F.col("__offset") + F.col("place"))
    out = out.withColumns({"shard": F.pmod("__rank", F.lit(shards)).cast("int"), "slot": F.floor(F.col("__rank") / shards).cast("long")})
    return out.drop("__b", "__offset", "__rank")


def write_shards(rows: DataFrame, keys: list[str], size: str | Column, path: str, shards: int = SHARDS, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write the shuffled rows, one folder a shard, files in slot order. Buckets stay apart, so a shard may have many files."""
    out = shard(rows, keys, size, shards, seed, bucket_bytes)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)


def record_bytes(text: str = "text") -> Column:
    """Bytes that a record with this text counts."""
    return (F.octet_length(F.encode(F.coalesce(text, F.lit("")), "UTF-8")) + 8).cast("long")


def shuffled_documents(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs (doc_id, text) shuffled and written whole; of each record read back doc_id, size, text_crc32, shard and slot.

    A rank needs the sizes of all buckets before its own, so ranks are joined to what is left after the text is read."""
    records = materialize(external_shuffle(docs.select("doc_id", "text"), ["doc_id", "text"], record_bytes(), bucket_bytes=bucket_bytes), "shuffled")
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return ranked(records.select("doc_id", record_bytes().alias("size"), crc.alias("text_crc32"), "bucket", "place"))


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shuffled_documents(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
