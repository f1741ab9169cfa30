"""Incremental ingest as file streams: what has arrived is processed once, then the query stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestay.sources import BATCH, entity
from lodestay.sources.keyed import BUCKETS, Keyed, upsert_latest


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process all available input in micro-batches; the checkpoint makes a second run start where this one ended."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Gzipped CSV files that arrive under source, appended to a table by entity; each file is read once.

    A micro-batch is its own partition, overwritten when it is run again after a failure, so rows are neither lost nor doubled.
    """
    files = spark.readStream.schema(schema).option("header", True).option("pathGlobFilter", "*.csv.gz").option("recursiveFileLookup", True).csv(source)
    files = files.select("*", F.col("_metadata.file_path").alias("_file_name")).withColumns({"_ingested_at": F.current_timestamp(), "_entity": entity("_file_name")})

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(BATCH, F.lit(f"s{number:08d}"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_entity", BATCH).parquet(target)

    return run(files, write, checkpoint)


def upsert_stream(stream: DataFrame, target: str, keys: list[str], checkpoint: str, order: list[Column], buckets: int = BUCKETS) -> StreamingQuery:
    """Micro-batches merged into a keyed table: of each key the last row stays (order: what comes first wins), whenever it came.

    A micro-batch writes the buckets that it touches beside the old ones and switches to them in one step; one that is run
    again after a failure, before the switch or after it, gives the same table. Keyed(...).read() gives its rows.
    """
    table = Keyed(stream.sparkSession, target, keys, buckets)
    return run(stream, lambda batch, number: table.merge(batch, upsert_latest(keys, *order), number), checkpoint)


def dedup_stream(stream: DataFrame, keys: list[str], stamp: str, late: str) -> DataFrame:
    """First row of each key within the watermark; state is dropped once it has passed, and rows that come after that are
    dropped too (a trigger judges by the watermark of the one before). progress() counts both."""
    return stream.withWatermark(stamp, late).dropDuplicatesWithinWatermark(keys)


def progress(query: StreamingQuery) -> list[dict]:
    """What each trigger did to the query's state: rows read, rows dropped as too late, duplicates dropped, rows held after it,
    and the watermark by which it judged. Of the latest triggers (spark.sql.streaming.numRecentProgressUpdates of them)."""
    out = []
    for p in query.recentProgress:
        state = p.stateOperators
        out.append(
            {
                "batch": p.batchId,
                "rows": p.numInputRows,
                "late": sum(s.numRowsDroppedByWatermark for s in state),
                "repeated": sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in state),
                "held": sum(s.numRowsTotal for s in state),
                "watermark": p.eventTime.get("watermark"),
            }
        )
    return out
