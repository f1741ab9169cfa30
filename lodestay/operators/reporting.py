"""Questions about the load ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestay.functions import count_of, mean
from lodestay.operators.incremental import latest

MAX_RETRIES, BACK_OFF_MINUTES = 3, 5


def state(c: str, value: str) -> Column:
    return F.col(c) == value


def metrics_summary(ledger: DataFrame) -> DataFrame:
    s = "processing_status"
    return ledger.agg(
        F.countDistinct("file_name").alias("total_files"),
        *[F.sum(c).alias(f"total_{c}") for c in ("rows_processed", "rows_inserted", "rows_failed")],
        count_of(state(s, "COMPLETED")).alias("successful_files"),
        count_of(state(s, "FAILED")).alias("failed_files"),
    )


def load_summary(ledger: DataFrame) -> DataFrame:
    done = ledger.where(state("processing_status", "COMPLETED"))
    return done.agg(F.countDistinct("file_name").alias("total_files"), F.sum("rows_processed").alias("total_rows"), F.max("file_size_bytes").alias("max_file_size"), mean("file_size_bytes").alias("avg_file_size"))


def load_operations(ledger: DataFrame, table: str | None = None, batches: Sequence[str] | None = None) -> DataFrame:
    """Loads, newest first, of one table or some batches where asked for."""
    if table is not None:
        ledger = ledger.where(F.col("table_name") == table)
    if batches is not None:
        ledger = ledger.where(F.col("batch_id").isin(list(batches)))
    return ledger.orderBy(F.desc("start_time"), F.desc("event_id"))


def batch_status(ledger: DataFrame) -> DataFrame:
    s = "processing_status"
    counted = ledger.groupBy("batch_id").agg(F.count("*").alias("total"), *[count_of(state(s, v)).alias(v.lower()) for v in ("COMPLETED", "FAILED", "IN_PROGRESS", "PENDING")], F.sum("rows_processed").alias("rows"))
    overall = F.when(F.col("failed") > 0, "FAILED").when(F.col("completed") == F.col("total"), "COMPLETED").otherwise("IN_PROGRESS")
    return counted.withColumn("status", overall)


def retry_candidates(ledger: DataFrame, as_of: Column, k: int = 100, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Failed loads with retries left that are due, and pending ones; oldest first."""
    due = F.col("start_time") + F.make_interval(mins=F.col("retry_count") * BACK_OFF_MINUTES) <= as_of
    failed = state("processing_status", "FAILED") & (F.col("retry_count") < max_retries) & due
    return ledger.where(failed | state("processing_status", "PENDING")).orderBy("start_time", "event_id").limit(k)


def retry_state(failures: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """A failure log folded by file and batch: count, last failure and its text, and when to try again (never after the last try)."""
    folded = failures.groupBy("file_name", "batch_id").agg(F.count("*").alias("retry_count"), F.max_by("event_id", F.struct("start_time", "event_id")).alias("last_failure"), F.max_by("error_message", F.struct("start_time", "event_id")).alias("last_error"), F.max("start_time").alias("last_at"))
    return folded.withColumn("next_retry_at", F.when(F.col("retry_count") < max_retries, F.col("last_at") + F.expr(f"interval {BACK_OFF_MINUTES} minutes")))


def recovery_prune(points: DataFrame, as_of: Column, days: int = 7, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Old recovery points that are done or have no retries left."""
    return points.where((F.col("start_time") < as_of - F.expr(f"interval {days} days")) & (state("processing_status", "COMPLETED") | (F.col("retry_count") >= max_retries)))


def table_metadata(ledger: DataFrame) -> DataFrame:
    """Of each table: when and by which file it was last loaded, and the rows of all its loads, in one grouping. With schemas:
    lodestay.sources.loading.table_state."""
    return ledger.groupBy("table_name").agg(
        F.max_by("file_name", F.struct("start_time", "event_id")).alias("last_file_processed"), F.max("start_time").alias("processed_at"), F.sum("rows_processed").alias("total_rows")
    )


def file_status(ledger: DataFrame, batch: str) -> DataFrame:
    return latest(ledger.where(F.col("batch_id") == batch), ["file_name"], F.desc("start_time"), F.desc("event_id")).select("file_name", "processing_status", "rows_processed")


def retention_expired(ledger: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Batches without a load in progress whose newest load is past retention."""
    batches = ledger.groupBy("table_name", "batch_id").agg(F.max("start_time").alias("last_at"), count_of(state("processing_status", "IN_PROGRESS")).alias("active"))
    return batches.where((F.col("active") == 0) & (F.col("last_at") < as_of - F.expr(f"interval {days} days"))).drop("active")


def ledger_latest(ledger: DataFrame, keys: Sequence[str] = ("file_name", "batch_id")) -> DataFrame:
    return latest(ledger, list(keys), F.desc("start_time"), F.desc("event_id"))
