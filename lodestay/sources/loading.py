"""Loading files as batches: rules and counts are measured by the job that writes, schemas are kept as they change, and files
are told apart by what is in them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lodestay.operators.checks import Rule, declared_types, takes
from lodestay.operators.incremental import latest
from lodestay.sources import BATCH, exists, fingerprints, folder, listing, nan_to_null, read_csv_gz, with_lineage
from lodestay.sources.keyed import names, releasing, stamped

METRICS = "file_name string, table_name string, batch_id string, file_hash string, start_time timestamp, end_time timestamp, processing_status string, rows_processed long, rows_inserted long, rows_updated long, rows_failed long, file_size_bytes long, error_message string, load_duration_seconds double, failed_rules string"
SNAPSHOTS = "table_name string, number int, processed_at timestamp, last_file_processed string, schema_snapshot string, added array<string>, removed array<string>, changed array<string>"
FILES = "file_name string, file_hash string, file_size_bytes long, modified_at timestamp, status string, rows_processed long, batch_id string, processed_at timestamp"


@dataclass(frozen=True)
class Written:
    """What the writing job saw: rows, rows that break a row's rule that is fatal, and failures by rule, those without left out."""

    rows: int
    rows_failed: int
    failures: dict[str, int]

    def rules(self) -> str:
        return json.dumps(self.failures, separators=(",", ":"), sort_keys=True)


class RejectedError(ValueError):
    """A batch that breaks a fatal rule; nothing of it is stored."""

    def __init__(self, seen: Written, fatal: dict[str, int]):
        super().__init__(f"rules broken: {json.dumps(fatal, sort_keys=True)}")
        self.seen = seen


def write_batch(df: DataFrame, path: str, batch_id: str, file_name: str | Column, ingested_at: Column | None = None, rules: Sequence[Rule] = ()) -> Written:
    """Write one batch as its partition, in one job that also counts its rows and the failures of the rules.

    Rows go to a folder that readers don't see, and from there into place when all are written and no fatal rule is broken. So
    a batch that fails leaves nothing, one that is written again replaces itself, and other batches are never touched.
    """
    spark = df.sparkSession
    rows = with_lineage(nan_to_null(df), batch_id, file_name, ingested_at)
    fatal = [r for r in rules if r.fatal and r.fails is not None]
    broken = reduce(lambda a, b: a | b, [F.coalesce(r.fails, F.lit(False)) for r in fatal], F.lit(False))
    seen, staged = Observation(), f"{path}/.staging-{uuid.uuid4().hex}"
    files, hidden = folder(spark, staged)
    try:
        with releasing(spark), stamped(spark):
            rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("failed"), *[r.failures.alias(f"f{i}") for i, r in enumerate(rules)]).write.partitionBy(BATCH).option("compression", "zstd").parquet(staged)
        got = seen.get
        found = Written(got.get("rows", 0), got.get("failed", 0), {r.name: n for i, r in enumerate(rules) if (n := got.get(f"f{i}", 0))})
        worst = {r.name: found.failures[r.name] for r in rules if r.fatal and r.name in found.failures}
        if worst:
            raise RejectedError(found, worst)
        for name in [n for n in names(spark, staged) if n.startswith(f"{BATCH}=")]:  # one; none where there are no rows
            _, new = folder(spark, f"{staged}/{name}")
            _, final = folder(spark, f"{path}/{name}")
            _, old = folder(spark, f"{path}/.old-{uuid.uuid4().hex}")
            replaced = files.exists(final) and files.rename(final, old)
            if not files.rename(new, final):
                raise OSError(f"can't move the batch to {path}/{name}")
            if replaced:
                files.delete(old, True)
    finally:
        files.delete(hidden, True)
    return found


def append_batch(df: DataFrame, path: str, batch_id: str, file_name: str, ingested_at: Column | None = None, rules: Sequence[Rule] = ()) -> int:
    """write_batch(), giving the rows stored."""
    return write_batch(df, path, batch_id, file_name, ingested_at, rules).rows


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path) if exists(spark, path) else spark.createDataFrame([], METRICS)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOTS).parquet(path) if exists(spark, path) else spark.createDataFrame([], SNAPSHOTS)


def schema_diff(old: str | None, new: str) -> tuple[list[str], list[str], list[str]]:
    """Columns added, removed and of another type between two snapshots ({name: type} as JSON)."""
    before, after = json.loads(old or "{}"), json.loads(new)
    return sorted(after.keys() - before.keys()), sorted(before.keys() - after.keys()), sorted(c for c in before.keys() & after.keys() if before[c] != after[c])


def snapshot(spark: SparkSession, path: str, table_name: str, columns: dict[str, str], file_name: str, at: datetime | None = None) -> bool:
    """Keep the schema of a table after a load as JSON, if it isn't the last one kept. Columns that a file lacks stay in the
    table (they are null), so they aren't removed."""
    last = read_snapshots(spark, path).where(F.col("table_name") == table_name).orderBy(F.desc("number")).first()
    whole = json.dumps((json.loads(last.schema_snapshot) if last else {}) | columns, sort_keys=True)
    if last and last.schema_snapshot == whole:
        return False
    row = (table_name, last.number + 1 if last else 1, at or datetime.now(UTC), file_name, whole, *schema_diff(last.schema_snapshot if last else None, whole))
    spark.createDataFrame([row], SNAPSHOTS).coalesce(1).write.mode("append").parquet(path)
    return True


def load(
    df: DataFrame,
    path: str,
    metrics: str,
    table_name: str,
    batch_id: str,
    file_name: str,
    file_hash: str | None = None,
    file_size: int = 0,
    ingested_at: Column | None = None,
    required: Sequence[str] = (),
    rules: Sequence[Rule] = (),
    snapshots: str | None = None,
) -> str:
    """Append a file as a batch and write a row of metrics; the status is COMPLETED, or SKIPPED where the metrics have the
    same file as completed. A file that lacks a required column, whose types the stored table doesn't take, that breaks a
    fatal rule, or that fails otherwise, gets a FAILED row with the reason, and raises. Rules that aren't fatal are counted
    in the row alone. With snapshots, the table's schema is kept whenever it changes."""
    spark = df.sparkSession
    began, clock = datetime.now(UTC), time.monotonic()

    def record(status: str, seen: Written | None = None, error: str | None = None) -> str:
        stored = seen.rows if seen and status == "COMPLETED" else 0
        row = (file_name, table_name, batch_id, file_hash, began, datetime.now(UTC), status, seen.rows if seen else 0, stored, 0, seen.rows_failed if seen else 0, file_size, error, time.monotonic() - clock, seen.rules() if seen else "{}")
        spark.createDataFrame([row], METRICS).coalesce(1).write.mode("append").parquet(metrics)
        return status

    done = read_metrics(spark, metrics).where((F.col("file_name") == file_name) & F.col("file_hash").eqNullSafe(F.lit(file_hash)) & (F.col("processing_status") == "COMPLETED"))
    if not done.isEmpty():
        return record("SKIPPED")
    try:
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"required columns that the file lacks: {missing}")
        if exists(spark, path):
            stored = declared_types(spark.read.parquet(path))
            wrong = {c: (stored[c], t) for c, t in declared_types(df).items() if c in stored and not takes(stored[c], t)}
            if wrong:
                raise ValueError(f"types that the stored table doesn't take (stored, new): {wrong}")
        seen = write_batch(df, path, batch_id, file_name, ingested_at, rules)
        if snapshots is not None:
            snapshot(spark, snapshots, table_name, dict(df.dtypes), file_name)
        return record("COMPLETED", seen)
    except RejectedError as e:
        record("FAILED", e.seen, str(e)[:1000])
        raise
    except Exception as e:
        record("FAILED", error=str(e)[:1000])
        raise


# Files by their contents.


def read_files(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], FILES)


def classified(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """found (file_name, file_hash, ...) with status: SKIPPED where the same bytes are in already, under whatever name, or come
    with another file of found, the first by name being the one that loads; NEW for the others."""
    known = ledger.where("status = 'COMPLETED'").select("file_hash").distinct().withColumn("__in", F.lit(True))
    nth = F.row_number().over(Window.partitionBy("file_hash").orderBy("file_name"))
    return found.withColumn("__nth", nth).join(known, "file_hash", "left").withColumn("status", F.when(F.col("__in").isNotNull() | (F.col("__nth") > 1), "SKIPPED").otherwise("NEW")).drop("__in", "__nth")


def ingest_changed(spark: SparkSession, source: str, schema: str, target: str, ledger: str, most_files: int = 10_000, glob: str = "*.csv.gz") -> dict[str, int]:
    """Load the files under source whose contents aren't in yet, tracked by the ledger; files by status.

    A file stream remembers names only, so it never sees a file that is replaced; here the listing (name, size, time of
    change) is compared with the ledger, and only files that are new or changed there are read for their digests. A
    replaced file's new contents are a batch of their own beside the old ones. most_files are taken at a time until none is left, and each
    time is one batch, whose id follows from the ledger: if the driver is lost, the rerun replaces it.
    """
    total = {"COMPLETED": 0, "SKIPPED": 0}
    while True:
        past = read_files(spark, ledger)
        number = (past.agg(F.max(F.regexp_extract("batch_id", "([0-9]+)$", 1).cast("int"))).first()[0] or 0) + 1
        seen = past.select("file_name", "file_size_bytes", "modified_at").distinct()
        fresh = listing(spark, source, glob).join(seen, ["file_name", "file_size_bytes", "modified_at"], "left_anti").orderBy("modified_at", "file_name").limit(most_files)
        paths = [r[0] for r in fresh.select("file_name").collect()]  # at most most_files
        if not paths:
            return total
        found = classified(fingerprints(spark, paths), past).persist()
        loaded = [r[0] for r in found.where("status = 'NEW'").select("file_name").collect()]
        batch = f"files-{number:08d}"
        if loaded:
            write_batch(read_csv_gz(spark, loaded, schema).withColumn("_file_name", F.col("_metadata.file_path")), target, batch, F.col("_file_name"))
        counts = spark.read.parquet(target).where(F.col(BATCH) == batch).groupBy(F.col("_file_name").alias("file_name")).agg(F.count("*").alias("n")) if loaded else spark.createDataFrame([], "file_name string, n long")
        status = F.when(F.col("status") == "NEW", "COMPLETED").otherwise("SKIPPED")
        entries = found.join(counts, "file_name", "left").select("file_name", "file_hash", "file_size_bytes", "modified_at", status.alias("status"), F.coalesce("n", F.lit(0).cast("long")).alias("rows_processed"), F.lit(batch).alias("batch_id"), F.current_timestamp().alias("processed_at"))
        entries.coalesce(1).write.mode("append").parquet(ledger)
        total["COMPLETED"] += len(loaded)
        total["SKIPPED"] += len(paths) - len(loaded)
        found.unpersist()


def table_state(metrics: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Of each table: when and by which file it was last loaded, its rows and its schema. A batch that was loaded again counts
    by its last load."""
    done = metrics.where("processing_status = 'COMPLETED'")
    batches = latest(done, ["table_name", "batch_id"], F.desc("end_time"))
    last = F.max_by("file_name", F.struct("end_time", "file_name"))
    loads = batches.groupBy("table_name").agg(F.max("end_time").alias("processed_at"), F.sum("rows_inserted").alias("total_rows"), last.alias("last_file_processed"))
    schemas = snapshots.groupBy("table_name").agg(F.max_by("schema_snapshot", "number").alias("schema_snapshot"), F.max("number").alias("schema_number"))
    return loads.join(schemas, "table_name", "left")
