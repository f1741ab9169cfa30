"""Reading raw files and writing batches: scans, the file ledger, bronze tables, reports."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.functions import count_of

BATCH = "_batch_id"


def read_csv_gz(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, partitions: int | None = None) -> DataFrame:
    """Gzipped CSV with a header. A gz file is one task, so a large file is dealt over partitions after it is read."""
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv.gz").option("recursiveFileLookup", True).option("escape", '"').option("multiLine", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


def entity(path: str | Column) -> Column:
    """A file's entity: its name up to the first full stop, in lower case."""
    name = F.element_at(F.split(F.col(path) if isinstance(path, str) else path, "/"), -1)
    return F.lower(F.split_part(name, F.lit("."), F.lit(1)))


def listing(spark: SparkSession, path: str | Sequence[str], glob: str = "*.csv.gz") -> DataFrame:
    """(file_name, file_size_bytes, modified_at) of the files under a path; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("file_name"), F.col("length").alias("file_size_bytes"), F.col("modificationTime").alias("modified_at"))


def fingerprints(spark: SparkSession, path: str | Sequence[str], glob: str = "*.csv.gz") -> DataFrame:
    """listing() with file_hash, of each file's lines as they are after decompression.

    A file streams through its task a batch of lines at a time, so neither is a file one value nor does its size matter. Files
    that Spark splits (uncompressed ones) have a digest a block, and the file's is that of all in order; it then depends on
    the session's block size. An empty file has the digest of no lines.
    """
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        digest = hashlib.md5()

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file_name": [held[0]], "at": [held[1]], "digest": [digest.hexdigest()]})

        for batch in batches:
            names, starts = batch.column("file_name"), batch.column("at")
            values = batch.column("value").cast(pa.binary())
            start = 0
            while start < batch.num_rows:  # a task's rows come file by file, block by block
                now = (names[start].as_py(), starts[start].as_py())
                same = pc.and_(pc.equal(names, names[start]), pc.equal(starts, starts[start])).slice(start)
                stop = pc.index(same, False).as_py()
                stop = batch.num_rows if stop < 0 else start + stop
                if held is not None and now != held:
                    yield ended()
                    digest = hashlib.md5()
                held = now
                for v in values.slice(start, stop - start).to_pylist():
                    digest.update(v + b"\n")
                start = stop
        if held is not None:
            yield ended()

    blocks = lines.mapInArrow(run, "file_name string, at long, digest string")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]), ",")  # one a block of the file
    digests = blocks.groupBy("file_name").agg(F.md5(joined).alias("file_hash"))
    return listing(spark, path, glob).join(digests, "file_name", "left").withColumn("file_hash", F.coalesce("file_hash", F.md5(F.lit(""))))


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger doesn't have as completed with the same contents."""
    done = ledger.where(F.col("status") == "COMPLETED").select("file_name", "file_hash").distinct()
    return files.join(done, ["file_name", "file_hash"], "left_anti")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in the floating-point columns; no other column can hold one."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("float", "double")})


def with_lineage(df: DataFrame, batch_id: str, file_name: str | Column, ingested_at: Column | None = None) -> DataFrame:
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    return df.withColumns({"_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at, "_file_name": name, BATCH: F.lit(batch_id)})


def folder(spark: SparkSession, path: str):
    """Hadoop's view of a path: (file system, path)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = folder(spark, path)
    return files.exists(at)


def drop_batches(spark: SparkSession, path: str, batches: DataFrame) -> int:
    """Delete the partitions of the batches named (_batch_id), each as a whole; how many there were. Names reach the driver,
    one a batch, as the folders are deleted there."""
    dropped = 0
    for row in batches.select(BATCH).distinct().toLocalIterator():
        files, at = folder(spark, f"{path}/{BATCH}={row[0]}")
        dropped += bool(files.delete(at, True))
    return dropped


def batch_rows(table: DataFrame, batch_id: str) -> int:
    return table.where(F.col(BATCH) == batch_id).count()


def batch_counts(table: DataFrame) -> DataFrame:
    return table.groupBy(BATCH).agg(F.count("*").alias("rows"))


def write_report(operations: DataFrame, path: str) -> None:
    """The operations, and a row that sums them up, as JSON."""
    operations.write.mode("overwrite").json(f"{path}/operations")
    summary = operations.agg(F.count("*").alias("operations"), F.sum("rows_processed").alias("rows_processed"), count_of(F.col("processing_status") == "COMPLETED").alias("completed"))
    summary.write.mode("overwrite").json(f"{path}/summary")


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None) -> DataFrame:
    """As a view, or as a stored table that later reads start from."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind != "table" or path is None:
        raise ValueError("kind is view, or table with a path")
    df.write.mode("overwrite").parquet(f"{path}/{name}")
    return df.sparkSession.read.parquet(f"{path}/{name}")


def work_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a temporary one only where the session names none."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written once to a folder of its own and read back, for what is read more than once."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
