"""Tables kept in buckets by a hash of their keys: a change writes only the buckets it touches, and one rename switches it on.

    table/_versions/000000000003.json    the table as of its third change: which folder holds each bucket, the schema
    table/data/<change>/bucket=17/...    Parquet files of one bucket, never changed once written (with slices: bucket=17/slice=1998)

Readers follow the pointer with the highest number and read the folders it names. A change writes a folder of its own and
renames its pointer into place last. If the driver or an executor is lost before that, the table is as it was, and what was
written is a folder that no pointer names; a rerun writes another one. A writer that finds the pointer's name taken has been
overtaken and raises. (This needs a file system that renames a file at once, as HDFS does and object stores may not.)

The hash is the one by which Spark deals rows to partitions, so after one exchange by the keys into as many partitions as
there are buckets (or a multiple of them, where a bucket has more rows than a task should) every task writes one file. When buckets have grown over their size on average, the change that finds it
rewrites the table in twice as many, so a bucket (with slices: one of them) stays a task's work at any size of the table.

A change of many rows goes through its buckets in rounds, each of which deletes its shuffle files as it ends, so the exchange
takes a fraction of the table on disk. Buckets that only gain rows (see merge()) are not written anew: they get one more folder.

A table whose rows depend on those before them can have slices (years, say): a bucket is a folder a slice then, and a change
writes a bucket from the first slice on that gets rows. Slices before that stay, and the change may read what it needs of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.sources import folder

Change = Callable[..., DataFrame]
BUCKETS, BUCKET_BYTES, TASK_ROWS = 16, 512 << 20, 1 << 20
#: Rows of a round and how many rounds there are at most, as each one reads the change's source; folders that a bucket gains.
ROUND_ROWS, ROUNDS, FOLDERS = 1 << 24, 4, 16
#: Slices that a task writes without sorting its rows by them.
OPEN = 64
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A conf of the session while it runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stamped(spark: SparkSession):
    """Timestamps are written as microseconds, which have statistics in a file; the default type has none, so no scan would
    leave out what is older than a watermark."""
    return setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def concurrent(spark: SparkSession, writers: int):
    """Writes in it keep a file open for each of so many folders, where they would sort whole rows by folder otherwise."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(writers))


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Queries that run in it delete their shuffle files as they end; otherwise those stay until the driver collects garbage."""
    with setting(spark, RELEASE, "true"):
        yield


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    files, at = folder(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def pointer(spark: SparkSession, path: str) -> dict | None:
    """The newest state of the table, with its number; None before the first change."""
    found = [n for n in names(spark, f"{path}/_versions") if n.endswith(".json") and not n.startswith(".")]
    if not found:
        return None
    return json.loads(spark.read.text(f"{path}/_versions/{found[-1]}", wholetext=True).first()[0]) | {"number": int(found[-1][:-5])}


def switch(spark: SparkSession, path: str, number: int, state: dict) -> None:
    """Make state the table's; number is one more than that of the state it was made from."""
    files, final = folder(spark, f"{path}/_versions/{number:012d}.json")
    _, draft = folder(spark, f"{path}/_versions/.{number:012d}-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"{path}: version {number} was written by someone else")


def cells(spark: SparkSession, path: str) -> list[str]:
    """Folders of buckets in one change's folder, or of their slices."""
    found = [n for n in names(spark, path) if n.startswith("bucket=")]
    inner = {n: [s for s in names(spark, f"{path}/{n}") if s.startswith("slice=")] for n in found}
    return [f"{n}/{s}" if s else n for n in found for s in inner[n] or [""]]


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes by bucket (17), or by bucket and slice (17/1998), of one change's folder: a file or a few each."""
    files, at = folder(spark, path)
    out: dict[str, int] = {}
    if files.exists(at):
        found = files.listFiles(at, True)
        while found.hasNext():
            s = found.next()
            parts = s.getPath().getParent().toString().split("/")
            parts = [v.partition("=")[2] for v in parts[-2:] if v.startswith(("bucket=", "slice="))]
            if parts:
                out["/".join(parts)] = out.get("/".join(parts), 0) + s.getLen()
    return out


def cell_folder(cell: str) -> str:
    bucket, _, part = cell.partition("/")
    return f"bucket={bucket}/slice={part}" if part else f"bucket={bucket}"


def gained(state: dict, bucket: str) -> list[str]:
    """Folders that a bucket has got since it was written last."""
    return state.get("gained", {}).get(bucket, [])


class Keyed:
    """A stored table with its keys; `by` (the keys, or the first of them) decides a row's bucket. With stamp (a timestamp's
    column) the table's state has the greatest one that was ever written, noted by the job that wrote it. With keep a change ends
    by deleting what only versions before the last `keep` name; see vacuum(). slices: an integer expression, never null, in
    whose order a row may depend on rows before it, never on those after it."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], buckets: int = BUCKETS, bucket_bytes: int = BUCKET_BYTES, stamp: str | None = None, keep: int | None = None, task_rows: int = TASK_ROWS, round_rows: int = ROUND_ROWS, slices: str | None = None):
        self.spark, self.path, self.by, self.buckets, self.bucket_bytes, self.stamp = spark, path.rstrip("/"), list(by), buckets, bucket_bytes, stamp
        self.keep, self.task_rows, self.round_rows, self.slices = keep, task_rows, round_rows, slices

    def state(self) -> dict | None:
        return pointer(self.spark, self.path)

    def number(self, buckets: int) -> Column:
        return F.pmod(F.hash(*self.by), F.lit(buckets))

    def read(self, only: Iterable[int | str] | None = None, state: dict | None = None) -> DataFrame | None:
        """The rows, of some buckets (with slices: 17/1998) where asked for; only their folders are listed and read. None before
        the first change."""
        state = state or self.state()
        if state is None:
            return None
        schema = T.StructType.fromJson(state["schema"])
        wanted = state["folders"] if only is None else [str(b) for b in only if str(b) in state["folders"]]
        paths = [f"{self.path}/data/{f}/{cell_folder(b)}" for b in wanted for f in (state["folders"][b], *gained(state, b))]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, fresh: DataFrame, change: Change, batch: int | None = None, keys: Sequence[str] | None = None) -> bool:
        """Put change(old, fresh, deal) in place of the buckets that rows of fresh fall into, old being their rows (None at
        first). change must give rows of those buckets only, and deal what it groups by the keys, so that one exchange
        serves its own work and the write. False where nothing changes: a numbered batch that is in already, or no rows.

        fresh is computed once for its keys alone and once a round, and never kept, so a load takes no more disk than a
        round's exchange and what it writes. A bucket with many rows is dealt as several tasks and files.

        keys, where given, say that change picks one row of each key as it is. Buckets in which no key occurs twice, stored
        or new, then get their new rows as files of their own, without an exchange, and keep those that they have."""
        state = self.state()
        if state is not None and batch is not None and state["batch"] is not None and batch <= state["batch"]:
            return False
        if keys and self.slices:
            raise ValueError("a table with slices takes no keys")
        n = state["buckets"] if state else self.buckets
        held = sum(state["bytes"].values()) if state else 0
        grown = n
        parts = len({c.partition("/")[2] for c in state["folders"]}) if state else 1  # slices
        while held > grown * self.bucket_bytes * max(1, parts):
            grown *= 2
        at = F.expr(self.slices) if self.slices else F.lit(0)
        with releasing(self.spark):
            found = fresh.groupBy(self.number(n).alias("b"), at.alias("s")).count().collect()  # at most n a slice
        counts: dict[int, int] = {}
        since: dict[int, int] = {}  # of each bucket the first slice that gets rows
        for b, s, c in found:
            counts[b], since[b] = counts.get(b, 0) + c, min(s, since.get(b, s))
        if state is not None and not counts and batch is None:
            return False

        def after(cell: str) -> bool:
            """Whether a cell (a bucket, or a slice of one) is written anew or gains rows."""
            bucket, _, part = cell.partition("/")
            return int(bucket) in since and (not part or int(part) >= since[int(bucket)])

        def of(some: Iterable[str], buckets: Iterable[int]) -> list[str]:
            return [c for c in some if int(c.partition("/")[0]) in buckets]

        stored = list(state["folders"]) if state else []
        touched = [c for c in stored if after(c)]
        other = state is not None and state.get("slices") != self.slices
        old = self.read(touched, state) if state else None
        schema = change(old, fresh, lambda df: df).schema if keys else None
        alone = self._single(old, fresh, schema, keys, n) & set(counts) if keys and counts and not other else set()
        alone = {b for b in alone if state is None or len(gained(state, str(b))) < FOLDERS}
        if alone and alone == set(counts):
            grown = n  # nothing is written anew, so whole rows need not be exchanged for it
        anew_all = state is None or grown != n or other
        if state is not None and anew_all:
            touched, alone, old = stored, set(), self.read(stored, state)
        before = [] if anew_all or not self.slices else [c for c in of(stored, since) if not after(c)]
        anew = set(range(grown)) if state is not None and anew_all else set(counts) - alone
        rows = sum(counts.values()) if state is not None and anew_all else sum(c for b, c in counts.items() if b in anew)
        moved = touched if anew_all else of(touched, anew)
        if moved:
            with releasing(self.spark):
                rows += self.read(moved, state).count()
        pieces = max(1, -(-rows // (self.task_rows * max(1, len(anew)))))
        rounds = min(ROUNDS, max(1, len(anew)), max(1, -(-rows // self.round_rows)))
        written, highs = uuid.uuid4().hex, []
        if anew or not counts:
            for i in range(rounds):
                some = set(sorted(anew)[i::rounds])
                news = fresh if rounds == 1 and not alone else fresh.where(self.number(grown).isin(sorted(some)))
                held_rows = None
                if state is not None:
                    held_rows = self.read(of(touched, some), state) if not anew_all else old if rounds == 1 else old.where(self.number(grown).isin(sorted(some)))
                earlier = of(before, some)
                more = {"earlier": self.read(earlier, state)} if earlier else {}
                new = change(held_rows, news, lambda df: df.repartition(grown * pieces, *self.by), **more)  # a multiple, so that a task has one bucket
                schema = new.schema
                highs.append(self._write(new, written, grown))
        if alone:
            part_of = fresh.where(self.number(n).isin(sorted(alone))) if anew else fresh
            part_of = part_of.select(*[f.name if f.name in part_of.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
            highs.append(self._write(part_of, written, n, n, 16 << 20))  # n files open in a task, so small blocks
        got = sizes(self.spark, f"{self.path}/data/{written}")
        if not anew_all and not all(after(c) for c in got):
            raise RuntimeError(f"{self.path}: the change gave rows of buckets that it was not given: {sorted(c for c in got if not after(c))}")
        gone = set(moved)
        kept = {} if anew_all else {c: f for c, f in state["folders"].items() if c not in gone}
        size = {c: state["bytes"][c] for c in kept}
        following = {
            "buckets": grown,
            "slices": self.slices,
            "schema": schema.jsonValue(),
            "folders": {c: written for c in got} | kept,
            "gained": {c: g for c in kept if (g := gained(state, c) + ([written] if c in got else []))},
            "bytes": size | {c: s + size.get(c, 0) for c, s in got.items()},
            "batch": batch if batch is not None else state["batch"] if state else None,
            "high": max((h for h in (state and state["high"], *highs) if h is not None), default=None),
        }
        switch(self.spark, self.path, state["number"] + 1 if state else 1, following)
        if self.keep:
            self.vacuum(self.keep)
        return True

    def _single(self, old: DataFrame | None, fresh: DataFrame, schema: T.StructType, keys: Sequence[str], n: int) -> set[int]:
        """Buckets in which no key occurs twice; none where the stored rows or the new ones have columns of other types."""
        kinds = {f.name: f.dataType for f in schema}
        if any(kinds.get(f.name) != f.dataType for df in (old, fresh) if df is not None for f in df.schema):
            return set()
        slim = [df.select(*dict.fromkeys([*self.by, *keys])) for df in (old, fresh) if df is not None]
        both = slim[0] if len(slim) == 1 else slim[0].unionByName(slim[1])
        with releasing(self.spark):
            found = both.groupBy(*both.columns).count().groupBy(self.number(n).alias("b")).agg(F.max("count")).collect()  # at most n
        return {b for b, most in found if most == 1}

    def _write(self, new: DataFrame, into: str, buckets: int, files: int = 1, block: int | None = None) -> int | None:
        """Add rows to a change's folder; their greatest stamp. files: buckets of which a task has rows."""
        seen = Observation()
        high = F.max(F.unix_micros(F.col(self.stamp).cast("timestamp"))) if self.stamp else F.lit(None).cast("long")
        parts = {"bucket": self.number(buckets)} | ({"slice": F.expr(self.slices)} if self.slices else {})
        with releasing(self.spark), stamped(self.spark), concurrent(self.spark, max(files, OPEN if self.slices else 1)):  # no sort of the rows by folder
            out = new.withColumns(parts).observe(seen, F.count(F.lit(1)).alias("rows"), high.alias("high")).write.mode("append").partitionBy(*parts).option("compression", "zstd")
            # numbers and hashes get no smaller by more work
            (out.option("parquet.block.size", block) if block else out.option("parquet.compression.codec.zstd.level", "1")).parquet(f"{self.path}/data/{into}")
        return seen.get.get("high")

    def above(self, source: DataFrame) -> DataFrame:
        """Rows of source newer than the newest of the table; all while it has none. The watermark is in the table's state, so
        none of its rows is read, and as a plain value it is pushed down to the scan of source."""
        state = self.state()
        if state is None or state["high"] is None:
            return source
        mark = F.timestamp_micros(F.lit(state["high"]))
        return source.where(F.col(self.stamp) > (mark.cast("timestamp_ntz") if dict(source.dtypes)[self.stamp] == "timestamp_ntz" else mark))

    def vacuum(self, keep: int = 2) -> int:
        """Delete what none of the last `keep` versions names, also what failed changes left; how many folders. No change
        may be under way, and readers of older versions lose their files."""
        versions = [n for n in names(self.spark, f"{self.path}/_versions") if n.endswith(".json") and not n.startswith(".")]
        named: dict[str, set[str]] = {}
        for v in versions[-keep:]:
            state = json.loads(self.spark.read.text(f"{self.path}/_versions/{v}", wholetext=True).first()[0])
            for c, f in state["folders"].items():
                for one in (f, *gained(state, c)):
                    named.setdefault(one, set()).add(cell_folder(c))
        gone = 0
        for f in names(self.spark, f"{self.path}/data"):
            stale = [c for c in cells(self.spark, f"{self.path}/data/{f}") if c not in named[f]] if f in named else [""]
            for c in stale:
                files, at = folder(self.spark, f"{self.path}/data/{f}/{c}" if c else f"{self.path}/data/{f}")
                gone += bool(files.delete(at, True))
        for v in versions[:-keep]:
            files, at = folder(self.spark, f"{self.path}/_versions/{v}")
            files.delete(at, False)
        return gone


def upsert_latest(keys: Sequence[str], *order: Column) -> Change:
    """Of each key the last row of old and fresh (order: what comes first wins); new columns are appended."""
    from lodestay.operators.incremental import latest

    def change(old: DataFrame | None, fresh: DataFrame, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return latest(deal(fresh if old is None else old.unionByName(fresh, allowMissingColumns=True)), list(keys), *order)

    return change
