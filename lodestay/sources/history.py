"""A dimension with history (SCD 2) as stored files: current versions bucketed by key, closed ones never touched again.

    table/data/<change>/is_current=true/...     every current version as of that change, in buckets by key
    table/data/<change>/is_current=false/...    the versions that the change closed
    table/_versions/000000000003.json           which folders make up the table (see keyed.py)

A change reads the current versions alone, and as they lie in buckets by their key it exchanges only the batch; the join and
the write follow those buckets. It writes the current versions anew and the closed ones once, in one job, and switches with
one rename. Closed folders stay as they are for good, so the cost of a change follows the current versions and not the history.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.operators.incremental import scd2, version_columns
from lodestay.sources import folder
from lodestay.sources.keyed import names, pointer, releasing, switch


class History:
    """source has one row a key in every batch; as_of must rise from batch to batch (an equal or older one changes nothing)."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 16, stamp: str = "_ingested_at", digest: str = "record_hash"):
        self.spark, self.path, self.key, self.buckets, self.stamp, self.digest = spark, path.rstrip("/"), key, buckets, stamp, digest

    def state(self) -> dict | None:
        return pointer(self.spark, self.path)

    def current(self, state: dict | None = None) -> DataFrame | None:
        """Current versions, as a bucketed table; a session that hasn't written it makes it known to its catalog first."""
        state = state or self.state()
        if state is None:
            return None
        if not self.spark.catalog.tableExists(state["table"]):
            schema = T.StructType.fromJson(state["schema"])
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "is_current")
            self.spark.sql(f"CREATE TABLE {state['table']} ({columns}, is_current boolean) USING parquet PARTITIONED BY (is_current) CLUSTERED BY (`{self.key}`) INTO {state['buckets']} BUCKETS LOCATION '{self.path}/data/{state['current']}'")
            self.spark.catalog.recoverPartitions(state["table"])
        return self.spark.table(state["table"]).where("is_current").select(*[f["name"] for f in state["schema"]["fields"]])

    def read(self, state: dict | None = None) -> DataFrame | None:
        """All versions."""
        state = state or self.state()
        if state is None:
            return None
        now = self.current(state)
        if not state["closed"]:
            return now
        schema = T.StructType([f for f in now.schema if f.name != "is_current"])
        past = self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}/is_current=false" for f in state["closed"]])
        return now.unionByName(past.withColumn("is_current", F.lit(False)))

    def following(self, source: DataFrame, as_of: str, state: dict) -> DataFrame:
        """Current versions after a batch, and those that it closes: one pass over the current ones, joined in their buckets."""
        now = self.current(state)
        start = F.lit(as_of).cast("timestamp")
        fresh = version_columns(source, self.key, as_of)
        columns = now.columns
        old = now.select(F.col(self.key).alias("__key"), F.struct(*columns).alias("__old"))
        new = fresh.select(F.col(self.key).alias("__id"), F.struct(*[F.col(c).cast(now.schema[c].dataType).alias(c) for c in columns]).alias("__new"))
        both = old.join(new, F.col("__key") == F.col("__id"), "full_outer")
        known, fed = F.col("__old").isNotNull(), F.col("__new").isNotNull()
        later = (F.col("__new")[self.stamp] > F.col("__old")[self.stamp]) & (F.col("__new")[self.digest] != F.col("__old")[self.digest])
        changed: Column = fed & (~known | F.coalesce(later, F.lit(False)))
        closed = F.when(changed & known, F.col("__old").withField("valid_to", start).withField("is_current", F.lit(False)))
        stays = F.when(changed, F.col("__new")).otherwise(F.col("__old"))
        return both.select(F.explode(F.array_compact(F.array(stays, closed))).alias("v")).select("v.*")

    def apply(self, source: DataFrame, as_of: str) -> bool:
        """One batch; whether it was taken."""
        state = self.state()
        if state is not None and as_of <= state["as_of"]:
            return False
        n = state["buckets"] if state else self.buckets
        rows = self.following(source, as_of, state) if state else scd2(None, source, self.key, as_of).repartition(n, self.key)
        written = uuid.uuid4().hex
        table = f"history_{written}"
        with releasing(self.spark):
            rows.write.partitionBy("is_current").bucketBy(n, self.key).option("path", f"{self.path}/data/{written}").option("compression", "zstd").format("parquet").saveAsTable(table)
        closed = [written] if "is_current=false" in names(self.spark, f"{self.path}/data/{written}") else []
        following = {"table": table, "current": written, "closed": (state["closed"] if state else []) + closed, "buckets": n, "as_of": as_of, "schema": json.loads(rows.schema.json())}
        switch(self.spark, self.path, state["number"] + 1 if state else 1, following)
        return True

    def vacuum(self) -> int:
        """Delete current versions that were superseded, and what failed changes left; how many folders. No change may be under way."""
        state, gone = self.state(), 0
        for f in names(self.spark, f"{self.path}/data") if state else []:
            stale = f"{self.path}/data/{f}/is_current=true" if f in state["closed"] else f"{self.path}/data/{f}"
            if f != state["current"]:
                files, at = folder(self.spark, stale)
                gone += bool(files.exists(at) and files.delete(at, True))
        return gone
