"""Incremental loads: watermark, keyed upserts, change detection, versioned dimensions. Frames in, frames out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestay.functions import rounded, surrogate_key

OPEN_END = "9999-12-31 23:59:59"
TRACKED = ("price", "host_is_superhost", "room_type", "minimum_nights")


def above_watermark(source: DataFrame, target: DataFrame, stamp: str = "_ingested_at") -> DataFrame:
    """Rows of source newer than the newest of target; all of them while target is empty. The watermark is one row."""
    mark = target.agg(F.max(stamp).alias("__mark"))
    return source.join(F.broadcast(mark), F.col("__mark").isNull() | (F.col(stamp) > F.col("__mark"))).drop("__mark")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target with the rows of source put in place of those with the same keys; new columns of source are appended.

    source has one row a key; latest() makes it so.
    """
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def merge(target: DataFrame, source: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """One full outer join: update columns from source where the key matches, insert what is new, keep the rest."""
    s = source.select(*keys, *[F.col(c).alias(f"__{c}") for c in source.columns if c not in keys], F.lit(True).alias("__in"))
    joined = target.withColumn("__was", F.lit(True)).join(s, keys, "full_outer")
    new, fed = F.col("__was").isNull(), F.col("__in")

    def value(c: str) -> Column:
        if c in keys or f"__{c}" not in joined.columns:
            return F.col(c)
        return F.when(new | fed & F.lit(c in update), F.col(f"__{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def same_schema(target: DataFrame, source: DataFrame) -> None:
    """The strict rule for schema changes: raises on any difference in names or types."""
    if target.dtypes != source.dtypes:
        raise ValueError(f"schema changed: {sorted(set(source.dtypes) ^ set(target.dtypes))}")


def append_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """The lenient rule: rows of both, missing columns as null."""
    return target.unionByName(source, allowMissingColumns=True)


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key in a log (order: what comes first wins)."""
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__nth = 1").drop("__nth")


def upsert_log(target: DataFrame, news: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """A keyed ledger after more events: of each key the last row of both (order: what comes first wins), so that events that
    arrive late or twice change nothing."""
    return latest(target.unionByName(news), keys, *order)


def detect_changes(source: DataFrame, current: DataFrame, key: str, stamp: str = "_ingested_at", digest: str = "record_hash") -> DataFrame:
    """source with requires_change: a new key, or newer data with another hash."""
    known = current.select(F.col(key), F.col(stamp).alias("__stamp"), F.col(digest).alias("__hash"), F.lit(True).alias("__known"))
    changed = F.col("__known").isNull() | (F.col(stamp) > F.col("__stamp")) & (F.col(digest) != F.col("__hash"))
    return source.join(known, key, "left").withColumn("requires_change", F.coalesce(changed, F.lit(False))).drop("__stamp", "__hash", "__known")


def version_columns(source: DataFrame, key: str, as_of: str) -> DataFrame:
    """source as open versions from as_of on."""
    opened = {"valid_from": F.lit(as_of).cast("timestamp"), "valid_to": F.lit(OPEN_END).cast("timestamp"), "is_current": F.lit(True)}
    return source.withColumns(opened).withColumn("version_sk", surrogate_key(key, F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss")))


def scd2(dim: DataFrame | None, source: DataFrame, key: str, as_of: str, stamp: str = "_ingested_at", digest: str = "record_hash") -> DataFrame:
    """A dimension with history after one more batch.

    New and changed keys get an open version from as_of; the version it replaces ends there; all others stay. Version keys
    hash the key and the start, so each version has its own, and the same batch again changes nothing. source has one row a
    key; as_of must rise from batch to batch.
    """
    start = F.lit(as_of).cast("timestamp")
    if dim is None:
        return version_columns(source, key, as_of)
    fresh = detect_changes(source, dim.where("is_current"), key, stamp, digest).where("requires_change").drop("requires_change")
    versions = version_columns(fresh, key, as_of)
    ended = dim.join(fresh.select(key, F.lit(True).alias("__ends")), key, "left")
    closes = F.col("is_current") & F.coalesce("__ends", F.lit(False))
    kept = ended.withColumns({"valid_to": F.when(closes, start).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~closes}).drop("__ends")
    return kept.select(*dim.columns).unionByName(versions.select(*dim.columns))


def scd1(dim: DataFrame) -> DataFrame:
    """Current rows only; the start of the version is its last update."""
    return dim.where("is_current").withColumnRenamed("valid_from", "last_updated_at").drop("valid_to", "is_current", "version_sk")


def scd3(dim: DataFrame, key: str, tracked: tuple[str, ...] = TRACKED, number: str | None = "price") -> DataFrame:
    """Current, previous and original values of tracked columns, in one grouping of the versions."""
    past = ~F.col("is_current")
    when = F.col("valid_from")
    out = dim.groupBy(key).agg(
        *[F.max_by(F.struct(c), F.when(F.col("is_current"), when))[c].alias(f"current_{c}") for c in tracked],
        *[F.max_by(F.struct(c), F.when(past, when))[c].alias(f"previous_{c}") for c in tracked],
        *[F.min_by(F.struct(c), when)[c].alias(f"original_{c}") for c in tracked],
        F.max(F.when(F.col("is_current"), when)).alias("current_values_from"),
        F.max(F.when(past, when)).alias("previous_values_from"),
        F.min(when).alias("original_values_from"),
    ).where("current_values_from IS NOT NULL")
    changed = lambda c: F.coalesce(F.col(f"current_{c}") != F.coalesce(f"previous_{c}", f"current_{c}"), F.lit(False))
    out = out.withColumns({f"{c}_changed": changed(c) for c in tracked})
    if number:
        now, old = F.col(f"current_{number}").cast("double"), F.col(f"previous_{number}").cast("double")
        out = out.withColumn(f"{number}_percent_change", F.when(old.isNotNull() & (now != old), rounded((now - old) / F.nullif(old, F.lit(0.0)) * 100, 2)).otherwise(0.0))
    return out


def refresh_changed(fresh: DataFrame, target: DataFrame, keys: list[str], last: str, total: str) -> DataFrame:
    """Rows of a dimension to write again: new keys, or a later last date, or another total."""
    t = target.select(*keys, F.col(last).alias("__last"), F.col(total).alias("__total"), F.lit(True).alias("__known"))
    changed = F.col("__known").isNull() | (F.col(last) > F.col("__last")) | (F.col(total) != F.col("__total"))
    return fresh.join(t, keys, "left").where(changed).drop("__last", "__total", "__known")
