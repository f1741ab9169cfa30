"""The whole warehouse as stored tables, brought up to date by what has arrived since: bronze batches, cleaned entities,
facts, dimensions with history, and the marts over them.

Each stored table knows by itself how far it has come (the newest `_ingested_at` that it holds), so a refresh takes from
bronze the batches after that alone, whose files the scan prunes by their statistics. Every table switches to its new state
in one step. A refresh that is lost between two tables leaves the later ones behind, and the next one catches up; run again
without new batches it changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.operators import clean, incremental, marts
from lodestay.operators.checks import Rule
from lodestay.sources import BATCH, folder, loading
from lodestay.sources.history import History
from lodestay.sources.keyed import TASK_ROWS, Keyed, releasing, upsert_latest

STAMP = "_ingested_at"
#: The columns that a delivery of each entity must have.
REQUIRED = {
    "listings": ("id", "host_id", "name", "price"),
    "calendar": ("listing_id", "date", "available", "price"),
    "reviews": ("id", "listing_id", "reviewer_id", "date"),
}


def _replace(old: DataFrame | None, fresh: DataFrame, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Reviewers as they come; the stored ones otherwise."""
    both = fresh if old is None else old.withColumn("__new", F.lit(0)).unionByName(fresh)
    return incremental.latest(deal(both), ["reviewer_id", "reviewer_name"], F.desc("__new")).drop("__new")


class Warehouse:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, positive: Sequence[str] = clean.POSITIVE, negative: Sequence[str] = clean.NEGATIVE, keep: int | None = None):
        """keep: how many versions of the stored tables stay; all where it is None (see Keyed.vacuum())."""
        self.spark, self.path, self.words = spark, path.rstrip("/"), (positive, negative)
        at = f"{self.path}/stored"
        self.listings = History(spark, f"{at}/dim_listings", "listing_id", buckets)
        self.calendar = Keyed(spark, f"{at}/fct_calendar_daily", ["listing_id"], buckets, stamp=STAMP, keep=keep, slices=marts.YEARS)
        self.reviews = Keyed(spark, f"{at}/reviews_cleaned", ["review_id"], buckets, stamp=STAMP, keep=keep, round_rows=1 << 20)  # whole texts
        self.reviewers = Keyed(spark, f"{at}/dim_reviewers", ["reviewer_id", "reviewer_name"], buckets, keep=keep)

    def deliver(self, entity: str, rows: DataFrame, batch_id: str, file_name: str, file_hash: str | None = None, rules: Sequence[Rule] = (), ingested_at: str | None = None) -> str:
        """A delivery of an entity as a bronze batch, with its checks, metrics and schema snapshots; the load's status."""
        stamp = F.lit(ingested_at).cast("timestamp") if ingested_at else None
        at = self.path
        return loading.load(rows, f"{at}/bronze/{entity}", f"{at}/metrics", entity, batch_id, file_name, file_hash, ingested_at=stamp, required=REQUIRED[entity], rules=rules, snapshots=f"{at}/snapshots")

    def bronze(self, entity: str) -> DataFrame | None:
        """Every batch of an entity, columns that came later being null in earlier ones. The schema is the last one kept, so no
        file is opened to find it."""
        last = loading.read_snapshots(self.spark, f"{self.path}/snapshots").where(F.col("table_name") == entity).orderBy(F.desc("number")).first()
        if last is None:
            return None
        columns = json.loads(last.schema_snapshot) | {STAMP: "timestamp", "_file_name": "string", BATCH: "string"}
        return self.spark.read.schema(", ".join(f"`{c}` {t}" for c, t in columns.items())).parquet(f"{self.path}/bronze/{entity}")

    def refresh(self) -> dict[str, bool]:
        """Bring every table up to date; which of them had something to take."""
        return {"listings": self.refresh_listings(), "calendar": self.refresh_calendar(), "reviews": self.refresh_reviews(), "reviewers": self.refresh_reviewers()}

    def refresh_listings(self) -> bool:
        """New and changed listings get a version from their newest stamp on."""
        raw = self.bronze("listings")
        if raw is None:
            return False
        state = self.listings.state()
        fresh = raw if state is None else raw.where(F.col(STAMP) > F.lit(state["as_of"]).cast("timestamp"))
        newest = fresh.agg(F.date_format(F.max(STAMP), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        if newest is None:
            return False
        cleaned = incremental.latest(clean.clean_listings(clean.stg_listings(fresh)), ["listing_id"], F.desc(STAMP), F.asc("record_hash"))
        return self.listings.apply(cleaned, newest)

    def refresh_calendar(self) -> bool:
        """Days newer than the facts hold; of a day that came more than once, the newest."""
        raw = self.bronze("calendar")
        if raw is None:
            return False
        fresh = clean.clean_calendar(clean.stg_calendar(self.calendar.above(raw)))
        return marts.load_calendar(self.calendar, fresh, order=[F.desc(STAMP), F.asc("record_hash")])

    def refresh_reviews(self) -> bool:
        raw = self.bronze("reviews")
        if raw is None:
            return False
        fresh = clean.clean_reviews(clean.stg_reviews(self.reviews.above(raw)), *self.words)
        return self.reviews.merge(fresh, upsert_latest(["review_id"], F.desc(STAMP), F.asc("record_hash")), keys=["review_id"])

    def refresh_reviewers(self) -> bool:
        """Reviews are grouped anew, as a review may have changed hands; only reviewers that changed are written. They are
        grouped once: dealt by reviewer, so that neither step of counting listings exchanges them, and kept while the load lasts."""
        held = self.reviews.read()
        if held is None:
            return False
        who = ["reviewer_id", "reviewer_name"]
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-held.count() // TASK_ROWS))
        whole = marts.dim_reviewers(held.select(*who, "review_date", "listing_id").repartition(tasks, *who))
        stored = self.reviewers.read()
        fresh = whole if stored is None else incremental.refresh_changed(whole, stored, who, "last_review_date", "total_reviews")
        kept = f"{self.path}/stored/.reviewers-{uuid.uuid4().hex}"
        files, at = folder(self.spark, kept)
        try:
            with releasing(self.spark):
                fresh.withColumn("__new", F.lit(1)).write.option("compression", "zstd").parquet(kept)
            return self.reviewers.merge(self.spark.read.schema(fresh.withColumn("__new", F.lit(1)).schema).parquet(kept), _replace)
        finally:
            files.delete(at, True)

    # What marts and analyses read.

    def facts(self) -> DataFrame:
        return self.calendar.read()

    def valid_reviews(self) -> DataFrame:
        return marts.fct_reviews(self.reviews.read())

    def current_listings(self) -> DataFrame:
        return incremental.scd1(self.listings.current())

    def batches(self) -> DataFrame:
        """Rows by entity and batch, from the metrics of the loads."""
        done = loading.read_metrics(self.spark, f"{self.path}/metrics").where("processing_status = 'COMPLETED'")
        return done.select("table_name", F.col("batch_id").alias(BATCH), "rows_inserted")
