"""From raw documents to packed training sequences: each stage reads what its predecessor kept, written as Parquet.

Every stage takes an empty table and gives one; columns beside those it works on pass through, whatever their names; no stage
cuts a long text but the mix (at the total budget) and the packing (into pieces)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestay.llm import linededup, mixing, packing, quality, simhash
from lodestay.llm.common import documents, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps: short ones stay, null and blank texts go, repeated rows are judged alike."""
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document, or an earlier line, already has, equal or within a few edits.

    Earlier is by doc_id, nulls last, ties by a hash of the document; a text may end up empty, a null one stays null."""
    return linededup.without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id, nulls last, ties by a hash of the row. Null and
    wordless texts are one group, of rows equal in every column one stays."""
    return simhash.one_of_each_group(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix sends them, in its order; wordless ones are never sent, equal rows count each."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; a null text is one end token."""
    return packing.pack(docs, with_ids=False)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("source_mix", source_mix), ("pack", pack)]
#: Fingerprints, tokenizer ids and differencing can't be written in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
