"""Distinct counts and medians that merge: sketches by fine keys, stored once, combined upward without the rows.

Exact counts and medians can't be put together from parts (a reviewer of two months would count twice); sketches can. Their
size is fixed by a parameter, so a month's or a year's answer reads a few kilobytes a group. Both come with the bound of their
error; the exact modes (countDistinct, percentile) stay where a report asks for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, KLL_K = 12, 400


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative error that 99.7 of 100 estimates stay within (three standard errors)."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """Error of a quantile's rank that 99 of 100 stay within, as a share of the rows."""
    return 2.296 / k**0.9723


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """keys and sketch: the distinct values of each group. Nulls count nowhere."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merge_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fewer keys, or none: the sketches of each group put together."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct(sketch: str | Column = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = KLL_K) -> DataFrame:
    """keys and sketch: the distribution of each group's values, as doubles. Nulls count nowhere; a group of nulls alone has
    an empty sketch."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merge_quantiles(sketches: DataFrame, keys: Sequence[str], k: int = KLL_K) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantile(q: float = 0.5, sketch: str | Column = "sketch") -> Column:
    """A value whose rank is q within rank_error; null for an empty sketch."""
    held = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.when(F.kll_sketch_get_n_double(held) > 0, F.kll_sketch_get_quantile_double(held, F.lit(q)))
