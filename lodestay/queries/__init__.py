"""The registry: every query as (Spark callable, SQL to compare with or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestay.functions import TIE, rounded

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"{name} is registered twice")
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = sql


def flat(df: DataFrame) -> DataFrame:
    """Decimals and doubles as doubles of four places, for comparison across engines."""
    return df.select(*[rounded(c).alias(c) if t == "double" or t.startswith("decimal") or t == "float" else c for c, t in df.dtypes])


def r(x: str, places: int = 4) -> str:
    """SQL that rounds as lodestay.functions.rounded does."""
    return f"floor(({x})::DOUBLE * {float(10**places)}::DOUBLE + {0.5 + TIE}::DOUBLE) / {float(10**places)}::DOUBLE"


def b(x: str) -> str:
    return f"({x})::BIGINT"
