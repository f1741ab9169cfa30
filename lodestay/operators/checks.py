"""Data-quality checks: failing rows, or one row of counts. Each is a filter or one aggregation, never a row-wise function."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The formats a timestamp column may have (the fraction has one digit or more), and the pattern of an address.
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
LOGICAL = {"tinyint": "BIGINT", "smallint": "BIGINT", "int": "BIGINT", "bigint": "BIGINT", "float": "DOUBLE PRECISION", "double": "DOUBLE PRECISION", "decimal": "NUMERIC", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "struct": "JSONB", "map": "JSONB", "array": "JSONB", "variant": "JSONB"}
#: What text must look like to be of a type; the first that fits every value is the column's type.
TEXT_TYPES = {"BIGINT": "^[+-]?[0-9]{1,18}$", "DOUBLE PRECISION": "^[+-]?[0-9]*[.]?[0-9]+([eE][+-]?[0-9]+)?$", "BOOLEAN": "^(true|false|t|f)$", "DATE": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "TIMESTAMP": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?$", "JSONB": "^ *[{\\[].*[}\\]] *$"}
#: By the start of a stored type, the starts of types that it takes besides its own.
TAKES = {"INTEGER": ("BIGINT", "INTEGER", "SMALLINT"), "BIGINT": ("BIGINT",), "NUMERIC": ("NUMERIC", "INTEGER", "BIGINT", "SMALLINT", "DOUBLE PRECISION"), "TEXT": ("TEXT", "VARCHAR", "CHAR"), "TIMESTAMP": ("TIMESTAMP", "TIMESTAMPTZ"), "BOOLEAN": ("BOOLEAN",), "JSONB": ("JSONB", "JSON"), "JSON": ("JSON", "JSONB")}


def infer_types(df: DataFrame) -> DataFrame:
    """column_name, filled (values that aren't null) and logical_type: a typed column's own, a text column's by all its values.

    One aggregation over the rows; a column without values is text.
    """
    text = [c for c, t in df.dtypes if t == "string"]
    fits = [F.count_if(F.col(f"`{c}`").rlike(p)).alias(f"{i}_{j}") for i, c in enumerate(text) for j, p in enumerate(TEXT_TYPES.values())]
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n_{i}") for i, c in enumerate(df.columns)], *fits)

    def kind(c: str, n: Column) -> Column:
        if c not in text:
            return F.lit(LOGICAL.get(dict(df.dtypes)[c].split("<")[0].split("(")[0], "TEXT"))
        rule = F
        for j, name in enumerate(TEXT_TYPES):
            rule = rule.when((n > 0) & (F.col(f"{text.index(c)}_{j}") == n), name)
        return rule.otherwise("TEXT")

    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("filled"), kind(c, F.col(f"n_{i}")).alias("logical_type")) for i, c in enumerate(df.columns)]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def declared_types(df: DataFrame) -> dict[str, str]:
    """Logical types from the columns' own types alone."""
    return {c: LOGICAL.get(t.split("<")[0].split("(")[0], "TEXT") for c, t in df.dtypes}


def takes(stored: str, new: str) -> bool:
    """Whether a stored column of one logical type takes values of another."""
    kinds = next((k for start, k in TAKES.items() if stored.startswith(start)), ())
    return stored == new or new.startswith(tuple(kinds)) and bool(kinds)


def compatible(new: DataFrame, stored: dict[str, str]) -> DataFrame:
    """new (column_name, logical_type) against stored types -> column_name, logical_type, stored, verdict of common columns:
    same, compatible, incompatible, or narrowing: a stored INTEGER takes a BIGINT, though large values won't fit."""
    spark = new.sparkSession
    known = spark.createDataFrame(sorted(stored.items()), "column_name string, stored string")
    taken = F.lit(False)
    for start, kinds in reversed(TAKES.items()):
        fits = reduce(lambda a, k: a | F.col("logical_type").startswith(k), kinds, F.lit(False))
        taken = F.when(F.col("stored").startswith(start), fits).otherwise(taken)
    verdict = F.when(F.col("stored") == F.col("logical_type"), "same").when(~taken, "incompatible").when((F.col("stored") == "INTEGER") & (F.col("logical_type") == "BIGINT"), "narrowing").otherwise("compatible")
    return new.join(F.broadcast(known), "column_name").select("column_name", "logical_type", "stored", verdict.alias("verdict"))  # a row a column


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """column_name, present, filled: whether each required column is there, and how many rows have a value in it."""
    filled = [(F.count(F.col(f"`{c}`")) if c in df.columns else F.count_if(F.lit(False))).alias(f"n{i}") for i, c in enumerate(required)]
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("present"), F.col(f"n{i}").alias("filled")) for i, c in enumerate(required)]
    return df.agg(*filled).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def timestamp_formats(df: DataFrame, c: str) -> DataFrame:
    """How many values each format can't read, and whether one format reads them all."""
    bad = [F.count_if(F.col(c).isNotNull() & F.try_to_timestamp(F.col(c), F.lit(f)).isNull()).alias(f"bad_{i}") for i, f in enumerate(TIMESTAMP_FORMATS)]
    out = df.agg(*bad)
    return out.withColumn("valid", F.least(*[f"bad_{i}" for i in range(len(TIMESTAMP_FORMATS))]) == 0)


def bad_json(df: DataFrame, c: str) -> DataFrame:
    """Rows whose text isn't JSON; null counts as invalid."""
    return df.where(F.try_parse_json(F.col(c)).isNull())


def array_items(c: str) -> Column:
    """`['a', 'b']`, `{a,b}` or `a,b` as an array of trimmed items; null where brackets don't match."""
    text = F.trim(F.col(c))
    inner = F.when(text.rlike(r"^\[.*\]$") | text.rlike(r"^\{.*\}$"), F.expr(f"substring(trim(`{c}`), 2, length(trim(`{c}`)) - 2)")).when(~text.rlike(r"[\[\]{}]"), text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(inner, ","), lambda x: F.btrim(x, F.lit(" '\""))))


def bad_arrays(df: DataFrame, c: str) -> DataFrame:
    return df.where(array_items(c).isNull())


def future_dates(df: DataFrame, c: str, as_of: str) -> DataFrame:
    return df.where(F.col(c) > F.lit(as_of).cast("timestamp"))


def negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in columns])


def bad_emails(df: DataFrame, c: str) -> DataFrame:
    return df.where(~F.coalesce(F.col(c).rlike(EMAIL), F.lit(False)))


def not_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values, or combinations, that occur more than once. Nulls don't count."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def is_null(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNull())


def not_accepted(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    return df.where(~F.col(c).isin(list(values))).groupBy(c).agg(F.count("*").alias("n"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")


def breaks(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which an SQL condition is false."""
    return df.where(~F.expr(expression))


def out_of_range(df: DataFrame, c: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(c) < low)
    return df.where(bad if high is None else bad | (F.col(c) > high))


def not_null_proportion(df: DataFrame, c: str, at_least: float) -> DataFrame:
    out = df.agg((F.count(c).cast("double") / F.nullif(F.count("*"), F.lit(0))).alias("proportion"))
    return out.withColumn("valid", F.col("proportion") >= at_least)


def freshness_status(df: DataFrame, scraped: str, ingested: str, loaded: str, as_of: Column) -> DataFrame:
    late = lambda c, hours: F.col(c) < as_of - F.expr(f"interval {hours} hours")
    status = F.when(late(scraped, 24), "stale_scrape").when(late(ingested, 1), "stale_ingest").when(late(loaded, 1), "stale_load").otherwise("fresh")
    return df.withColumn("freshness_status", status)


def verify_range(df: DataFrame, key: str, low: int, high: int, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(column, SQL condition, message) rules over low <= key < high in one pass: a row a rule with its failures."""
    held = df.where((F.col(key) >= low) & (F.col(key) < high))
    counts = held.agg(F.count("*").alias("rows"), *[F.count_if(~F.coalesce(F.expr(cond), F.lit(False))).alias(f"f{i}") for i, (_, cond, _) in enumerate(rules)])
    listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("message"), F.col(f"f{i}").alias("failures")) for i, (c, _, m) in enumerate(rules)])
    return counts.select("rows", F.explode(listed).alias("r")).select("rows", "r.*")


# Rules that a load measures while it writes.


@dataclass(frozen=True)
class Rule:
    """failures is an aggregate over a batch; fails, where the rule is one of rows, tells which break it. Only a fatal rule
    keeps the batch out."""

    name: str
    failures: Column
    fails: Column | None = None
    fatal: bool = True


def row_rule(name: str, fails: Column | str, fatal: bool = True) -> Rule:
    """A row breaks the rule where the condition is true; unknown is no failure."""
    condition = F.expr(fails) if isinstance(fails, str) else fails
    return Rule(name, F.count_if(F.coalesce(condition, F.lit(False))), condition, fatal)


def not_null_rule(c: str, at_least: float = 1.0, fatal: bool = True) -> Rule:
    """At least a share of the batch's rows has a value; the failures are the rows without one, or none where the share is reached."""
    empty, n = F.count_if(F.col(c).isNull()), F.count(F.lit(1))
    reached = F.count(F.col(c)).cast("double") >= n * F.lit(at_least)
    return Rule(f"not_null:{c}", F.when(reached, F.lit(0).cast("long")).otherwise(empty), F.col(c).isNull() if at_least >= 1 else None, fatal)


def accepted_rule(c: str, values: Sequence, fatal: bool = True) -> Rule:
    return row_rule(f"accepted:{c}", ~F.col(c).isin(list(values)), fatal)


def range_rule(c: str, low=None, high=None, fatal: bool = True) -> Rule:
    bad = F.lit(False) if low is None else F.col(c) < low
    return row_rule(f"range:{c}", bad if high is None else bad | (F.col(c) > high), fatal)


def email_rule(c: str, fatal: bool = True) -> Rule:
    return row_rule(f"email:{c}", F.col(c).isNotNull() & ~F.col(c).rlike(EMAIL), fatal)


def type_rules(declared: dict[str, str], as_of: Column) -> list[Rule]:
    """The rules of text columns that are declared as something else: one timestamp format reads all values, and none is after
    as_of; JSON parses (null counts as invalid); arrays have matching brackets (null likewise)."""
    out = []
    for c, kind in declared.items():
        if "TIMESTAMP" in kind:
            read = [F.try_to_timestamp(F.col(c), F.lit(f)) for f in TIMESTAMP_FORMATS]
            out.append(Rule(f"timestamp:{c}", F.least(*[F.count_if(F.col(c).isNotNull() & x.isNull()) for x in read])))
            out.append(row_rule(f"future:{c}", F.coalesce(*read) > as_of))
        elif "JSON" in kind:
            out.append(row_rule(f"json:{c}", F.try_parse_json(F.col(c)).isNull()))
        elif "[]" in kind:
            out.append(row_rule(f"array:{c}", array_items(c).isNull()))
    return out
