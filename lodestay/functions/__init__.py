"""Column expressions shared by the operators. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: How far below a half still rounds up.
TIE = 1e-4


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: str | Column, places: int = 4) -> Column:
    """Half up to some places, as a double, by the same operations in any engine.

    What lies within a ten-thousandth of a unit below a half counts as the half, so that sums of doubles that were added in
    another order round alike.
    """
    scale = float(10**places)
    return F.floor(col(c).cast("double") * scale + (0.5 + TIE)) / scale


def mean(c: str | Column) -> Column:
    """Average by an exact sum (of a decimal or an integer) and a count."""
    return F.sum(col(c)).cast("double") / F.count(col(c))


def ratio(a: str | Column, b: str | Column, scale: float = 1.0) -> Column:
    """a / b * scale in doubles, null where b is zero."""
    return col(a).cast("double") / F.nullif(col(b).cast("double"), F.lit(0.0)) * scale


def count_of(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_of(condition: Column, value: str | Column) -> Column:
    return F.sum(F.when(condition, col(value)).otherwise(0))


def money(text: str | Column, digits: int = 12) -> Column:
    """`$1,234.50` to a decimal with two places; null where it is not a number."""
    bare = F.replace(F.replace(F.trim(col(text)), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))  # translate() takes a map look-up a character
    return F.nullif(bare, F.lit("")).try_cast(f"decimal({digits},2)")


def percent(text: str | Column) -> Column:
    """`95%` to decimal(5,2); null without a percent sign or a plain number."""
    bare = F.regexp_replace(col(text), "%", "")
    return F.when(col(text).contains("%") & bare.rlike(r"^[0-9]+(\.[0-9]+)?$"), bare.try_cast("decimal(5,2)"))


def flag(text: str | Column) -> Column:
    """`t` and `f` to a boolean, anything else to null."""
    return F.when(col(text) == "t", True).when(col(text) == "f", False)


def day(text: str | Column) -> Column:
    """A date written as yyyy-MM-dd or MM/dd/yyyy; null in any other form, or where there is no such day."""
    iso = F.when(col(text).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(col(text), "yyyy-MM-dd"))
    return F.coalesce(iso, F.when(col(text).rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_date(col(text), "MM/dd/yyyy")))


def whole_number(text: str | Column) -> Column:
    """A run of digits to a long, else null."""
    s = col(text).cast("string")
    return F.when(s.rlike("^[0-9]+$"), s.try_cast("bigint"))


def day_of_week(d: str | Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(col(d)) - 1


def record_hash(*columns: str | Column) -> Column:
    """md5 of the columns' texts between bars, null as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]))


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the columns' texts between hyphens, with a sentinel for null."""
    return F.md5(F.concat_ws("-", *[F.coalesce(col(c).cast("string"), F.lit("_null_")) for c in columns]))


def month_name(d: str | Column, padded: bool = True) -> Column:
    name = F.date_format(col(d), "MMMM")
    return F.rpad(name, 9, " ") if padded else name


def weekday_name(d: str | Column, padded: bool = True) -> Column:
    name = F.date_format(col(d), "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    """The column where the frame has it, else a default."""
    return F.col(name) if name in df.columns else default.alias(name)


def contains_any(text: str | Column, words: Sequence[str], lowered: bool = False) -> Column:
    """Whether a text holds one of the words, in any case; null text holds none. lowered: the text is in lower case already."""
    low = col(text) if lowered else F.lower(col(text))
    found = F.lit(False)
    for w in words:
        found = found | F.contains(low, F.lit(w.lower()))
    return F.coalesce(found, F.lit(False))
