"""Symbol names, path names and display labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickframe.functions.times import as_col

# Fixed patterns.
SYMBOL_JUNK = r"[^\p{L}\p{N}_-]"
STREAM_NAME = r"^[A-Za-z0-9_/-]+$"
FILE_DATE = r"(\d{4}-\d{2}-\d{2})"


def clean_symbol(c: str | Column) -> Column:
    """Keep letters, digits, underscore and hyphen."""
    return F.regexp_replace(as_col(c), SYMBOL_JUNK, "")


def perp_name(c: str | Column) -> Column:
    return F.concat(clean_symbol(c), F.lit("_PERP"))


def pair_name(base: str | Column, quote: str | Column) -> Column:
    return F.concat_ws("-", clean_symbol(base), clean_symbol(quote))


def date_in(c: str | Column) -> Column:
    """First ISO date inside a text, NULL when there is none or it is not a real date."""
    return F.try_to_timestamp(
        F.nullif(F.regexp_extract(as_col(c), FILE_DATE, 1), F.lit("")), F.lit("yyyy-MM-dd")
    ).cast("date")


def valid_stream_name(c: str | Column) -> Column:
    """Non-empty, no empty or parent segments, only letters, digits, ``-``, ``_`` and ``/``."""
    c = as_col(c)
    return F.coalesce(
        c.rlike(STREAM_NAME) & ~c.contains("//") & ~c.contains(".."), F.lit(False)
    )


def label_kind(df: DataFrame, name: str) -> str:
    """Display kind of a column from its schema type."""
    t = df.schema[name].dataType
    if isinstance(t, T.DayTimeIntervalType):
        return "duration"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(t, T.DateType):
        return "date"
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return "float"
    return "plain"


def label(c: str | Column, kind: str) -> Column:
    """Text label: floats with 2 decimals, durations in seconds with 3, ISO-like times."""
    from tickframe.functions.times import interval_us

    c = as_col(c)
    if kind == "float":
        return F.format_string("%.2f", c.cast("double"))
    if kind == "duration":
        return F.format_string("%.3fs", interval_us(c) / F.lit(1e6))
    if kind == "timestamp":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    return c.cast("string")
