"""Filters, set differences, lookups and small aggregates over any table."""

from __future__ import annotations

import re
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickframe.functions.numbers import valid_price, valid_size, valid_symbol
from tickframe.functions.times import as_col, micros


# ---- selection and filters -------------------------------------------------------------

def as_columns(items: Sequence[str | Column] | str | Column) -> list[Column]:
    """Names or expressions, one or many, as Columns."""
    if isinstance(items, (str, Column)):
        items = [items]
    return [as_col(c) for c in items]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def with_suffix(df: DataFrame, names: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({n: n + suffix for n in names})


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed(
        {c: c[: -len(suffix)] for c in df.columns if c.endswith(suffix)}
    )


class Ranges:
    """Per-column closed ranges; an open side is None. Immutable edits."""

    def __init__(self, bounds: dict[str, tuple[Any, Any]] | None = None):
        self.bounds = dict(bounds or {})

    def with_range(self, name: str, lo: Any, hi: Any) -> "Ranges":
        kept = {k: v for k, v in self.bounds.items() if k != name}
        return Ranges({**kept, name: (lo, hi)})

    def without(self, name: str) -> "Ranges":
        return Ranges({k: v for k, v in self.bounds.items() if k != name})

    def predicate(self) -> Column:
        cond = F.lit(True)
        for name, (lo, hi) in self.bounds.items():
            if lo is not None:
                cond = cond & (F.col(name) >= F.lit(lo))
            if hi is not None:
                cond = cond & (F.col(name) <= F.lit(hi))
        return cond

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.predicate()) if self.bounds else df

    def retention(self, df: DataFrame) -> DataFrame:
        """Rows kept, all rows and their share in one pass."""
        kept = F.count_if(self.predicate())
        return df.agg(kept.alias("kept_rows"), F.count(F.lit(1)).alias("total_rows")).withColumn(
            "kept_share", F.try_divide(F.col("kept_rows").cast("double"), F.col("total_rows"))
        )

    def frame(self, df: DataFrame) -> DataFrame:
        """The two-row (min, max) table of the ranges, typed like the filtered table."""
        fields = [T.StructField(n, df.schema[n].dataType) for n in self.bounds]
        rows = [tuple(b[i] for b in self.bounds.values()) for i in (0, 1)]
        schema = T.StructType([T.StructField("bound", T.StringType()), *fields])
        return df.sparkSession.createDataFrame(
            [("min", *rows[0]), ("max", *rows[1])], schema
        )

    @classmethod
    def from_frame(cls, table: DataFrame) -> "Ranges":
        rows = {r["bound"]: r for r in table.collect()}  # two rows
        return cls(
            {c: (rows["min"][c], rows["max"][c]) for c in table.columns if c != "bound"}
        )


def split_valid(
    df: DataFrame, symbol: str = "symbol", prices: Sequence[str] = ("price",),
    sizes: Sequence[str] = ("size",),
) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): finite non-negative prices, finite positive sizes, a symbol."""
    ok = valid_symbol(symbol)
    for p in prices:
        ok = ok & valid_price(p)
    for s in sizes:
        ok = ok & valid_size(s)
    return df.where(ok), df.where(~ok)


def known_symbols(df: DataFrame, universe: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows whose symbol is in the universe (semi join)."""
    return df.join(universe.select(symbol).distinct(), symbol, "left_semi")


# ---- set operations --------------------------------------------------------------------

def missing_pairs(
    wanted: DataFrame, present: DataFrame, on: Sequence[str] = ("symbol", "date")
) -> DataFrame:
    return wanted.select(*on).distinct().join(present.select(*on), list(on), "left_anti")


def universe_changes(
    before: DataFrame, after: DataFrame, on: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Rows added or removed between two snapshots, with a ``change`` column."""
    b = before.select(*on).distinct().withColumn("__b", F.lit(1))
    a = after.select(*on).distinct().withColumn("__a", F.lit(1))
    j = b.join(a, list(on), "full")
    change = F.when(F.col("__b").isNull(), "added").when(F.col("__a").isNull(), "removed")
    return j.withColumn("change", change).where("change IS NOT NULL").drop("__a", "__b")


# ---- lookups ---------------------------------------------------------------------------

def map_symbol(
    df: DataFrame, mapping: DataFrame, column: str, source: str, target: str
) -> DataFrame:
    """Translate a symbol column through a one-to-one map; unmapped values stay as they are."""
    m = mapping.select(F.col(source).alias("__from"), F.col(target).alias("__to"))
    j = df.join(m, df[column] == m["__from"], "left")
    return j.withColumn(column, F.coalesce("__to", column)).drop("__from", "__to")


def zip_positions(df: DataFrame, names: str, values: str, out: Sequence[str]) -> DataFrame:
    """Explode two parallel arrays side by side; the shorter one limits the result."""
    n = F.least(F.size(names), F.size(values))
    both = F.arrays_zip(F.slice(names, 1, n), F.slice(values, 1, n))
    rest = [c for c in df.columns if c not in (names, values)]
    d = df.select(*rest, F.posexplode(both).alias("pos", "__z"))
    return d.select(
        *rest, "pos", F.col("__z.`0`").alias(out[0]), F.col("__z.`1`").alias(out[1])
    )


def pair_symbols(pairs: DataFrame, tokens: DataFrame, sep: str = "-") -> DataFrame:
    """Resolve a pair's two token indices to names: pairs(name, tokens[2]), tokens(index, name)."""
    from tickframe.functions.text import clean_symbol

    t0 = tokens.select(F.col("index").alias("__i0"), F.col("name").alias("base"))
    t1 = tokens.select(F.col("index").alias("__i1"), F.col("name").alias("quote"))
    j = (
        pairs.join(t0, F.element_at("tokens", 1) == t0["__i0"], "left")
        .join(t1, F.element_at("tokens", 2) == t1["__i1"], "left")
        .drop("__i0", "__i1")
    )
    return j.withColumn(
        "symbol", F.concat(clean_symbol("base"), F.lit(sep), clean_symbol("quote"))
    )


def pairs_with_token(pairs: DataFrame, tokens: DataFrame, top: int = 5) -> DataFrame:
    """For each token the pairs that contain it, with the other token's name, best volumes
    first. ``pairs`` has name, tokens[2], volume."""
    legs = pairs.select(
        "name", "volume", F.posexplode("tokens").alias("pos", "index"), "tokens"
    ).withColumn("other_index", F.element_at("tokens", 2 - F.col("pos")))
    t = tokens.select("index", F.col("name").alias("token"))
    o = tokens.select(F.col("index").alias("other_index"), F.col("name").alias("other_token"))
    j = legs.join(t, "index").join(o, "other_index", "left")
    w = Window.partitionBy("token").orderBy(F.col("volume").desc(), "name")
    return (
        j.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= top)
        .select("token", "rank", F.col("name").alias("pair"),
                F.coalesce("other_token", F.lit("Unknown")).alias("other_token"), "volume")
    )


# ---- aggregates ------------------------------------------------------------------------

def symbols_per_date(df: DataFrame) -> DataFrame:
    """Exact distinct symbols per date, in two hash aggregations that share no hot key."""
    return (
        df.select("date", "symbol").where(F.col("symbol").isNotNull()).distinct()
        .groupBy("date").agg(F.count(F.lit(1)).alias("n_symbols"))
    )


def null_summary(df: DataFrame, by: Sequence[str], value: str, lag: str) -> DataFrame:
    """Row count, null share, sum, and max / mean lag per group."""
    rows = F.count(F.lit(1))
    return df.groupBy(*by).agg(
        rows.alias("n_rows"),
        (F.count_if(F.col(value).isNull()) / rows).alias("null_frac"),
        F.sum(value).alias("sum_value"),
        F.max(lag).alias("max_lag"),
        F.avg(lag).alias("mean_lag"),
    )


def column_ranges(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(min, max) of several columns in one pass, one row per column, as text of its type."""
    one = df.agg(
        *[F.min(n).alias(f"lo{i}") for i, n in enumerate(names)],
        *[F.max(n).alias(f"hi{i}") for i, n in enumerate(names)],
    )
    items = [
        F.struct(F.lit(n).alias("column"), F.col(f"lo{i}").cast("string").alias("min"),
                 F.col(f"hi{i}").cast("string").alias("max"))
        for i, n in enumerate(names)
    ]
    return one.select(F.inline(F.array(*items)))


def histogram(df: DataFrame, names: Sequence[str] | None = None, bins: int = 50) -> DataFrame:
    """Equal-width counts per numeric column, empty bins included.

    One pass for the ranges, one for the counts; each task keeps at most columns * bins groups.
    """
    if names is None:
        names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    x = {n: F.nanvl(F.col(n).cast("double"), F.lit(None).cast("double")) for n in names}
    ends = df.agg(
        *[F.min(x[n]).alias(f"lo{i}") for i, n in enumerate(names)],
        *[F.max(x[n]).alias(f"hi{i}") for i, n in enumerate(names)],
    ).first()
    items, frame = [], []
    for i, n in enumerate(names):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None:
            continue
        width = (hi - lo) / bins
        pos = F.floor((x[n] - F.lit(lo)) / F.lit(width or 1.0)).cast("int")
        items.append(F.struct(F.lit(n).alias("column"),
                              F.least(pos, F.lit(bins - 1)).alias("bin"), x[n].alias("__x")))
        frame += [(n, b, lo + b * width, lo + (b + 1) * width) for b in range(bins)]
    schema = "column string, bin int, bin_start double, bin_end double"
    grid = df.sparkSession.createDataFrame(frame, schema)
    if not items:
        return grid.withColumn("count", F.lit(0).cast("long"))
    counts = (
        df.select(F.inline(F.array(*items))).where("__x IS NOT NULL")
        .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    )
    return grid.join(F.broadcast(counts), ["column", "bin"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0)).cast("long")
    )


def staleness(
    df: DataFrame, by: Sequence[str], time: str, now: Column | None = None
) -> DataFrame:
    """Microseconds since the last update per group."""
    now_us = micros(now if now is not None else F.current_timestamp())
    return df.groupBy(*by).agg(F.max(time).alias("last_update")).withColumn(
        "staleness_us", now_us - micros("last_update")
    )


def pivot_by(
    df: DataFrame, row: str, column: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Long to wide, for the given column values or for all there are (Spark refuses more than
    ``spark.sql.pivotMaxValues``)."""
    values = None if columns is None else list(columns)
    return df.groupBy(row).pivot(column, values).agg(F.first(value, ignorenulls=True))
