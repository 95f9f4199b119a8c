"""Exact quantiles, also beyond what one task can hold.

Columns that fit a task are sorted once and the wanted ranks joined out (on 600 k distinct
doubles about four times faster than the built-in exact percentile). Larger ones go through
distinct value counts (partial aggregation absorbs repeated values), a running count per column
that hot-key splits keep distributed, and a pick of the few values that cover the wanted ranks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tickframe.functions.numbers import drop_nan
from tickframe.operators.scans import running_sums
from tickframe.operators.splits import measure_splits, rank_in
from tickframe.session import scratch_path

# Largest number of values of one column that one task may sort.
IN_TASK_ROWS = 2_000_000


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    method: str = "linear",
    in_task_rows: int = IN_TASK_ROWS,
    sizes: dict[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles per column, NULL and NaN ignored; None for an empty column.

    ``method``: linear interpolation, "lower" (index rounded down) or "nearest" (rounded half
    up). The result holds columns * probs numbers. ``sizes`` are the numbers of present values
    per column, if the caller knows them.
    """
    columns = list(columns)
    if sizes is None:
        counts = df.agg(*[F.count(drop_nan(c)) for c in columns]).first()
        sizes = dict(zip(columns, counts))
    small = [c for c in columns if sizes[c] <= in_task_rows]
    large = [c for c in columns if sizes[c] > in_task_rows]
    out: dict[str, list[float | None]] = {}
    if small:
        out.update(_in_task(df, small, probs, method, sizes))
    if large:
        out.update(_distributed(df, large, probs, method, sizes, in_task_rows))
    return out


def _ranks(n: int, p: float, method: str) -> tuple[int, int, float]:
    """Lower index, upper index and weight of the upper one."""
    at = p * (n - 1)
    if method == "lower":
        return int(at), int(at), 0.0
    if method == "nearest":
        return int(at + 0.5), int(at + 0.5), 0.0
    lo = int(at)
    return lo, min(lo + 1, n - 1), at - lo


def _mix(lo: float, hi: float, w: float) -> float:
    return lo if w == 0.0 else (1.0 - w) * lo + w * hi


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, x) rows of all columns, missing values left out."""
    return df.select(
        F.inline(
            F.array(*[
                F.struct(F.lit(i).alias("col"), drop_nan(c).alias("x"))
                for i, c in enumerate(columns)
            ])
        )
    ).where("x IS NOT NULL")


def _needed(columns, probs, method, sizes) -> dict[int, list[int]]:
    """Ranks to look up per column number."""
    return {
        i: sorted({r for p in probs for r in _ranks(sizes[c], p, method)[:2]})
        for i, c in enumerate(columns)
        if sizes[c]
    }


def _assemble(columns, probs, method, sizes, at) -> dict[str, list[float | None]]:
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        if not sizes[c]:
            out[c] = [None] * len(probs)
            continue
        vals = []
        for p in probs:
            lo, hi, w = _ranks(sizes[c], p, method)
            vals.append(_mix(at[i, lo], at[i, hi], w))
        out[c] = vals
    return out


def _in_task(df, columns, probs, method, sizes) -> dict:
    need = _needed(columns, probs, method, sizes)
    pairs = [(i, r) for i, ranks in need.items() for r in ranks]
    at = {}
    if pairs:
        targets = df.sparkSession.createDataFrame(pairs, "tcol int, rank int")
        w = Window.partitionBy("col").orderBy("x")
        ranked = _long(df, columns).withColumn("r", F.row_number().over(w) - 1)
        hit = (F.col("col") == F.col("tcol")) & (F.col("r") == F.col("rank"))
        # one row per wanted rank
        got = ranked.join(F.broadcast(targets), hit).select("col", "r", "x").collect()
        at = {(g["col"], g["r"]): g["x"] for g in got}
    return _assemble(columns, probs, method, sizes, at)


def _distributed(df, columns, probs, method, sizes, in_task_rows) -> dict:
    spark = df.sparkSession
    path = scratch_path(spark, "value-counts")
    _long(df, columns).groupBy("col", "x").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    splits = measure_splits(counts, ["col"], F.col("x"), min_rows=max(in_task_rows // 4, 1))
    cum = running_sums(counts, ["col"], F.col("x"), {"upto": F.col("n")}, splits=splits)
    need = _needed(columns, probs, method, sizes)
    targets = spark.createDataFrame(list(need.items()), "tcol int, ranks array<bigint>")
    longest = max(len(r) for r in need.values())
    j = cum.join(F.broadcast(targets), F.col("col") == F.col("tcol"))
    before = rank_in(F.col("ranks"), F.col("upto") - F.col("n") - 1, longest, strict=False)
    through = rank_in(F.col("ranks"), F.col("upto") - 1, longest, strict=False)
    hits = (
        j.select("col", "x", "ranks", before.alias("a"), through.alias("b"))
        .where("b > a")
        .select("col", "x", F.explode(F.slice("ranks", F.col("a") + 1, F.col("b") - F.col("a"))).alias("r"))
        .collect()  # at most two rows per wanted quantile
    )
    at = {(h["col"], h["r"]): h["x"] for h in hits}
    return _assemble(columns, probs, method, sizes, at)
