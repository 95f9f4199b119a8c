"""Running operations in an explicit order: sums, forward fill, previous row.

All of them run as windows per key, or per (key, part) where ``splits`` cut a hot key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickframe.functions.numbers import ratio
from tickframe.operators.splits import P1, P2, Splits, null_safe

_POS, _TIE = "__pos", "__tie"


def _frame(df: DataFrame, keys: Sequence[str], pos: Column, tie: Column | None, splits):
    """The input with its order columns and, for hot keys, its part columns."""
    d = df.withColumn(_POS, pos)
    order = [_POS]
    if tie is not None:
        d = d.withColumn(_TIE, tie)
        order.append(_TIE)
    if splits is not None and splits.active:
        d = splits.assign(d, list(keys), _POS, tie=_TIE if tie is not None else None)
        return d, [*keys, P1, P2], order, True
    return d, list(keys), order, False


def _part_state(
    d: DataFrame, keys: Sequence[str], splits: Splits, aggs: list[Column], states: list[Column]
):
    """Per (hot key, part): state of all earlier parts. Rows: at most the number of parts."""
    rows = d
    if keys:
        hot = splits.table(d.sparkSession)
        pairs = [(k, f"__k{i}") for i, k in enumerate(keys)]
        rows = d.join(F.broadcast(hot), null_safe(d, hot, pairs), "left_semi")
    per_part = rows.groupBy(*keys, P1, P2).agg(*aggs)
    before = (
        Window.partitionBy(*keys).orderBy(P1, P2).rowsBetween(Window.unboundedPreceding, -1)
    )
    out = per_part.select(
        *[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)],
        F.col(P1).alias("__c_p1"),
        F.col(P2).alias("__c_p2"),
        *[s.over(before).alias(f"__s{i}") for i, s in enumerate(states)],
    )
    return out


def _attach(d: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the part state back; it holds hot keys only, so the number of bounds limits it."""
    pairs = [(k, f"__c{i}") for i, k in enumerate(keys)] + [(P1, "__c_p1"), (P2, "__c_p2")]
    return d.join(F.broadcast(state), null_safe(d, state, pairs), "left")


def _finish(d: DataFrame, columns: list[str], new: dict[str, Column]) -> DataFrame:
    return d.select(*columns, *[c.alias(n) for n, c in new.items()])


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    pos: Column,
    sums: dict[str, Column],
    tie: Column | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Cumulative sums per key in (pos, tie) order, inclusive of the row itself."""
    d, part, order, hot = _frame(df, keys, pos, tie, splits)
    for i, c in enumerate(sums.values()):
        d = d.withColumn(f"__x{i}", c)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    r = d.select("*", *[F.sum(f"__x{i}").over(w).alias(f"__r{i}") for i in range(len(sums))])
    if hot:
        state = _part_state(
            d, keys, splits,
            [F.sum(f"__x{i}").alias(f"__t{i}") for i in range(len(sums))],
            [F.sum(f"__t{i}") for i in range(len(sums))],
        )
        r = _attach(r, state, keys)
        new = {
            n: F.when(F.col(f"__s{i}").isNull(), F.col(f"__r{i}")).otherwise(
                F.col(f"__s{i}") + F.coalesce(F.col(f"__r{i}"), F.lit(0))
            )
            for i, n in enumerate(sums)
        }
    else:
        new = {n: F.col(f"__r{i}") for i, n in enumerate(sums)}
    return _finish(r, df.columns, new)


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    pos: Column,
    fills: dict[str, Column],
    tie: Column | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Last non-null value so far per key, in (pos, tie) order."""
    d, part, order, hot = _frame(df, keys, pos, tie, splits)
    for i, c in enumerate(fills.values()):
        d = d.withColumn(f"__x{i}", c)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    n = len(fills)
    r = d.select("*", *[F.last(f"__x{i}", True).over(w).alias(f"__r{i}") for i in range(n)])
    if hot:
        at = F.struct(*order)
        state = _part_state(
            d, keys, splits,
            [
                F.max_by(f"__x{i}", F.when(F.col(f"__x{i}").isNotNull(), at)).alias(f"__t{i}")
                for i in range(n)
            ],
            [F.last(f"__t{i}", True) for i in range(n)],
        )
        r = _attach(r, state, keys)
        new = {c: F.coalesce(F.col(f"__r{i}"), F.col(f"__s{i}")) for i, c in enumerate(fills)}
    else:
        new = {c: F.col(f"__r{i}") for i, c in enumerate(fills)}
    return _finish(r, df.columns, new)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    pos: Column,
    cols: dict[str, Column],
    tie: Column | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Value of the previous row per key, in (pos, tie) order; NULL on the first row."""
    d, part, order, hot = _frame(df, keys, pos, tie, splits)
    for i, c in enumerate(cols.values()):
        d = d.withColumn(f"__x{i}", c)
    w = Window.partitionBy(*part).orderBy(*order)
    n = len(cols)
    r = d.select(
        "*",
        F.row_number().over(w).alias("__rn"),
        *[F.lag(f"__x{i}").over(w).alias(f"__r{i}") for i in range(n)],
    )
    if hot:
        row = F.struct(*[F.col(f"__x{i}").alias(f"x{i}") for i in range(n)])
        state = _part_state(
            d, keys, splits,
            [F.max_by(row, F.struct(*order)).alias("__t")],
            [F.last("__t")],
        )
        r = _attach(r, state, keys)
        new = {
            c: F.when(F.col("__rn") == 1, F.col(f"__s0.x{i}")).otherwise(F.col(f"__r{i}"))
            for i, c in enumerate(cols)
        }
    else:
        new = {c: F.col(f"__r{i}") for i, c in enumerate(cols)}
    return _finish(r, df.columns, new)


def pct_change(
    df: DataFrame,
    keys: Sequence[str],
    pos: Column,
    value: str,
    out: str = "pct_change",
    tie: Column | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """value / previous value - 1 per key."""
    d = previous(df, keys, pos, {"__prev": F.col(value)}, tie, splits)
    return d.withColumn(out, ratio(F.col(value), F.col("__prev")) - F.lit(1.0)).drop("__prev")
