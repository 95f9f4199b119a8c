"""Rolling time windows of any mergeable aggregate, linear in the rows.

Time is cut into slices, so many to a window. A window is the end of its first slice, the whole
slices in between and the beginning of its last one. Ends and beginnings are running aggregates
inside a slice, whole slices are combined from one row each: no frame ever holds the window's rows,
and a hot key is cut by its slices.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickframe.functions.times import micros, to_us
from tickframe.operators.splits import null_safe


@dataclass(frozen=True)
class Merged:
    """``value`` of a row; ``merge`` aggregates values; ``combine`` does the same for a few columns.

    NULL stands for nothing to merge.
    """

    value: Column
    merge: Callable[[Column], Column]
    combine: Callable[..., Column]


def _add(*parts: Column) -> Column:
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), total)


def least_of(value: Column) -> Merged:
    return Merged(value, F.min, F.least)


def greatest_of(value: Column) -> Merged:
    return Merged(value, F.max, F.greatest)


def sum_of(value: Column) -> Merged:
    """Exact for whole numbers and decimals; doubles are added up in the order of the slices."""
    return Merged(value, F.sum, _add)


def count_of(value: Column) -> Merged:
    """Values that are not NULL; none gives NULL, which callers may turn into 0."""
    return Merged(F.when(value.isNotNull(), F.lit(1).cast("long")), F.sum, _add)


def rolling_merged(
    df: DataFrame, by: Sequence[str], time: str, period: timedelta, measures: dict[str, Merged], slices: int = 24,
) -> DataFrame:
    """``df`` with every measure over the rows of the same key in [time - period, time).

    ``slices`` to a window; the number is lowered until it divides the period. Rows of the same time
    are outside each other's windows. A window without rows gives NULL, and so does a NULL time.
    """
    length = to_us(period)
    count = next(k for k in range(min(slices, length), 0, -1) if length % k == 0)
    names = list(measures)
    key = [F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]
    keys = [f"__k{i}" for i in range(len(by))]
    us = micros(time)
    rows = df.select(
        F.struct("*").alias("__row"), *key, us.alias("__us"), F.floor(us / (length // count)).cast("long").alias("__slice"),
        *[m.value.alias(f"__v{i}") for i, m in enumerate(measures.values())],
    )
    inside = Window.partitionBy(*keys, "__slice")
    before = inside.orderBy("__us").rangeBetween(Window.unboundedPreceding, -1)
    after = inside.orderBy(F.col("__us").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    merge = [m.merge for m in measures.values()]
    rows = rows.select(
        "__row", *keys, "__us", "__slice", *[g(F.col(f"__v{i}")).over(before).alias(f"__b{i}") for i, g in enumerate(merge)],
        *[g(F.col(f"__v{i}")).over(after).alias(f"__e{i}") for i, g in enumerate(merge)], *[f"__v{i}" for i in range(len(merge))],
    )
    known = rows.where("__us IS NOT NULL")
    # One row per slice, and the whole slices before it.
    whole = known.groupBy(*keys, "__slice").agg(*[g(F.col(f"__v{i}")).alias(f"__w{i}") for i, g in enumerate(merge)])
    between = Window.partitionBy(*keys).orderBy("__slice").rangeBetween(1 - count, -1)
    whole = whole.select(
        *[F.col(k).alias(f"{k}_") for k in keys], F.col("__slice").alias("__slice_"),
        *[(g(F.col(f"__w{i}")).over(between) if count > 1 else F.first(F.lit(None)).over(between)).alias(f"__w{i}") for i, g in enumerate(merge)],
    )
    # Ends of slices, moved to where windows begin: a row takes the nearest one that is not before it.
    ends = known.select(
        F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), *keys, (F.col("__us") + length).alias("__us"),
        (F.col("__slice") + count).alias("__slice"), *[F.lit(None).cast(rows.schema[f"__b{i}"].dataType).alias(f"__b{i}") for i in range(len(merge))],
        *[f"__e{i}" for i in range(len(merge))], F.lit(0).alias("__turn"),
    )
    asking = rows.select(
        "__row", *keys, "__us", "__slice", *[f"__b{i}" for i in range(len(merge))],
        *[F.lit(None).cast(rows.schema[f"__e{i}"].dataType).alias(f"__e{i}") for i in range(len(merge))], F.lit(1).alias("__turn"),
    )
    down = inside.orderBy(F.col("__us").desc(), "__turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = ends.unionByName(asking).select(
        "__row", *keys, "__us", "__slice", "__turn", *[f"__b{i}" for i in range(len(merge))],
        *[F.last(f"__e{i}", ignorenulls=True).over(down).alias(f"__e{i}") for i in range(len(merge))],
    ).where("__turn = 1")
    joined = both.join(whole, null_safe(both, whole, [*((k, f"{k}_") for k in keys), ("__slice", "__slice_")]), "left")
    made = [
        F.when(F.col("__us").isNotNull(), m.combine(F.col(f"__e{i}"), F.col(f"__w{i}"), F.col(f"__b{i}"))).alias(n)
        for i, (n, m) in enumerate(measures.items())
    ]
    return joined.select(*[F.col("__row")[c].alias(c) for c in df.columns], *made)
