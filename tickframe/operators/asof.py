"""Backward as-of join per key, inclusive, with optional tolerance."""

from __future__ import annotations

from datetime import timedelta
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickframe.functions.times import from_micros, micros, to_us
from tickframe.operators.splits import P1, P2, Splits, measure_splits, null_safe


def order_position(us, is_query: bool):
    """Sort position in which ticks come before queries of the same microsecond."""
    return us * F.lit(2) + F.lit(1 if is_query else 0)


def time_us(df: DataFrame, name: str) -> Column:
    """Microseconds of a time column; a bigint column already holds them."""
    if isinstance(df.schema[name].dataType, T.LongType):
        return F.col(name)
    return micros(name)


def asof_splits(
    df: DataFrame, by: Sequence[str], on: str, **kw
) -> Splits:
    """Splits for the as-of join, measured on one side (the larger one is the useful choice)."""
    return measure_splits(df, by, order_position(time_us(df, on), False), **kw)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    left_by: Sequence[str],
    right_by: Sequence[str] | None = None,
    tolerance: timedelta | None = None,
    values: Sequence[str] | None = None,
    tie: Sequence[str] | None = None,
    suffix: str = "_right",
    time_as: str | None = None,
    lag_as: str | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """For each left row, the last right row of the same key at or before its time.

    Every left row is kept. ``values`` that are older than ``tolerance`` become NULL; the
    matched time (``time_as``) and the lag in microseconds (``lag_as``) are reported anyway.
    Times may be timestamps or bigint microseconds. ``tie`` orders right rows of equal time; None means by all values, () declares them unique.

    Plan: one union, one shuffle on (key, part), one running ``last`` per partition. Hot keys
    are cut by ``splits``; the state entering a part comes from a broadcast table of one row
    per part.
    """
    right_by = list(right_by or left_by)
    left_by = list(left_by)
    if values is None:
        values = [c for c in right.columns if c not in right_by and c != right_on]
    names = {v: (v + suffix if v in left.columns else v) for v in values}
    tie = list(values) if tie is None else list(tie)

    keys = [f"__b{i}" for i in range(len(left_by))]
    tick = F.struct(
        time_us(right, right_on).alias("us"),
        *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie)],
        *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)],
    )
    ticks = right.where(F.col(right_on).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(right_by, keys)],
        order_position(time_us(right, right_on), False).alias("__pos"),
        tick.alias("__tick"),
    )
    queries = left.select(
        *[F.col(c).alias(k) for c, k in zip(left_by, keys)],
        order_position(time_us(left, left_on), True).alias("__pos"),
        F.struct(*[F.col(c) for c in left.columns]).alias("__row"),
    )
    both = ticks.unionByName(queries, allowMissingColumns=True)

    part: list[str] = []
    hot = splits is not None and splits.active
    if hot:
        salt = F.hash("__pos", "__tick", "__row")
        both = splits.assign(both, keys, "__pos", spread=salt)
        part = [P1, P2]
    order = [F.col("__pos"), *([F.col("__tick")] if tie else [])]
    running = (
        Window.partitionBy(*keys, *part)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("__m", F.last("__tick", ignorenulls=True).over(running)).where(
        F.col("__row").isNotNull()
    )
    if hot:
        found = _carry_in(found, ticks, keys, splits)

    us_left = F.shiftright(F.col("__pos"), 1)
    fresh = F.lit(True)
    if tolerance is not None:
        fresh = F.col("__m.us") + F.lit(to_us(tolerance)) >= us_left
    out = [F.col(f"__row.`{c}`").alias(c) for c in left.columns]
    out += [F.when(fresh, F.col(f"__m.v{i}")).alias(names[v]) for i, v in enumerate(values)]
    if time_as:
        whole = isinstance(right.schema[right_on].dataType, T.LongType)
        us = F.col("__m.us")
        out.append((us if whole else from_micros(us)).alias(time_as))
    if lag_as:
        out.append((us_left - F.col("__m.us")).alias(lag_as))
    return found.select(*out)


def _carry_in(found: DataFrame, ticks: DataFrame, keys: list[str], splits: Splits) -> DataFrame:
    """Replace a match by the latest tick of earlier parts when that one is later."""
    spark = found.sparkSession
    last = (
        splits.assign(ticks, keys, "__pos", hot_only=True)
        .groupBy(*keys, P1)
        .agg(F.max("__tick").alias("__last"))
    )
    parts = splits.part_table(spark).withColumnRenamed(P1, "__c1")
    pairs = [(f"__k{i}", k) for i, k in enumerate(keys)] + [("__c1", P1)]
    before = (
        Window.partitionBy(*[f"__k{i}" for i in range(len(keys))])
        .orderBy("__c1")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = parts.join(last, null_safe(parts, last, pairs), "left").select(
        *[F.col(f"__k{i}") for i in range(len(keys))],
        "__c1",
        F.max("__last").over(before).alias("__carry"),
    )
    j = found.join(
        F.broadcast(carry),
        null_safe(found, carry, [(k, f"__k{i}") for i, k in enumerate(keys)] + [(P1, "__c1")]),
        "left",
    )
    later = F.col("__carry").isNotNull() & (
        F.col("__m").isNull() | (F.col("__carry") > F.col("__m"))
    )
    return j.withColumn("__m", F.when(later, F.col("__carry")).otherwise(F.col("__m")))
