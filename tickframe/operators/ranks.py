"""Cross-sectional ranks, top-N, nearest row, seeded samples."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickframe.functions.numbers import significant
from tickframe.functions.times import as_col
from tickframe.operators.scans import running_sums
from tickframe.operators.splits import measure_splits, null_safe
from tickframe.session import scratch_path
from tickframe.sinks.tables import write_table


def average_rank_share(value: str, by: Sequence[str]) -> Column:
    """Average rank / number of non-null values within a cross-section; NULL for NULL.

    ``rank`` is the lowest rank of a tie group and the peer-inclusive running count the
    highest, so their mean is the average rank. One window specification serves both.
    """
    w = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
    lowest = F.rank().over(w)
    highest = F.count(value).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.count(value).over(Window.partitionBy(*by))
    share = (lowest + highest).cast("double") / F.lit(2.0) / n.cast("double")
    return F.when(F.col(value).isNotNull(), share)


def rank_columns(
    df: DataFrame, values: Sequence[str], by: Sequence[str], suffix: str = "_q",
    in_task_rows: int | None = None, digits: int | None = None,
) -> DataFrame:
    """Append the rank share of every value.

    ``digits`` ranks values by that many significant digits, so that equal sums stay tied
    whatever order they were added up in.

    A cross-section is sorted in one task. That is safe when its size is bounded (symbols at
    one time); otherwise give ``in_task_rows``: sections are then measured, and if one is
    larger the ranks come from distributed running counts instead.
    """
    if digits is not None:
        keys = {f"__k{i}": significant(v, digits) for i, v in enumerate(values)}
        r = rank_columns(df.withColumns(keys), list(keys), by, suffix, in_task_rows)
        return r.drop(*keys).withColumnsRenamed(
            {k + suffix: v + suffix for k, v in zip(keys, values)}
        )
    if in_task_rows is not None:
        largest = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if largest is not None and largest > in_task_rows:
            return _ranks_by_counts(df, values, by, suffix, in_task_rows)
    return df.select("*", *[average_rank_share(v, by).alias(v + suffix) for v in values])


def _ranks_by_counts(df, values, by, suffix, in_task_rows) -> DataFrame:
    """Ranks out of running value counts: equal values share one row, sections are split."""
    out = df
    for v in values:
        counts = (
            df.where(F.col(v).isNotNull())
            .groupBy(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(by)], F.col(v).alias("__v"))
            .agg(F.count(F.lit(1)).alias("__n"))
        )
        counts = write_table(counts, scratch_path(df.sparkSession, "rank-counts"))
        ks = [f"__b{i}" for i in range(len(by))]
        splits = measure_splits(counts, ks, F.col("__v"), min_rows=in_task_rows)
        cum = running_sums(counts, ks, F.col("__v"), {"__hi": F.col("__n")}, splits=splits)
        total = counts.groupBy(*[F.col(k).alias(f"{k}t") for k in ks]).agg(F.sum("__n").alias("__all"))
        cum = cum.join(total, null_safe(cum, total, [(k, f"{k}t") for k in ks]))
        share = (2 * F.col("__hi") - F.col("__n") + 1).cast("double") / 2.0 / F.col("__all")
        r = cum.select(*ks, "__v", share.alias(v + suffix))
        on = null_safe(out, r, list(zip(by, ks))) & (out[v] == r["__v"])
        out = out.join(r, on, "left").drop(*ks, "__v")
    return out


def top_n(
    df: DataFrame,
    volume: str,
    n: int,
    tie: Sequence[str] = (),
    minimum: float | None = None,
    active: Column | None = None,
) -> DataFrame:
    """Largest ``n`` by volume among active rows with positive (or at least ``minimum``)
    volume. Runs as take-ordered: each task keeps n rows."""
    v = F.col(volume)
    d = df.where(v >= F.lit(minimum)) if minimum is not None else df.where(v > 0)
    if active is not None:
        d = d.where(active)
    return d.orderBy(v.desc(), *tie).limit(n)


def nearest(
    df: DataFrame, value: str | Column, targets: Sequence[float], keep: Sequence[str],
    tie: Sequence[str] = (),
) -> DataFrame:
    """For each target the row whose value is closest; ties go to the smaller value, then tie.

    One aggregation for all targets: the number of targets is fixed and small.
    """
    x = as_col(value).cast("double")
    row = F.struct(*[F.col(c) for c in keep])
    aggs = [
        F.min_by(
            row, F.struct(F.abs(x - F.lit(float(t))), x, *[F.col(c) for c in tie])
        ).alias(f"r{i}")
        for i, t in enumerate(targets)
    ]
    one = df.where(x.isNotNull() & ~F.isnan(x)).agg(*aggs)
    items = F.array(
        *[
            F.struct(F.lit(i).alias("target_no"), F.lit(float(t)).alias("target"),
                     F.col(f"r{i}").alias("row"))
            for i, t in enumerate(targets)
        ]
    )
    return one.select(F.inline(items)).select("target_no", "target", "row.*")


def seeded_sample(
    df: DataFrame, at_most: int, seed: int, key: Sequence[str], order: Sequence[str] = (),
) -> DataFrame:
    """Exactly ``at_most`` rows (all, if there are fewer), optionally put back in order.

    Rows are taken by the MD5 of their key and the seed, so the choice depends neither on the
    layout of the files nor on the number of tasks; each task keeps ``at_most`` rows.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    s = df.orderBy(F.md5(F.concat(text, F.lit(f"|{seed}"))), *key).limit(at_most)
    return s.orderBy(*order) if order else s


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last n rows in order, returned in ascending order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)
