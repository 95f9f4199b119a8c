"""Rolling time aggregates per key over [t - period, t).

Measures that are functions of sums are computed from running sums: the sum over the window is
the running sum before ``t`` minus the running sum before ``t - period``. Both are growing
RANGE frames of one window specification, so all measures and all lookbacks cost one shuffle
and one sort, and each frame is linear in the rows. ``rolling_frame`` takes any aggregate and
pays rows times frame length.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickframe.functions.numbers import ratio
from tickframe.functions.times import from_micros, micros, to_us
from tickframe.operators.asof import asof_join
from tickframe.operators.scans import running_sums
from tickframe.operators.splits import Splits, null_safe


@dataclass(frozen=True)
class Measure:
    """``parts`` are per-row values whose windowed sums feed ``finish``.

    ``centre`` names a column that is shifted by its key mean before use, which keeps sums of
    squares well conditioned; its shifted value is offered to ``parts`` as an argument.
    """

    parts: Callable[[Callable[[str], Column]], list[Column]]
    finish: Callable[[list[Column]], Column]
    centre: str | None = None


def total(value: Column) -> Measure:
    return Measure(lambda _: [value], lambda s: s[0])


def root_total(value: Column) -> Measure:
    return Measure(lambda _: [value], lambda s: F.sqrt(s[0]))


def total_ratio(num: Column, den: Column) -> Measure:
    return Measure(lambda _: [num, den], lambda s: ratio(s[0], s[1]))


def filled(name: str) -> Measure:
    """Number of non-null values."""
    return Measure(lambda _: [F.when(F.col(name).isNotNull(), 1).otherwise(0)], lambda s: s[0])


def mean(name: str, scale: float = 1.0) -> Measure:
    n = F.when(F.col(name).isNotNull(), 1).otherwise(0)
    return Measure(
        lambda _: [F.col(name), n], lambda s: ratio(s[0], s[1]) * F.lit(float(scale))
    )


def sample_std(name: str, scale: float = 1.0) -> Measure:
    """Sample standard deviation (n - 1), NULL below two values."""
    n = F.when(F.col(name).isNotNull(), 1).otherwise(0)

    def finish(s: list[Column]) -> Column:
        dev, sq, k = s
        var = (sq - ratio(dev * dev, k)) / (k - 1)
        return F.when(k >= 2, F.sqrt(F.greatest(var, F.lit(0.0))) * F.lit(float(scale)))

    return Measure(lambda c: [c(name), c(name) * c(name), n], finish, centre=name)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    measures: dict[timedelta, dict[str, Measure]],
    splits: Splits | None = None,
) -> DataFrame:
    """Append every measure of every lookback to every row."""
    d = df.withColumn("__us", micros(time))
    flat = [(p, n, m) for p, by_name in measures.items() for n, m in by_name.items()]
    centres = list(dict.fromkeys(m.centre for _, _, m in flat if m.centre))
    if centres:
        if splits is not None and splits.active:
            means = d.groupBy(*[F.col(k).alias(f"__m{i}") for i, k in enumerate(keys)]).agg(
                *[F.avg(c).alias(f"__c{i}") for i, c in enumerate(centres)]
            )
            pairs = [(k, f"__m{i}") for i, k in enumerate(keys)]
            d = d.join(means, null_safe(d, means, pairs), "left").drop(*[m for _, m in pairs])
        else:
            whole = Window.partitionBy(*keys)
            d = d.withColumns(
                {f"__c{i}": F.avg(c).over(whole) for i, c in enumerate(centres)}
            )

    def centred(name: str) -> Column:
        return F.col(name) - F.col(f"__c{centres.index(name)}")

    part_cols: dict[str, Column] = {}
    used: list[tuple[timedelta, str, Measure, list[str]]] = []
    for p, name, m in flat:
        ids = []
        for c in m.parts(centred):
            # identical expressions are summed once
            text = str(c)
            pid = next((k for k, v in part_cols.items() if str(v) == text), None)
            if pid is None:
                pid = f"__x{len(part_cols)}"
                part_cols[pid] = c
            ids.append(pid)
        used.append((p, name, m, ids))
    d = d.withColumns({k: F.coalesce(c, F.lit(0)) for k, c in part_cols.items()})

    periods = list(measures)
    need = {(p, i) for p, _, _, ids in used for i in ids}
    if splits is not None and splits.active:
        d = _sums_split(d, keys, time, list(part_cols), periods, splits)
    else:
        by_time = Window.partitionBy(*keys).orderBy("__us")

        def upto(end: int) -> object:
            return by_time.rangeBetween(Window.unboundedPreceding, end)

        cols = {
            f"__n{i}": F.coalesce(F.sum(i).over(upto(-1)), F.lit(0)) for i in part_cols
        }
        for k, p in enumerate(periods):
            for i in part_cols:
                if (p, i) in need:
                    cols[f"__o{k}{i}"] = F.coalesce(
                        F.sum(i).over(upto(-to_us(p) - 1)), F.lit(0)
                    )
        d = d.select("*", *[c.alias(n) for n, c in cols.items()])
    out = []
    for p, name, m, ids in used:
        k = periods.index(p)
        out.append(m.finish([F.col(f"__n{i}") - F.col(f"__o{k}{i}") for i in ids]).alias(name))
    return d.select(*df.columns, *out)


def _sums_split(d, keys, time, parts, periods, splits) -> DataFrame:
    """Running sums across the parts of hot keys, looked up by as-of joins."""
    # one row per (key, time) first, so equal times need no order
    ends = running_sums(
        d.groupBy(*keys, "__us").agg(*[F.sum(i).alias(i) for i in parts]),
        keys,
        F.col("__us") * 2,
        {f"__r{i}": F.col(i) for i in parts},
        splits=splits,
    )
    ticks = ends.select(*keys, F.col("__us").alias("__tt"), *[f"__r{i}" for i in parts])
    out = d
    for tag, back in [("__n", 1)] + [(f"__o{k}", to_us(p) + 1) for k, p in enumerate(periods)]:
        q = out.withColumn("__qt", F.col("__us") - F.lit(back))
        out = asof_join(
            q, ticks.select(*keys, "__tt", *[F.col(f"__r{i}").alias(f"{tag}{i}") for i in parts]),
            "__qt", "__tt", keys, tie=(), splits=splits,
        ).drop("__qt")
        out = out.withColumns({f"{tag}{i}": F.coalesce(f"{tag}{i}", F.lit(0)) for i in parts})
    return out


def rolling_frame(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    aggregates: dict[timedelta, dict[str, Callable[[object], Column]]],
    slice_by: timedelta | None = None,
) -> DataFrame:
    """The same window for arbitrary aggregates: each entry maps a window to a Column.

    ``slice_by`` (at least the longest period) cuts long keys by time: each row also goes to
    the next slice as context, so a slice holds all rows its own rows look back to.
    """
    longest = max(to_us(p) for p in aggregates)
    d = df.withColumn("__us", micros(time))
    cut: list[str] = []
    if slice_by is not None:
        width = to_us(slice_by)
        if width < longest:
            raise ValueError("slice_by must not be shorter than the longest period")
        own = F.floor(F.col("__us") / F.lit(width))
        d = d.withColumn("__own", own).withColumn(
            "__slice", F.explode(F.array(F.col("__own"), F.col("__own") + 1))
        )
        cut = ["__slice"]
    w = Window.partitionBy(*keys, *cut).orderBy("__us")
    cols = [
        fn(w.rangeBetween(-to_us(p), -1)).alias(name)
        for p, by_name in aggregates.items()
        for name, fn in by_name.items()
    ]
    r = d.select("*", *cols)
    if cut:
        r = r.where(F.col("__slice") == F.col("__own"))
    return r.drop("__us", "__own", "__slice")


def last_per_interval(
    df: DataFrame, keys: Sequence[str], time: str, every: timedelta, out: str,
) -> DataFrame:
    """Last row of each (key, interval), labelled with the interval's end.

    Among rows of one time the largest one counts, column by column, so the result does not
    depend on the order of the input. One aggregation with a map-side part: no task sees a key.
    """
    every_us = F.lit(to_us(every))
    d = df.withColumn("__us", micros(time))
    d = d.withColumn("__g", F.col("__us") - F.pmod(F.col("__us"), every_us))
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    last = F.max_by(row, F.struct(F.col("__us"), row)).alias("__r")
    d = d.groupBy(*keys, "__g").agg(last).select(
        *[F.col(c) if c in keys else F.col(f"__r.`{c}`").alias(c) for c in df.columns], "__g"
    )
    return d.withColumn(out, from_micros(F.col("__g") + every_us)).select(*df.columns, out)
