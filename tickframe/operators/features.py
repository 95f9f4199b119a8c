"""Feature steps with fit and transform, and their application by column-name groups.

A missing feature is NULL or NaN. Fitted statistics are a few numbers per column, kept on the
driver; transforms are Column expressions.
"""

from __future__ import annotations

import json
import math
import re
import warnings
from itertools import groupby
from typing import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tickframe.functions.numbers import LN_EPSILON, clip, drop_nan, log_eps, neg_inf, pos_inf
from tickframe.operators.quantiles import exact_quantiles
from tickframe.operators.splits import null_safe, rank_in
from tickframe.session import scratch_path
from tickframe.sinks.tables import write_table


class Step:
    """One fit / transform step over a set of columns."""

    needs_fit = False
    # True when fitting on a table already does what transforming that table would do
    fit_is_transform = False

    def __init__(self) -> None:
        self.stats: dict[str, dict] = {}
        self.fitted = False

    # -- fitting: scalar aggregates, which several steps can share in one job
    def stat_columns(self, c: str) -> dict[str, Column]:
        return {}

    def check(self, c: str, stats: dict) -> None:
        """Raise when the statistics of a column are unusable."""

    def fit_more(self, df: DataFrame, cols: Sequence[str]) -> None:
        """Fitting that needs its own job."""

    def take(self, cols: Sequence[str], row: dict[tuple[str, str], object]) -> None:
        for c in cols:
            self.stats.setdefault(c, {}).update(
                {k: row[c, k] for k in self.stat_columns(c)}
            )
            self.check(c, self.stats[c])
        self.fitted = True

    def fit(self, df: DataFrame, cols: Sequence[str], refit: bool = False) -> "Step":
        if self.fitted and not refit:
            return self
        if refit:
            self.stats = {}
        fit_together(df, [(self, list(cols))])
        return self

    # -- transforming
    def expr(self, c: str) -> Column:
        return F.col(c)

    def transform(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        if self.needs_fit and not self.fitted:
            raise RuntimeError(f"{type(self).__name__} must be fitted before transform")
        return df.withColumns({c: self.expr(c) for c in cols})

    def fit_transform(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        return self.fit(df, cols).transform(df, cols)

    # -- shared by the steps that need quantiles
    def _quantiles(self, df, cols, probs, method="linear") -> dict[str, list[float | None]]:
        sizes = {c: self.stats[c]["present"] for c in cols}
        return exact_quantiles(df, cols, probs, method, sizes=sizes)


def _present(c: str) -> dict[str, Column]:
    return {"present": F.count(drop_nan(c))}


def fit_together(df: DataFrame, work: list[tuple[Step, list[str]]]) -> None:
    """Fit several steps on one table: all scalar statistics come from one aggregation."""
    labels, exprs = [], []
    for s, (step, cols) in enumerate(work):
        for c in cols:
            for k, e in step.stat_columns(c).items():
                labels.append((s, c, k))
                exprs.append(e.alias(f"a{len(exprs)}"))
    row = df.agg(*exprs).first() if exprs else ()
    for s, (step, cols) in enumerate(work):
        mine = {(c, k): v for (t, c, k), v in zip(labels, row) if t == s}
        step.take(cols, mine)
        step.fit_more(df, cols)


class Identity(Step):
    pass


class FillMissing(Step):
    """NULL and NaN become the lower median of the fitted data, or a constant."""

    def __init__(self, value: float | str = "median") -> None:
        super().__init__()
        self.value = value
        self.needs_fit = value == "median"

    def stat_columns(self, c):
        return _present(c) if self.needs_fit else {}

    def fit_more(self, df, cols):
        if self.value != "median":
            return
        med = self._quantiles(df, cols, [0.5], method="lower")
        for c in cols:
            if med[c][0] is None:
                raise ValueError(f"feature {c} has no value to take a median of")
            self.stats[c]["fill"] = med[c][0]

    def expr(self, c):
        v = F.lit(float(self.stats[c]["fill"] if self.needs_fit else self.value))
        return F.coalesce(F.nanvl(F.col(c).cast("double"), v), v)


class Standardize(Step):
    """(x - mean) / population standard deviation, fitted or given.

    ``by`` fits one pair per group and joins it back; groups beyond the fitted ones give NULL.
    """

    def __init__(
        self, mean: float | None = None, std: float | None = None, skip_missing: bool = True,
        min_std: float = 1e-5, by: Sequence[str] = (),
    ) -> None:
        super().__init__()
        self.mean, self.std, self.skip, self.min_std = mean, std, skip_missing, min_std
        self.by = list(by)
        self.groups: DataFrame | None = None
        self.needs_fit = mean is None or std is None

    def stat_columns(self, c):
        if self.by or not self.needs_fit:
            return {}
        x = drop_nan(c)
        return {
            "mean": F.avg(x), "std": F.stddev_pop(x),
            "missing": F.count_if(x.isNull()),
        }

    def check(self, c, stats):
        if not stats:
            return
        if not self.skip and stats["missing"]:
            raise ValueError(f"feature {c} has {stats['missing']} missing values")
        std = self.std if self.std is not None else stats["std"]
        if std is None or std < self.min_std:
            raise ValueError(f"standard deviation of {c} is {std}, below {self.min_std}")

    def fit_more(self, df, cols):
        if not self.by:
            return
        found = df.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(self.by)]).agg(
            *[F.avg(drop_nan(c)).alias(f"__m_{c}") for c in cols],
            *[F.stddev_pop(drop_nan(c)).alias(f"__d_{c}") for c in cols],
        )
        # Written: a fit must not change with its input, nor be done again by every transform.
        self.groups = write_table(found, scratch_path(df.sparkSession, "group-moments"))
        low = self.groups.agg(
            F.min(F.least(*[F.col(f"__d_{c}") for c in cols], F.lit(math.inf)))
        ).first()[0]
        if low is not None and low < self.min_std:
            raise ValueError(f"a group's standard deviation is {low}, below {self.min_std}")

    def expr(self, c):
        st = self.stats.get(c, {})
        m = self.mean if self.mean is not None else st["mean"]
        d = self.std if self.std is not None else st["std"]
        return (F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(d))

    def transform(self, df, cols):
        if not self.by:
            return super().transform(df, cols)
        if self.groups is None:
            raise RuntimeError("Standardize must be fitted before transform")
        g = self.groups
        j = df.join(g, null_safe(df, g, [(k, f"__g{i}") for i, k in enumerate(self.by)]), "left")
        new = {c: (F.col(c).cast("double") - F.col(f"__m_{c}")) / F.col(f"__d_{c}") for c in cols}
        return j.select(*[new.get(c, F.col(c)).alias(c) for c in df.columns])


class Clip(Step):
    def __init__(self, lo: float | None = None, hi: float | None = None) -> None:
        super().__init__()
        self.lo, self.hi = lo, hi

    def expr(self, c):
        return clip(c, self.lo, self.hi)


class ClipQuantiles(Step):
    """Clip to fitted quantiles (linear interpolation)."""

    needs_fit = True

    def __init__(self, lo: float | None = 0.01, hi: float | None = 0.99) -> None:
        super().__init__()
        self.lo, self.hi = lo, hi

    def stat_columns(self, c):
        return _present(c)

    def fit_more(self, df, cols):
        probs = [p for p in (self.lo, self.hi) if p is not None]
        q = self._quantiles(df, cols, probs)
        for c in cols:
            got = dict(zip(probs, q[c]))
            self.stats[c] = {"lo": got.get(self.lo), "hi": got.get(self.hi)}

    def expr(self, c):
        return clip(c, self.stats[c]["lo"], self.stats[c]["hi"])


class Elementwise(Step):
    """Any Column -> Column function, for example a wrapped pandas UDF."""

    def __init__(self, fn: Callable[[Column], Column]) -> None:
        super().__init__()
        self.fn = fn

    def expr(self, c):
        return self.fn(F.col(c))


class Log(Step):
    def __init__(self, epsilon: float = LN_EPSILON) -> None:
        super().__init__()
        self.epsilon = epsilon

    def expr(self, c):
        return log_eps(c, self.epsilon)


class RaiseNonFinite(Step):
    """Stop with counts when NaN (or NULL) or infinite values are present."""

    fit_is_transform = True

    def __init__(self, on_missing: bool = True, on_inf: bool = True) -> None:
        super().__init__()
        self.on_missing, self.on_inf = on_missing, on_inf

    def stat_columns(self, c):
        x = F.col(c).cast("double")
        return {
            "missing": F.count_if(x.isNull() | F.isnan(x)),
            "pos_inf": F.count_if(pos_inf(x)), "neg_inf": F.count_if(neg_inf(x)),
        }

    def check(self, c, s):
        bad = {
            k: v for k, v in s.items()
            if v and (self.on_missing if k == "missing" else self.on_inf)
        }
        if bad:
            raise ValueError(f"feature {c} has non-finite values: {bad}")

    def transform(self, df, cols):
        fit_together(df, [(RaiseNonFinite(self.on_missing, self.on_inf), list(cols))])
        return df


class QuantileTransform(Step):
    """Map to quantile space with linear interpolation between fitted knots.

    Uniform output lies in [0, 1]; Gaussian output is its normal quantile, kept in [-8, 8].
    ``subsample`` fits on exactly that many rows, chosen by a hash; the default is all rows.
    """

    needs_fit = True
    EDGE = 1e-7
    LIMIT = 8.0

    def __init__(
        self, method: str = "uniform", n_quantiles: int = 1000, output_clip: bool = True,
        subsample: int | None = None, seed: int = 0,
    ) -> None:
        super().__init__()
        if method not in ("uniform", "gaussian"):
            raise ValueError("method must be 'uniform' or 'gaussian'")
        self.method, self.n, self.clip = method, n_quantiles, output_clip
        self.subsample, self.seed = subsample, seed

    def stat_columns(self, c):
        return _present(c)

    def fit_more(self, df, cols):
        probs = [i / (self.n - 1) for i in range(self.n)]
        rows = max(self.stats[c]["present"] for c in cols)
        if self.subsample is not None and rows > self.subsample:
            # exactly so many rows, chosen by their values: any layout gives the same ones
            some = df.select(*cols).orderBy(F.xxhash64(F.lit(self.seed), *cols), *cols).limit(self.subsample)
            q = exact_quantiles(some, cols, probs)
        else:
            q = self._quantiles(df, cols, probs)
        for c in cols:
            self.stats[c] = {"knots": q[c]}

    def transform(self, df, cols):
        """In projections of their own, so that each value is worked out once: the number of knots passed,
        the position between them, and for Gaussian output its normal quantile."""
        if not self.fitted:
            raise RuntimeError("QuantileTransform must be fitted before transform")
        knots = {c: Knots(self.stats[c]["knots"]) for c in cols}
        passed = {c: f"__passed_{i}" for i, c in enumerate(cols)}
        d = df.withColumns({passed[c]: knots[c].passed(F.col(c).cast("double")) for c in cols})
        d = d.withColumns({c: self._present(c, knots[c].position(F.col(c).cast("double"), F.col(passed[c]))) for c in cols})
        if self.method == "gaussian":
            if self.clip:
                d = d.withColumns({c: clip(c, self.EDGE, 1 - self.EDGE) for c in cols})
            d = d.withColumns({c: self._normal(F.col(c)) for c in cols})
        return d.select(*df.columns)

    @staticmethod
    def _present(c: str, value: Column) -> Column:
        x = F.col(c).cast("double")
        return F.when(x.isNotNull() & ~F.isnan(x), value).otherwise(x)

    def _normal(self, u: Column) -> Column:
        from tickframe.functions.numbers import probit

        if self.clip:
            z = clip(probit(u), -self.LIMIT, self.LIMIT)
            return F.when(F.isnan(u), u).otherwise(z)
        return (
            F.when(F.isnan(u), u)
            .when(u <= 0, F.lit(float("-inf"))).when(u >= 1, F.lit(float("inf")))
            .otherwise(probit(u))
        )


class Knots:
    """Position of a value among sorted knots, from 0 at the first to 1 at the last.

    Knots that are equal form one step: a value on it takes the position of the first of them, and
    the line to the next step starts at the last. Outside the knots the position is 0 or 1.
    """

    def __init__(self, knots: Sequence[float]) -> None:
        steps = [(value, [i for i, _ in run]) for value, run in groupby(enumerate(knots), key=lambda k: k[1])]
        self.size = len(steps)
        self.values = _numbers([value for value, _ in steps])
        self.first, self.last = (_numbers([at[k] / (len(knots) - 1) for _, at in steps]) for k in (0, -1))

    def passed(self, x: Column) -> Column:
        """How many steps are at most x."""
        return rank_in(self.values, x, self.size, strict=False)

    def position(self, x: Column, passed: Column) -> Column:
        low, high = F.get(self.values, passed - 1), F.get(self.values, passed)
        begin, end = F.get(self.last, passed - 1), F.get(self.first, passed)
        return (
            F.when(passed == 0, F.lit(0.0))
            .when(low == x, F.get(self.first, passed - 1))
            .when(passed == self.size, F.lit(1.0))
            .otherwise(begin + (x - low) / (high - low) * (end - begin))
        )


def _numbers(values: Sequence[float]) -> Column:
    return F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


class RowStandardize(Step):
    """Standardize each row across its own features, missing ones skipped."""

    def transform(self, df, cols):
        xs = F.filter(F.array(*[drop_nan(c) for c in cols]), lambda v: v.isNotNull())
        return row_moments(df, xs, "__mean", "__std").withColumns(
            {c: (F.col(c).cast("double") - F.col("__mean")) / F.col("__std") for c in cols}
        ).drop("__mean", "__std")


def row_moments(df: DataFrame, values: Column, mean: str, std: str) -> DataFrame:
    """Mean and population standard deviation of an array expression."""
    zero = F.lit(0.0)
    d = df.withColumn("__xs", values).withColumn("__n", F.size("__xs").cast("double"))
    d = d.withColumn(
        mean, F.try_divide(F.aggregate("__xs", zero, lambda a, v: a + v), F.col("__n"))
    )
    dev = F.aggregate("__xs", zero, lambda a, v: a + (v - F.col(mean)) * (v - F.col(mean)))
    d = d.withColumn(std, F.nullif(F.sqrt(F.try_divide(dev, F.col("__n"))), zero))
    return d.drop("__xs", "__n")


class GroupShare(Step):
    """Shape-preserving function over groups: exp(x - max) normalised to sum one per group."""

    def __init__(self, by: Sequence[str]) -> None:
        super().__init__()
        self.by = list(by)

    def transform(self, df, cols):
        """Two small aggregates per group are joined back, so no group is gathered."""
        key = [F.col(k).alias(f"__g{i}") for i, k in enumerate(self.by)]
        pairs = [(k, f"__g{i}") for i, k in enumerate(self.by)]
        top = df.groupBy(*key).agg(*[F.max(drop_nan(c)).alias(f"__t_{c}") for c in cols])
        d = df.join(top, null_safe(df, top, pairs), "left").drop(*[p[1] for p in pairs])
        d = d.withColumns({c: F.exp(drop_nan(c) - F.col(f"__t_{c}")) for c in cols})
        total = d.groupBy(*key).agg(*[F.sum(c).alias(f"__s_{c}") for c in cols])
        d = d.join(total, null_safe(d, total, pairs), "left")
        return d.select(
            *[(F.col(c) / F.col(f"__s_{c}") if c in cols else F.col(c)).alias(c)
              for c in df.columns]
        )


class GroupMap(Step):
    """An opaque function of one group's pandas frame (same rows, same columns).

    The caller vouches that a group fits a task; built-in steps do not use this.
    """

    def __init__(self, by: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame]) -> None:
        super().__init__()
        self.by, self.fn = list(by), fn

    def transform(self, df, cols):
        fn, names = self.fn, list(cols)

        def apply(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.copy()
            pdf[names] = fn(pdf[names])
            return pdf

        return df.groupBy(*self.by).applyInPandas(apply, schema=df.schema)


class FeatureGroups:
    """Steps per group of features; a feature belongs to the first pattern that matches it
    completely. Output columns keep their names and their places."""

    def __init__(self, steps: dict[str, list[Step]], features: Sequence[str]) -> None:
        self.features, self.steps = list(features), steps
        matching = {f: [p for p in steps if re.fullmatch(p, f)] for f in self.features}
        missed = [f for f, patterns in matching.items() if not patterns]
        if missed:
            raise ValueError(f"features without a pattern: {missed}")
        self.owner = {f: patterns[0] for f, patterns in matching.items()}
        self.groups = {p: [f for f in self.features if self.owner[f] == p] for p in steps}
        shared = {f: patterns for f, patterns in matching.items() if len(patterns) > 1}
        if shared:
            warnings.warn(f"features that several patterns match, the first one counts: {shared}")
        runs = [p for p, _ in groupby(self.features, key=self.owner.get)]
        torn = sorted({p for p in runs if runs.count(p) > 1})
        if torn:
            warnings.warn(f"patterns whose features do not stand together: {torn}")

    def fit(self, df: DataFrame, refit: bool = False) -> DataFrame:
        """Fit every step on the output of the steps before it; returns the transformed table.
        Steps at the same depth of all groups share one statistics job."""
        depth = max((len(s) for s in self.steps.values()), default=0)
        for i in range(depth):
            level = [
                (steps[i], self.groups[p])
                for p, steps in self.steps.items()
                if i < len(steps) and self.groups[p]
            ]
            fresh = [(s, c) for s, c in level if refit or not s.fitted]
            fit_together(df, fresh)
            done = {id(s) for s, _ in fresh if s.fit_is_transform}
            for s, c in level:
                if id(s) not in done:
                    df = s.transform(df, c)
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        for p, steps in self.steps.items():
            for s in steps:
                if self.groups[p]:
                    df = s.transform(df, self.groups[p])
        return df

    def match_info(self, spark) -> DataFrame:
        """One row per feature: its place, its pattern and the place of that pattern."""
        places = {p: k for k, p in enumerate(self.steps)}
        return spark.createDataFrame(
            [(f, k, p, places[p]) for k, (f, p) in enumerate(self.owner.items())],
            "feature string, feature_index int, regex_match string, regex_match_index int",
        )
