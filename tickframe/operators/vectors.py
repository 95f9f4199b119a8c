"""Feature steps on one ``array<double>`` column: no column per component."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickframe.functions.numbers import drop_nan


def _clean(values: Column) -> Column:
    return F.transform(values.cast("array<double>"), drop_nan)


def row_standardized(vector: str | Column) -> Column:
    """Each vector standardised by the mean and population deviation of its own components.

    Missing ones (NULL, NaN) are skipped and become NULL; a vector without spread gives NULLs, and
    a NULL vector NULL.
    """
    x = _clean(F.col(vector) if isinstance(vector, str) else vector)
    # Sums travel inside one pass over the components; the second pass takes deviations.
    sums = F.aggregate(
        x, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("n")),
        lambda a, v: F.struct((a["s"] + F.coalesce(v, F.lit(0.0))).alias("s"), (a["n"] + F.when(v.isNull(), 0.0).otherwise(1.0)).alias("n")),
        lambda a: F.struct(F.try_divide(a["s"], a["n"]).alias("mean"), a["n"].alias("n")),
    )
    spread = lambda m: F.nullif(F.sqrt(F.try_divide(
        F.aggregate(x, F.lit(0.0), lambda a, v: a + F.coalesce((v - m["mean"]) * (v - m["mean"]), F.lit(0.0))), m["n"]
    )), F.lit(0.0))
    # One-element arrays hold the moments, so that they are worked out once for all components.
    moments = F.transform(F.array(sums), lambda m: F.struct(m["mean"].alias("mean"), spread(m).alias("std")))
    return F.flatten(F.transform(moments, lambda m: F.transform(x, lambda v: (v - m["mean"]) / m["std"])))


class VectorStandardize:
    """(x - mean) / population deviation by position, over all vectors of the table.

    Statistics are one partially aggregated row per position; as many numbers as a vector has
    components are kept. Missing components are skipped and become NULL, as do positions beyond the
    fitted ones; vectors may differ in length.
    """

    def __init__(self, min_std: float = 1e-5):
        self.min_std = min_std
        self.means: list[float | None] = []
        self.stds: list[float | None] = []

    def fit(self, df: DataFrame, vector: str) -> VectorStandardize:
        at = df.select(F.posexplode(F.col(vector).cast("array<double>")).alias("at", "v"))
        stats = at.groupBy("at").agg(F.avg(drop_nan("v")).alias("mean"), F.stddev_pop(drop_nan("v")).alias("std"))
        found = {r["at"]: (r["mean"], r["std"]) for r in stats.collect()}  # one row per position
        bad = sorted(k for k, (_, s) in found.items() if s is None or s < self.min_std)
        if bad:
            raise ValueError(f"standard deviation at positions {bad[:10]} is below {self.min_std}")
        self.means = [found[k][0] for k in range(len(found))]
        self.stds = [found[k][1] for k in range(len(found))]
        return self

    def transform(self, vector: str | Column) -> Column:
        x = _clean(F.col(vector) if isinstance(vector, str) else vector)
        means, stds = (F.array(*[F.lit(v) for v in values]).cast("array<double>") for values in (self.means, self.stds))
        return F.transform(x, lambda v, i: (v - F.get(means, i)) / F.get(stds, i))
