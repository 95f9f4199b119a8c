"""Cumulative dependence curves: sort by a feature, accumulate, spread along a weight axis."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickframe.functions.text import label, label_kind
from tickframe.operators.quantiles import IN_TASK_ROWS, exact_quantiles
from tickframe.operators.scans import running_sums
from tickframe.operators.splits import measure_splits
from tickframe.operators.tables import Ranges, as_columns
from tickframe.sinks.files import exists, read_text, remove, write_text
from tickframe.sinks.tables import write_table


def _numeric(df: DataFrame, name: str) -> Column:
    kind = label_kind(df, name)
    if kind == "timestamp":
        return F.unix_micros(F.col(name).cast("timestamp"))
    if kind == "date":
        return F.unix_date(name)
    if kind == "duration":
        from tickframe.functions.times import interval_us

        return interval_us(name)
    return F.col(name)


def dependence_curve(
    df: DataFrame, feature: str, accum: Sequence[str], weight: str, tie: str | None = None,
    rows_per_part: int = IN_TASK_ROWS,
) -> DataFrame:
    """Per row in feature order: the running share of weight and the running sums.

    The global order is cut into parts by measured feature bounds (and tie bounds inside a
    heavy feature value), so no single task sees all rows.
    """
    keep = list(dict.fromkeys([feature, weight, *accum, *([tie] if tie else [])]))
    d = df.select(*keep)
    pos = _numeric(d, feature)
    tie_col = F.col(tie) if tie else None
    total = d.agg(F.sum(F.col(weight).cast("double"))).first()[0]
    splits = measure_splits(d, [], pos, tie_col, min_rows=rows_per_part)
    sums = {"__w": F.col(weight).cast("double")}
    sums.update({f"{a}_cumsum": F.col(a).cast("double") for a in accum})
    r = running_sums(d, [], pos, sums, tie_col, splits)
    share = F.try_divide(F.col("__w"), F.lit(total).cast("double"))
    return r.withColumn("weight_norm", share).drop("__w")


def curve_ticks(
    df: DataFrame, curve: DataFrame, feature: str, n_ticks: int = 5, tie: str | None = None,
    format_fn: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Axis ticks at evenly spaced quantiles of the feature (nearest rank): position and label.

    A nearest-rank quantile is a value of the data, so the nearest row is the first one that
    holds it.
    """
    probs = [i / (n_ticks - 1) for i in range(n_ticks)]
    d = df.select(_numeric(df, feature).cast("double").alias("x"))
    values = exact_quantiles(d, ["x"], probs, method="nearest")["x"]
    spark = df.sparkSession
    want = spark.createDataFrame(
        [(i, p, v) for i, (p, v) in enumerate(zip(probs, values)) if v is not None],
        "tick int, prob double, value double",
    )
    first = F.struct("weight_norm", F.col(feature))
    order = F.struct("weight_norm", F.col(tie)) if tie else F.col("weight_norm")
    hits = (
        curve.withColumn("__x", _numeric(curve, feature).cast("double"))
        .where(F.col("__x").isin([v for v in values if v is not None]))  # reaches a stored curve's row groups
        .join(F.broadcast(want), F.col("__x") == F.col("value"))
        .groupBy("tick", "prob")
        .agg(F.min_by(first, order).alias("r"))
        .select("tick", "prob", F.col("r.weight_norm").alias("position"),
                F.col(f"r.`{feature}`").alias(feature))
    )
    text = format_fn(F.col(feature)) if format_fn else label(feature, label_kind(df, feature))
    return hits.withColumn("label", text)


def category_bars(
    df: DataFrame, category: str, accum: Sequence[str], weight: str
) -> DataFrame:
    """The categorical form: sums per category instead of a curve."""
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(weight).alias("weight"),
        *[F.sum(a).alias(f"{a}_sum") for a in accum],
    )


@dataclass
class CurveOptions:
    accum: list[str]
    features: list[str]
    weight: str
    n_ticks: int = 5
    num_cols: int = 2
    ranges: dict[str, list] = field(default_factory=dict)


class CurveStore:
    """A stored selection of evaluated columns with its filters and settings."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.options = CurveOptions(**json.loads(read_text(spark, f"{self.path}/options")))
        self.ranges = Ranges({k: tuple(v) for k, v in self.options.ranges.items()})

    @classmethod
    def create(
        cls, df: DataFrame, path: str, accum, features, weight, n_ticks: int = 5,
        num_cols: int = 2,
    ) -> "CurveStore":
        """Evaluate the expressions once and write them. Nothing is left behind on error."""
        spark = df.sparkSession
        parts = [df.select(*as_columns(x)).columns for x in (accum, features, weight)]
        names = [n for p in parts for n in p]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"column names used more than once: {twice}")
        if len(parts[2]) != 1:
            raise ValueError("exactly one weight is needed")
        if exists(spark, path):
            raise FileExistsError(path)
        try:
            cols = [c for x in (accum, features, weight) for c in as_columns(x)]
            df.select(*cols).write.parquet(f"{path}/data")
            options = CurveOptions(parts[0], parts[1], parts[2][0], n_ticks, num_cols)
            write_text(spark, f"{path}/options", json.dumps(asdict(options)))
        except Exception:
            remove(spark, path)
            raise
        return cls(spark, path)

    def delete(self) -> None:
        remove(self.spark, self.path)

    def data(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data")

    def save(self) -> None:
        self.options.ranges = {k: list(v) for k, v in self.ranges.bounds.items()}
        write_text(self.spark, f"{self.path}/options", json.dumps(asdict(self.options)))

    def reload(self) -> None:
        self.__init__(self.spark, self.path)

    def set_range(self, name: str, lo, hi) -> None:
        self.ranges = self.ranges.with_range(name, lo, hi)
        self.save()

    def drop_range(self, name: str) -> None:
        self.ranges = self.ranges.without(name)
        self.save()

    def set_view(self, n_ticks: int | None = None, num_cols: int | None = None) -> None:
        self.options.n_ticks = n_ticks or self.options.n_ticks
        self.options.num_cols = num_cols or self.options.num_cols
        self.save()

    def filtered(self) -> DataFrame:
        return self.ranges.apply(self.data())

    def curves(self, tie: str | None = None) -> dict[str, tuple[DataFrame, DataFrame]]:
        """Per feature: (curve, ticks) over the filtered selection.

        A curve is written once, in the order of its feature, and is there for as long as the
        ranges stay; the selection is scanned once per feature, and ticks read only the row groups
        of the curve that hold their values.
        """
        o, out = self.options, {}
        version = hashlib.sha256(json.dumps([sorted(o.ranges.items()), tie], default=str).encode()).hexdigest()[:16]
        for f in o.features:
            path = f"{self.path}/curves/{version}/{hashlib.sha256(f.encode()).hexdigest()[:16]}"
            if not exists(self.spark, f"{path}/_SUCCESS"):
                made = dependence_curve(self.filtered(), f, o.accum, o.weight, tie)
                write_table(made.sortWithinPartitions(f), path)
            c = self.spark.read.parquet(path)
            out[f] = (c, curve_ticks(c, c, f, o.n_ticks, tie))
        return out

    def drop_curves(self) -> None:
        """Remove the written curves; whoever reads them must be done."""
        remove(self.spark, f"{self.path}/curves")
