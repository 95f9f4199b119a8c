"""Equi-depth splits of hot keys.

Ordered work (as-of joins, running sums, forward fill) is a window per key. When one key holds
a large share of the rows its window would be one task. A ``Splits`` value cuts such keys into
consecutive parts of about equal size. Windows then run per (key, part) and a small table of
one row per part carries the state from earlier parts in.

Any set of bounds gives the same results; the bounds only decide balance. So one ``Splits`` may
be measured once on the raw table and reused by every later operator on the same key and order.

Size: a key is hot when it holds more than ``max(min_rows, total / max_parts)`` rows, so at most
``max_parts`` keys are hot and they get at most ``2 * max_parts`` bounds together. That is the
proof that the bounds may live on the driver and be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

MIN_ROWS = 4_000_000
MAX_PARTS = 4096

P1, P2 = "__p1", "__p2"


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def rank_in(bounds: Column, v: Column, n_max: int, strict: bool) -> Column:
    """How many sorted bounds are < v (strict) or <= v, by binary search."""
    steps = [1 << k for k in reversed(range(max(1, n_max.bit_length())))]

    def step(acc: Column, s: Column) -> Column:
        b = F.get(bounds, acc + s - 1)
        hit = (b < v) if strict else (b <= v)
        return F.when(hit, acc + s).otherwise(acc)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


@dataclass(frozen=True)
class Splits:
    """Bounds per hot key; ``ties`` holds second-level bounds inside heavy single values."""

    keys: tuple[str, ...]
    key_types: tuple[T.DataType, ...] = ()
    pos_type: T.DataType = field(default_factory=T.LongType)
    rows: tuple[tuple[tuple, tuple], ...] = ()
    ties: "Splits | None" = None

    @property
    def active(self) -> bool:
        return bool(self.rows)

    @property
    def longest(self) -> int:
        return max((len(b) for _, b in self.rows), default=0)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per hot key: the key columns ``__k0..`` and ``__bounds``."""
        schema = T.StructType(
            [T.StructField(f"__k{i}", t) for i, t in enumerate(self.key_types)]
            + [T.StructField("__bounds", T.ArrayType(self.pos_type))]
        )
        return spark.createDataFrame([(*k, list(b)) for k, b in self.rows], schema)

    def part_table(self, spark: SparkSession) -> DataFrame:
        """Every first-level part of every hot key (at most 2 * bounds + 1 per key)."""
        return self.table(spark).select(
            *[F.col(f"__k{i}") for i in range(len(self.keys))],
            F.explode(F.sequence(F.lit(0), 2 * F.size("__bounds"))).alias(P1),
        )

    def assign(
        self,
        df: DataFrame,
        keys: Sequence[str],
        pos: str,
        spread: Column | None = None,
        tie: str | None = None,
        hot_only: bool = False,
    ) -> DataFrame:
        """Add part columns. A value equal to a bound gets its own (odd) first-level part.

        Inside a heavy value, one that fills several quantiles, the second level follows the
        tie column when second-level bounds exist (order kept), else ``spread`` (order free).
        """
        if keys:
            t = self.table(df.sparkSession)
            pairs = [(k, f"__k{i}") for i, k in enumerate(keys)]
            j = df.join(
                F.broadcast(t), null_safe(df, t, pairs), "inner" if hot_only else "left"
            )
            b = F.col("__bounds")
        else:
            j = df
            b = F.array(*[F.lit(x) for x in self.rows[0][1]]).cast(T.ArrayType(self.pos_type))
        v = F.col(pos)
        j = j.withColumn("__le", rank_in(b, v, self.longest, strict=False))
        j = j.withColumn(
            "__lt",
            F.when(
                F.get(b, F.col("__le") - 1) == v, rank_in(b, v, self.longest, strict=True)
            ).otherwise(F.col("__le")),
        )
        mult = F.col("__le") - F.col("__lt")
        p1 = F.when(b.isNull(), F.lit(0)).otherwise(
            2 * F.col("__lt") + F.when(mult > 0, 1).otherwise(0)
        )
        p2 = F.lit(0)
        if spread is not None:
            p2 = F.when(mult >= 2, F.pmod(spread, F.greatest(mult, F.lit(1)))).otherwise(0)
        out = j.withColumn(P1, p1.cast("int")).withColumn(P2, p2.cast("int"))
        out = out.drop("__bounds", "__le", "__lt", *[f"__k{i}" for i in range(len(keys))])
        if tie is not None and self.ties is not None and self.ties.active:
            inner = self.ties.assign(
                out.withColumnRenamed(P1, "__q1").drop(P2), [*keys, pos], tie
            )
            out = inner.drop(P2).withColumnRenamed(P1, P2).withColumnRenamed("__q1", P1)
        return out


def measure_splits(
    df: DataFrame,
    keys: Sequence[str],
    pos: Column,
    tie: Column | None = None,
    min_rows: int = MIN_ROWS,
    max_parts: int = MAX_PARTS,
) -> Splits:
    """Find hot keys and their equi-depth bounds; no hot key means no further job."""
    slim = df.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        pos.alias("__pos"),
        *([tie.alias("__tie")] if tie is not None else []),
    )
    ks = [f"__k{i}" for i in range(len(keys))]
    key_types = tuple(slim.schema[k].dataType for k in ks)
    pos_type = slim.schema["__pos"].dataType
    none = Splits(tuple(keys), key_types, pos_type)
    if tie is None:
        return _level(slim, ks, key_types, "__pos", none, min_rows, max_parts)
    first = _level(slim, ks, key_types, "__pos", none, min_rows, max_parts)
    heavy = [
        (*k, v) for k, b in first.rows for v, w in zip(b, b[1:]) if v == w
    ]
    heavy = list(dict.fromkeys(heavy))
    if not heavy:
        return first
    schema = T.StructType(
        [T.StructField(f"__h{i}", t) for i, t in enumerate((*key_types, pos_type))]
    )
    h = df.sparkSession.createDataFrame(heavy, schema)
    cols = [*ks, "__pos"]
    rows = slim.join(
        F.broadcast(h), null_safe(slim, h, [(c, f"__h{i}") for i, c in enumerate(cols)]),
        "left_semi",
    )
    tie_none = Splits((*keys, "pos"), (*key_types, pos_type), slim.schema["__tie"].dataType)
    second = _level(rows, cols, (*key_types, pos_type), "__tie", tie_none, min_rows, max_parts)
    return Splits(first.keys, key_types, pos_type, first.rows, second)


def _level(slim, ks, key_types, pos, none: Splits, min_rows: int, max_parts: int) -> Splits:
    counts = slim.groupBy(*ks).agg(F.count(F.lit(1)).alias("__n"))
    total, top = counts.agg(F.sum("__n"), F.max("__n")).first()
    if not total or top <= min_rows:
        return none
    size = max(min_rows, -(-total // max_parts))
    hot_rows = counts.where(F.col("__n") > size).collect()
    if not hot_rows:
        return none
    m_max = max(-(-r["__n"] // size) for r in hot_rows)
    schema = T.StructType(
        [T.StructField(f"__h{i}", t) for i, t in enumerate(key_types)]
        + [T.StructField("__m", T.IntegerType())]
    )
    hot = slim.sparkSession.createDataFrame(
        [(*r[: len(ks)], int(-(-r["__n"] // size))) for r in hot_rows], schema
    )
    hs = [f"__h{i}" for i in range(len(ks))]
    probs = [i / m_max for i in range(1, m_max)]
    sketch = (
        slim.join(F.broadcast(hot), null_safe(slim, hot, list(zip(ks, hs))))
        .where(F.col(pos).isNotNull())
        .groupBy(*hs, "__m")
        .agg(F.percentile_approx(pos, probs, max(10_000, 4 * m_max)).alias("__q"))
    )
    thin = F.transform(
        F.sequence(F.lit(1), F.col("__m") - 1),
        lambda i: F.get("__q", (i * m_max / F.col("__m")).cast("int") - 1),
    )
    got = sketch.select(*hs, thin.alias("__b")).collect()
    rows = tuple(
        (tuple(r[: len(ks)]), tuple(sorted(x for x in r["__b"] if x is not None))) for r in got
    )
    return Splits(none.keys, key_types, none.pos_type, tuple(r for r in rows if r[1]))
