"""Dependence curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import LOT_ID, query, table
from tickframe.operators.curves import CurveStore, category_bars, curve_ticks, dependence_curve
from tickframe.session import scratch_path

TIE = "((CAST(l_orderkey AS HUGEINT) * 10 + l_linenumber) * 10000000 + l_partkey) * 10000000 + l_suppkey"
CURVE_SQL = f"""c AS (
  SELECT l_extendedprice, l_quantity, l_discount, {TIE} AS tie,
    sum(l_quantity) OVER w / sum(l_quantity) OVER () AS weight_norm,
    sum(l_discount) OVER w AS l_discount_cumsum
  FROM lineitem WINDOW w AS (ORDER BY l_extendedprice, {TIE} ROWS UNBOUNDED PRECEDING))"""


def _input(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_extendedprice", "l_quantity", "l_discount", F.expr(LOT_ID).alias("tie")
    )


@query(
    "curve_dependence",
    f"""WITH {CURVE_SQL} SELECT l_extendedprice, l_quantity, l_discount, CAST(tie AS VARCHAR) AS tie,
  round(weight_norm, 6) AS weight_norm, round(l_discount_cumsum, 6) AS l_discount_cumsum FROM c""",
)
def curve_dependence(spark, sf):
    return dependence_curve(
        _input(spark, sf), "l_extendedprice", ["l_discount"], "l_quantity", "tie"
    ).withColumn("tie", F.col("tie").cast("string"))


@query(
    "curve_ticks",
    f"""WITH {CURVE_SQL}, r AS (SELECT l_extendedprice AS x,
    row_number() OVER (ORDER BY l_extendedprice) - 1 AS i, count(*) OVER () AS n FROM lineitem),
q AS (SELECT t AS tick, t / 4.0::DOUBLE AS prob FROM (SELECT unnest(range(5)) AS t)),
v AS (SELECT q.tick, q.prob, r.x FROM q JOIN r ON r.i = floor(q.prob * (r.n - 1) + 0.5)),
h AS (SELECT v.tick, v.prob, v.x AS l_extendedprice, min(c.weight_norm) AS position
      FROM v JOIN c ON c.l_extendedprice = v.x GROUP BY 1, 2, 3)
SELECT CAST(tick AS INTEGER) AS tick, prob, round(position, 6) AS position, l_extendedprice,
  printf('%.2f', l_extendedprice) AS label FROM h""",
)
def ticks_of_curve(spark, sf):
    d = _input(spark, sf)
    c = dependence_curve(d, "l_extendedprice", ["l_discount"], "l_quantity", "tie")
    return curve_ticks(d, c, "l_extendedprice", 5, "tie")


@query(
    "curve_categorical",
    """SELECT l_returnflag, count(*) AS n_rows, sum(l_quantity) AS weight,
  round(sum(l_discount), 4) AS l_discount_sum FROM lineitem GROUP BY l_returnflag""",
    digits=4,
)
def curve_categorical(spark, sf):
    return category_bars(table(spark, sf, "lineitem"), "l_returnflag", ["l_discount"], "l_quantity")


@query(
    "curve_expressions",
    """WITH b AS (SELECT floor(l_extendedprice / 1000) AS price_class, sum(l_quantity) AS w,
  sum(round(l_discount * l_quantity, 4)) AS cost, sum(l_tax) AS l_tax FROM lineitem GROUP BY 1)
SELECT price_class, round(sum(w) OVER o / sum(w) OVER (), 6) AS weight_norm,
  round(sum(cost) OVER o, 4) AS cost_cumsum, round(sum(l_tax) OVER o, 4) AS l_tax_cumsum
FROM b WINDOW o AS (ORDER BY price_class ROWS UNBOUNDED PRECEDING)""",
    digits=None,
)
def curve_expressions(spark, sf):
    """Features and sums given as expressions, names or a mix; the curve at the end of each class."""
    store = CurveStore.create(
        table(spark, sf, "lineitem"), scratch_path(spark, "expressions"),
        [F.round(F.col("l_discount") * F.col("l_quantity"), 4).alias("cost"), "l_tax"],
        F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("price_class"), "l_quantity",
    )
    curve, _ = store.curves()["price_class"]
    at_end = curve.groupBy("price_class").agg(*[F.max(c).alias(c) for c in ("weight_norm", "cost_cumsum", "l_tax_cumsum")])
    return at_end.select("price_class", *[F.round(c, n).alias(c) for c, n in (("weight_norm", 6), ("cost_cumsum", 4), ("l_tax_cumsum", 4))])
