"""Feature steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table
from tickframe.operators.features import (
    Clip, ClipQuantiles, Elementwise, FeatureGroups, FillMissing, GroupShare, Identity, Log,
    QuantileTransform, RaiseNonFinite, RowStandardize, Standardize,
)
from tickframe.operators.vectors import VectorStandardize, row_standardized

ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
IDS = ID.split(", ")
# Every fifth line has a missing discount.
GAPS_SQL = f"""g AS (SELECT {ID}, l_returnflag, l_quantity, l_extendedprice,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount END AS l_discount FROM lineitem)"""


def _gaps(spark, sf):
    nan = F.when(F.col("l_partkey") % 2 == 0, F.lit(float("nan")))
    return table(spark, sf, "lineitem").select(
        *IDS, "l_returnflag", "l_quantity", "l_extendedprice",
        F.when(F.col("l_linenumber") == 5, nan).otherwise(F.col("l_discount")).alias("l_discount"),
    )


@query(
    "feat_fill",
    f"""WITH {GAPS_SQL} SELECT {ID}, round(coalesce(l_discount,
  (SELECT quantile_disc(l_discount, 0.5) FROM g)), 6) AS l_discount FROM g""",
)
def feat_fill(spark, sf):
    d = _gaps(spark, sf).select(*IDS, "l_discount")
    return FillMissing().fit_transform(d, ["l_discount"])


@query(
    "feat_std",
    f"""WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS dq,
  avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS dp FROM lineitem)
SELECT {ID}, round((l_quantity - mq) / dq, 6) AS l_quantity,
  round((l_extendedprice - mp) / dp, 6) AS l_extendedprice FROM lineitem, s""",
)
def feat_std(spark, sf):
    d = table(spark, sf, "lineitem").select(*IDS, "l_quantity", "l_extendedprice")
    return Standardize().fit_transform(d, ["l_quantity", "l_extendedprice"])


@query(
    "feat_clip",
    f"SELECT {ID}, least(greatest(l_quantity, 10), 40) AS l_quantity FROM lineitem",
)
def feat_clip(spark, sf):
    d = table(spark, sf, "lineitem").select(*IDS, "l_quantity")
    return Clip(10, 40).transform(d, ["l_quantity"])


@query(
    "feat_clipq",
    f"""WITH s AS (SELECT quantile_cont(l_extendedprice, 0.05) AS lo,
  quantile_cont(l_extendedprice, 0.95) AS hi FROM lineitem)
SELECT {ID}, round(least(greatest(l_extendedprice, lo), hi), 4) AS l_extendedprice
FROM lineitem, s""",
    digits=4,
)
def feat_clipq(spark, sf):
    d = table(spark, sf, "lineitem").select(*IDS, "l_extendedprice")
    return ClipQuantiles(0.05, 0.95).fit_transform(d, ["l_extendedprice"])


@query(
    "feat_log",
    "SELECT c_custkey, round(CASE WHEN c_acctbal + 1e-8 > 0 THEN ln(c_acctbal + 1e-8) END, 6) "
    "AS c_acctbal FROM customer",
)
def feat_log(spark, sf):
    d = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    # NaN stands for a negative argument; shown as NULL for the comparison
    return Log().transform(d, ["c_acctbal"]).withColumn(
        "c_acctbal", F.nanvl("c_acctbal", F.lit(None).cast("double"))
    )


@query(
    "feat_elementwise",
    f"SELECT {ID}, round(sqrt(abs(l_quantity - 25)), 6) AS l_quantity FROM lineitem",
)
def feat_elementwise(spark, sf):
    d = table(spark, sf, "lineitem").select(*IDS, "l_quantity")
    return Elementwise(lambda x: F.sqrt(F.abs(x - 25))).transform(d, ["l_quantity"])


@query(
    "feat_quantile",
    """WITH k AS (SELECT unnest(range(11)) AS i,
  unnest(quantile_cont(o_totalprice, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS q
  FROM orders),
g AS (SELECT a.i, a.q AS lo, b.q AS hi, b.i AS j FROM k a JOIN k b ON b.i = a.i + 1),
m AS (SELECT o_orderkey, o_totalprice AS x, (SELECT max(i) FROM g WHERE lo < x OR i = 0) AS i
      FROM orders)
SELECT o_orderkey, round(least(greatest((m.i + (x - lo) / (hi - lo)) / 10.0, 0), 1), 6)
  AS o_totalprice FROM m JOIN g ON m.i = g.i""",
)
def feat_quantile(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return QuantileTransform(n_quantiles=11).fit_transform(d, ["o_totalprice"])


def _poly_sql(x: str, coefs) -> str:
    out = repr(coefs[0])
    for c in coefs[1:]:
        out = f"({out} * {x} + {c!r})"
    return out


def probit_sql(p: str) -> str:
    """The published rational approximation of the normal quantile, with its own numbers."""
    # Acklam's coefficients.
    a = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
         1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
    b = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
         6.680131188771972e01, -1.328068155288572e01)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
         -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
         3.754408661907416e00)
    z, r = f"({p} - 0.5)", f"(({p} - 0.5) * ({p} - 0.5))"
    lo, hi = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"

    def tail(q: str) -> str:
        return f"{_poly_sql(q, c)} / {_poly_sql(q, d + (1.0,))}"

    return (
        f"CASE WHEN {p} < 0.02425 THEN {tail(lo)} WHEN {p} > 1 - 0.02425 THEN -{tail(hi)} "
        f"ELSE {_poly_sql(r, a)} * {z} / {_poly_sql(r, b + (1.0,))} END"
    )


KNOTS = 51
KNOTS_SQL = f"""k AS (SELECT unnest(range({KNOTS})) AS i,
  unnest(quantile_cont(o_totalprice, {[i / (KNOTS - 1) for i in range(KNOTS)]})) AS q
  FROM orders),
g AS (SELECT a.i, a.q AS lo, b.q AS hi FROM k a JOIN k b ON b.i = a.i + 1),
m AS (SELECT o_orderkey, o_totalprice AS x, (SELECT max(i) FROM g WHERE lo < x OR i = 0) AS i
      FROM orders),
u AS (SELECT o_orderkey, least(greatest((m.i + (x - lo) / (hi - lo)) / {KNOTS - 1}.0::DOUBLE,
        1e-7::DOUBLE), 1 - 1e-7::DOUBLE) AS u FROM m JOIN g ON m.i = g.i)"""


@query(
    "feat_gaussian",
    f"WITH {KNOTS_SQL} SELECT o_orderkey, round({probit_sql('u')}, 5) AS o_totalprice FROM u",
    digits=5,
)
def feat_gaussian(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return QuantileTransform("gaussian", KNOTS).fit_transform(d, ["o_totalprice"])


VECTOR_PARTS = [f"v{k}" for k in range(64)]
ROWS_SQL = f"""e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
m AS (SELECT *, list_avg(v) AS m, list_stddev_pop(v) AS s FROM e)"""
PARTS_SQL = ", ".join(f"round((v[{k + 1}] - m) / s, 6) AS {c}" for k, c in enumerate(VECTOR_PARTS))


def vector_parts(spark, sf):
    """The whole vector, a column per component; ``n`` tells that it has no more of them."""
    return table(spark, sf, "embeddings").select(
        "vec_id", F.size("embedding").cast("long").alias("n"),
        *[F.get("embedding", F.lit(k)).cast("double").alias(c) for k, c in enumerate(VECTOR_PARTS)],
    )


@query("feat_rowwise", f"WITH {ROWS_SQL} SELECT vec_id, {PARTS_SQL} FROM m")
def feat_rowwise(spark, sf):
    return RowStandardize().transform(vector_parts(spark, sf).drop("n"), VECTOR_PARTS)


@query("feat_rowwise_whole", f"WITH {ROWS_SQL} SELECT vec_id, len(v) AS n, {PARTS_SQL} FROM m")
def feat_rowwise_whole(spark, sf):
    return RowStandardize().transform(vector_parts(spark, sf), VECTOR_PARTS)


@query(
    "feat_vector",
    """WITH e AS (SELECT vec_id, unnest(range(len(embedding))) AS position, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)
SELECT vec_id, CAST(position AS INTEGER) AS position,
  round((v - avg(v) OVER r) / stddev_pop(v) OVER r, 6) AS by_row, round((v - avg(v) OVER p) / stddev_pop(v) OVER p, 6) AS by_position
FROM e WINDOW r AS (PARTITION BY vec_id), p AS (PARTITION BY position)""",
)
def feat_vector(spark, sf):
    """Standardised within each vector and by position, from the one array column."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    by_position = VectorStandardize().fit(e, "embedding")
    both = e.select("vec_id", F.arrays_zip(
        row_standardized("embedding").alias("by_row"), by_position.transform("embedding").alias("by_position")
    ).alias("z"))
    return both.select("vec_id", F.posexplode("z").alias("position", "z")).select("vec_id", "position", "z.by_row", "z.by_position")


@query(
    "feat_grouped",
    f"""SELECT {ID}, round((l_quantity - avg(l_quantity) OVER w)
  / stddev_pop(l_quantity) OVER w, 6) AS l_quantity
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)""",
)
def feat_grouped(spark, sf):
    d = table(spark, sf, "lineitem").select(*IDS, "l_returnflag", "l_quantity")
    step = Standardize(by=["l_returnflag"])
    return step.fit_transform(d, ["l_quantity"]).drop("l_returnflag")


@query(
    "feat_group_share",
    f"""WITH e AS (SELECT {ID}, l_orderkey AS k,
  exp(l_quantity - max(l_quantity) OVER (PARTITION BY l_orderkey)) AS x FROM lineitem)
SELECT {ID}, round(x / sum(x) OVER (PARTITION BY k), 6) AS l_quantity FROM e""",
)
def feat_group_share(spark, sf):
    d = table(spark, sf, "lineitem").select(*IDS, "l_quantity")
    return GroupShare(["l_orderkey"]).transform(d, ["l_quantity"])


@query(
    "feat_groups",
    f"""WITH {GAPS_SQL},
f AS (SELECT {ID}, l_quantity, l_extendedprice,
  coalesce(l_discount, (SELECT quantile_disc(l_discount, 0.5) FROM g)) AS l_discount FROM g),
s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS dq, avg(l_discount) AS md,
  stddev_pop(l_discount) AS dd FROM f),
l AS (SELECT *, ln(l_extendedprice + 1e-8) AS lp FROM f),
q AS (SELECT quantile_cont(lp, 0.01) AS lo, quantile_cont(lp, 0.99) AS hi FROM l)
SELECT {ID}, round((l_quantity - mq) / dq, 6) AS l_quantity,
  round(least(greatest(lp, lo), hi), 6) AS l_extendedprice,
  round((l_discount - md) / dd, 6) AS l_discount FROM l, s, q""",
)
def feat_groups(spark, sf):
    d = _gaps(spark, sf).drop("l_returnflag")
    g = FeatureGroups(
        {
            "l_(quantity|discount)": [FillMissing(), Standardize(), RaiseNonFinite()],
            "l_extended.*": [Log(), Identity(), ClipQuantiles(0.01, 0.99)],
        },
        ["l_quantity", "l_discount", "l_extendedprice"],
    )
    return g.fit(d)


@query(
    "feat_quantile_1000",
    """WITH k AS (SELECT unnest(range(1000)) AS i, unnest(quantile_cont(o_totalprice,
    [x / 999.0::DOUBLE for x in range(1000)])) AS q FROM orders),
s AS (SELECT q, min(i) AS first, max(i) AS last FROM k GROUP BY q),
g AS (SELECT q AS lo, first, last, lead(q) OVER (ORDER BY q) AS hi, lead(first) OVER (ORDER BY q) AS nxt FROM s)
SELECT o_orderkey, round((CASE WHEN x = lo THEN first WHEN hi IS NULL THEN 999
  ELSE last + (x - lo) / (hi - lo) * (nxt - last) END) / 999.0::DOUBLE, 6) AS o_totalprice
FROM (SELECT o_orderkey, o_totalprice AS x FROM orders) ASOF JOIN g ON x >= lo""",
)
def feat_quantile_1000(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return QuantileTransform().fit_transform(d, ["o_totalprice"])


def _two_groups() -> FeatureGroups:
    return FeatureGroups(
        {"l_(quantity|discount)": [FillMissing(), Standardize()], "l_extended.*": [Log(), ClipQuantiles(0.01, 0.99)]},
        ["l_quantity", "l_discount", "l_extendedprice"],
    )


@query(
    "feat_transform_new",
    f"""WITH {GAPS_SQL}, half AS (SELECT * FROM g WHERE l_orderkey % 2 = 0),
f AS (SELECT coalesce(l_quantity, (SELECT quantile_disc(l_quantity, 0.5) FROM half)) AS l_quantity,
  coalesce(l_discount, (SELECT quantile_disc(l_discount, 0.5) FROM half)) AS l_discount FROM half),
s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS dq, avg(l_discount) AS md, stddev_pop(l_discount) AS dd FROM f),
q AS (SELECT quantile_cont(ln(l_extendedprice + 1e-8), 0.01) AS lo, quantile_cont(ln(l_extendedprice + 1e-8), 0.99) AS hi FROM half)
SELECT {ID}, round((l_quantity - mq) / dq, 6) AS l_quantity,
  round(least(greatest(ln(l_extendedprice + 1e-8), lo), hi), 6) AS l_extendedprice,
  round((coalesce(l_discount, (SELECT quantile_disc(l_discount, 0.5) FROM half)) - md) / dd, 6) AS l_discount
FROM g, s, q WHERE l_orderkey % 2 = 1""",
)
def feat_transform_new(spark, sf):
    """Fitted on the lines of even orders, applied to those of odd ones."""
    d = _gaps(spark, sf).drop("l_returnflag")
    g = _two_groups()
    g.fit(d.where("l_orderkey % 2 = 0"))
    return g.transform(d.where("l_orderkey % 2 = 1"))


@query(
    "feat_match_info",
    """WITH c AS (SELECT column_name AS feature, row_number() OVER () - 1 AS i FROM
  (SELECT unnest(['l_quantity', 'l_discount', 'l_extendedprice']) AS column_name)),
n AS (SELECT count(l_quantity) AS q, count(l_discount) AS d, count(l_extendedprice) AS p FROM lineitem)
SELECT feature, CAST(i AS INTEGER) AS feature_index,
  CASE WHEN feature LIKE 'l_extended%' THEN 'l_extended.*' ELSE 'l_(quantity|discount)' END AS regex_match,
  CAST(CASE WHEN feature LIKE 'l_extended%' THEN 1 ELSE 0 END AS INTEGER) AS regex_match_index,
  CASE i WHEN 0 THEN q WHEN 1 THEN d ELSE p END AS present FROM c, n""",
)
def feat_match_info(spark, sf):
    """Which pattern takes which feature, with the number of present values."""
    d = table(spark, sf, "lineitem")
    g = _two_groups()
    counts = d.agg(*[F.count(f).alias(f) for f in g.features]).unpivot([], g.features, "feature", "present")
    return g.match_info(spark).join(counts, "feature")
