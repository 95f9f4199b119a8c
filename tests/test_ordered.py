"""Running operations, rolling windows and quantiles: split plans equal plain plans."""

import datetime as dt
import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry.base import table, ticks
from tickframe.functions.times import micros
from tickframe.operators.asof import asof_splits
from tickframe.operators.curves import dependence_curve
from tickframe.operators.merging import count_of, greatest_of, least_of, rolling_merged, sum_of
from tickframe.operators.quantiles import exact_quantiles
from tickframe.operators.ranks import rank_columns
from tickframe.operators.rolling import (
    filled, last_per_interval, mean, rolling, rolling_frame, sample_std, total,
)
from tickframe.operators.scans import forward_fill, pct_change, previous, running_sums
from tickframe.operators.splits import measure_splits

DAY = timedelta(days=1)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def data(spark, sf):
    t = ticks(spark, sf)
    one = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    t = t.withColumn("time", F.when(F.col("trade_id") % 3 == 0, one).otherwise(F.col("time")))
    return t.withColumn(
        "symbol", F.when(F.col("trade_id") % 2 == 0, "click").otherwise(F.col("symbol"))
    ).withColumn("x", F.when(F.col("trade_id") % 10 == 0, F.col("price"))).cache()


@pytest.fixture(scope="module")
def splits(data):
    s = measure_splits(data, ["symbol"], micros("time"), tie=F.col("trade_id"), min_rows=25)
    assert s.active and s.ties.active  # hot symbols, and a hot instant inside them
    return s


@pytest.mark.parametrize("op", [running_sums, forward_fill, previous])
def test_split_scan_equals_plain(data, splits, op):
    args = (["symbol"], micros("time"), {"out": F.col("x")}, F.col("trade_id"))
    plain, cut = (op(data, *args, s).withColumn("out", F.round("out", 6)) for s in (None, splits))
    assert same(plain, cut)


def test_pct_change_split_equals_plain(data, splits):
    args = (["symbol"], micros("time"), "price", "chg", F.col("trade_id"))
    assert same(pct_change(data, *args), pct_change(data, *args, splits))


def test_rolling_three_ways(data):
    ms = {
        DAY: {"s": total(F.col("price")), "sd": sample_std("price")},
        7 * DAY: {"m": mean("x"), "n": filled("x")},
    }
    cut = asof_splits(data, ["symbol"], "time", min_rows=25)
    frames = {
        DAY: {
            "s": lambda w: F.coalesce(F.sum("price").over(w), F.lit(0.0)),
            "sd": lambda w: F.stddev_samp("price").over(w),
        },
        7 * DAY: {"m": lambda w: F.avg("x").over(w), "n": lambda w: F.count("x").over(w)},
    }
    results = [
        rolling(data, ["symbol"], "time", ms),
        rolling(data, ["symbol"], "time", ms, splits=cut),
        rolling_frame(data, ["symbol"], "time", frames),
        rolling_frame(data, ["symbol"], "time", frames, slice_by=7 * DAY),
    ]
    pdfs = [
        r.select("trade_id", "s", "sd", "m", "n").toPandas().set_index("trade_id").sort_index()
        for r in results
    ]
    for p in pdfs[1:]:
        assert len(p) == len(pdfs[0])
        np.testing.assert_allclose(p.astype(float), pdfs[0].astype(float), rtol=1e-9, atol=1e-7)


def test_window_excludes_own_time_and_includes_far_edge(frame):
    d = frame(
        [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-02 00:00:00", 2.0),
         ("a", "2024-01-02 00:00:00", 4.0), ("a", "2024-01-02 00:00:00.000001", 8.0)],
        "symbol string, time timestamp_ntz, v double",
    )
    out = rolling(d, ["symbol"], "time", {DAY: {"s": total(F.col("v")), "m": mean("v")}})
    got = {r["v"]: (r["s"], r["m"]) for r in out.collect()}
    # exactly one day back is inside, rows of the same time are outside
    assert got == {1.0: (0.0, None), 2.0: (1.0, 1.0), 4.0: (1.0, 1.0), 8.0: (6.0, 3.0)}


def test_last_per_interval(frame):
    d = frame(
        [("a", "2024-01-01 23:10:00", 1), ("a", "2024-01-01 23:59:59.999999", 2),
         ("a", "2024-01-02 00:00:00", 3), ("b", "2024-01-01 23:30:00", 4)],
        "symbol string, time timestamp_ntz, v int",
    )
    s = last_per_interval(d, ["symbol"], "time", timedelta(hours=1), "grid")
    got = {(r["symbol"], str(r["grid"])): r["v"] for r in s.collect()}
    assert got == {
        ("a", "2024-01-02 00:00:00"): 2, ("a", "2024-01-02 01:00:00"): 3,
        ("b", "2024-01-02 00:00:00"): 4,
    }


def test_last_per_interval_does_not_depend_on_input_order(frame):
    rows = [("a", "2024-01-01 23:10:00", v) for v in range(40)]
    schema = "symbol string, time timestamp_ntz, v int"
    for order in (rows, rows[::-1], rows[20:] + rows[:20]):
        d = frame(order, schema).repartition(3)
        assert [r["v"] for r in last_per_interval(d, ["symbol"], "time", timedelta(hours=1), "g").collect()] == [39]


def test_rolling_with_a_null_key_split_equals_plain(spark):
    rows = [(None if i % 2 else "a", i, float(i * i % 17)) for i in range(60)]
    d = spark.createDataFrame(rows, "k string, s int, x double").selectExpr("k", "cast(timestamp_seconds(s * 3600) as timestamp_ntz) AS time", "x")
    cut = asof_splits(d, ["k"], "time", min_rows=5)
    ms = {DAY: {"sd": sample_std("x")}}
    plain, split = (rolling(d, ["k"], "time", ms, s).withColumn("sd", F.round("sd", 9)) for s in (None, cut))
    assert cut.active and same(plain, split)


def test_rank_by_counts_equals_window(data):
    d = data.select("symbol", "trade_id", F.round("price", -1).alias("v"), "x")
    plain = rank_columns(d, ["v", "x"], ["symbol"])
    spread = rank_columns(d, ["v", "x"], ["symbol"], in_task_rows=20)
    assert same(plain.select(spread.columns), spread) and spread.count() == d.count()


@pytest.mark.parametrize("method", ["linear", "lower", "nearest"])
def test_distributed_quantiles_equal_in_task(spark, sf, method):
    d = table(spark, sf, "lineitem").select("l_extendedprice", "l_discount").withColumn(
        "gaps", F.when(F.col("l_discount") > 0.05, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    )
    cols, probs = d.columns, [0.0, 0.01, 0.333, 0.5, 0.77, 1.0]
    small = exact_quantiles(d, cols, probs, method)
    large = exact_quantiles(d, cols, probs, method, in_task_rows=200)
    assert small == large
    x = np.array([r[0] for r in d.select("l_extendedprice").collect()])
    how = {"linear": "linear", "lower": "lower"}.get(method)
    if how:
        np.testing.assert_allclose(small["l_extendedprice"], np.quantile(x, probs, method=how))


def test_quantile_of_nothing(frame):
    d = frame([(None,), (float("nan"),)], "x double")
    assert exact_quantiles(d, ["x"], [0.5]) == {"x": [None]}


def test_curve_split_equals_plain_on_heavy_values(spark, sf):
    """Eleven distinct discounts: every value is heavy, the tie column orders inside it."""
    d = table(spark, sf, "lineitem").select(
        "l_discount", "l_quantity", "l_extendedprice",
        F.monotonically_increasing_id().alias("id"),
    ).cache()
    args = (d, "l_discount", ["l_quantity"], "l_quantity", "id")
    plain, cut = dependence_curve(*args), dependence_curve(*args, rows_per_part=200)
    assert same(plain, cut)
    assert plain.agg(F.max("weight_norm")).first()[0] == pytest.approx(1.0)


@pytest.mark.parametrize("slices", [1, 2, 7, 24])
def test_merged_windows_equal_frames(spark, slices):
    """Ties, gaps longer than a window, window ends on slice borders, missing values, keys and times."""
    rng = random.Random(slices)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for key in ("hot", "b", None):
        at = 0
        for k in range(300 if key == "hot" else 60):
            at += rng.choice([0, 0, 1, 30, 60, 600, 600, 3600, 90_000 if k % 50 == 0 else 5])
            rows.append((key, start + dt.timedelta(seconds=at), None if rng.random() < 0.1 else rng.randrange(1000), k))
    rows += [("b", None, 5, -1), ("hot", start, 7, -2)]
    df = spark.createDataFrame(rows, "key string, time timestamp_ntz, x long, n long")
    hour = dt.timedelta(hours=1)
    got = rolling_merged(df, ["key"], "time", hour, {
        "low": least_of(F.col("x")), "high": greatest_of(F.col("x")), "sum": sum_of(F.col("x")), "count": count_of(F.col("x")),
    }, slices=slices)
    want = rolling_frame(df.where("time IS NOT NULL"), ["key"], "time", {hour: {
        "low": lambda w: F.min("x").over(w), "high": lambda w: F.max("x").over(w), "sum": lambda w: F.sum("x").over(w),
        "count": lambda w: F.nullif(F.count("x").over(w), F.lit(0)),
    }})
    empty = df.where("time IS NULL").selectExpr("*", *[f"CAST(NULL AS LONG) AS {c}" for c in ("low", "high", "sum", "count")])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.union(empty).collect()))
