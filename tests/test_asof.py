from datetime import timedelta

from pyspark.sql import functions as F

from registry.base import ticks
from tickframe.operators.asof import asof_join, asof_splits

T = "2024-01-01 00:00:"


def run(frame, ticks_, queries, **kw):
    t = frame(ticks_, "symbol string, time timestamp_ntz, px double")
    q = frame(queries, "symbol string, at timestamp_ntz")
    out = asof_join(q, t, "at", "time", ["symbol"], values=["px"], lag_as="lag", **kw)
    return {(r["symbol"], str(r["at"])[17:]): (r["px"], r["lag"]) for r in out.collect()}


def test_inclusive_at_equal_time(frame):
    got = run(frame, [("a", T + "05", 1.0)], [("a", T + "05"), ("a", T + "04")])
    assert got == {("a", "05"): (1.0, 0), ("a", "04"): (None, None)}


def test_tolerance_boundary_keeps_lag(frame):
    got = run(
        frame, [("a", T + "00", 1.0)], [("a", T + "10"), ("a", T + "10.000001")],
        tolerance=timedelta(seconds=10),
    )
    assert got[("a", "10")] == (1.0, 10_000_000)
    assert got[("a", "10.000001")] == (None, 10_000_001)


def test_unknown_and_null_symbols_are_kept(frame):
    got = run(frame, [("a", T + "00", 1.0)], [("zzz", T + "10"), (None, T + "10")])
    assert got == {("zzz", "10"): (None, None), (None, "10"): (None, None)}


def test_name_collision_gets_suffix(frame):
    t = frame([("a", T + "00", 1.0)], "symbol string, time timestamp_ntz, px double")
    q = frame([("a", T + "01", 9.0)], "symbol string, at timestamp_ntz, px double")
    out = asof_join(q, t, "at", "time", ["symbol"])
    assert out.columns == ["symbol", "at", "px", "px_right"]
    assert out.first()["px_right"] == 1.0


def _skewed(spark, sf):
    """Half of the rows share a symbol, a third share one instant."""
    t = ticks(spark, sf)
    one = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return t.withColumn("time", F.when(F.col("trade_id") % 3 == 0, one).otherwise(F.col("time"))).withColumn(
        "symbol", F.when(F.col("trade_id") % 2 == 0, "click").otherwise(F.col("symbol"))
    )


def test_split_plan_equals_plain_plan(spark, sf):
    t = _skewed(spark, sf)
    q = t.select("symbol", F.col("time").alias("at"), F.col("trade_id").alias("id"))
    opts = dict(values=["price", "trade_id"], tie=["trade_id"], time_as="tt", lag_as="lag")
    splits = asof_splits(t, ["symbol"], "time", min_rows=25)
    assert splits.active and splits.longest > 5
    plain = asof_join(q, t, "at", "time", ["symbol"], **opts)
    cut = asof_join(q, t, "at", "time", ["symbol"], splits=splits, **opts)
    assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()
    assert cut.count() == q.count()


def test_splits_spread_a_hot_instant(spark, sf):
    """Queries of one instant of one symbol go to several parts."""
    t = _skewed(spark, sf)
    s = asof_splits(t, ["symbol"], "time", min_rows=25)
    d = t.select(
        F.col("symbol").alias("k"), (F.unix_micros(F.col("time").cast("timestamp")) * 2).alias("pos"),
        "trade_id",
    ).where("k = 'click'")
    parts = s.assign(d, ["k"], "pos", spread=F.hash("trade_id")).groupBy("__p1", "__p2").count()
    assert parts.agg(F.max("count")).first()[0] < d.count() / 5


def test_no_hot_key_means_plain_plan(spark, sf):
    assert not asof_splits(ticks(spark, sf), ["symbol"], "time").active
