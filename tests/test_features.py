import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.functions.numbers import clip, erfinv, log_eps, parse_number, probit, valid_price, valid_size
from tickframe.operators.vectors import VectorStandardize, row_standardized
from tickframe.operators.features import (
    Clip, ClipQuantiles, Elementwise, FeatureGroups, FillMissing, GroupMap, GroupShare, Identity,
    Log, QuantileTransform, RaiseNonFinite, RowStandardize, Standardize,
)

NAN, INF = float("nan"), float("inf")


def col(df, name="x"):
    return [r[name] for r in df.orderBy("i").collect()]


@pytest.fixture()
def xs(frame):
    def make(*values):
        return frame([(i, v) for i, v in enumerate(values)], "i int, x double")

    return make


def test_fill_uses_lower_median(xs):
    d = xs(4.0, None, 1.0, NAN, 3.0, 2.0)
    assert col(FillMissing().fit_transform(d, ["x"])) == [4.0, 2.0, 1.0, 2.0, 3.0, 2.0]
    assert col(FillMissing(9.0).transform(d, ["x"]))[1] == 9.0


def test_fill_needs_a_value(xs):
    with pytest.raises(ValueError):
        FillMissing().fit(xs(None, NAN), ["x"])


def test_transform_before_fit(xs):
    with pytest.raises(RuntimeError):
        Standardize().transform(xs(1.0), ["x"])


def test_fit_once_unless_refit(xs):
    s = Standardize().fit(xs(0.0, 2.0), ["x"])
    assert s.fit(xs(10.0, 30.0), ["x"]).stats["x"]["mean"] == 1.0
    assert s.fit(xs(10.0, 30.0), ["x"], refit=True).stats["x"]["mean"] == 20.0


def test_standardize_population_and_guard(xs):
    assert col(Standardize().fit_transform(xs(0.0, 2.0, NAN), ["x"]))[:2] == [-1.0, 1.0]
    with pytest.raises(ValueError):
        Standardize().fit(xs(5.0, 5.0), ["x"])
    with pytest.raises(ValueError):
        Standardize(skip_missing=False).fit(xs(1.0, 2.0, NAN), ["x"])
    assert col(Standardize(mean=1.0, std=2.0).transform(xs(5.0), ["x"])) == [2.0]


def test_grouped_standardize(frame):
    d = frame([(0, "a", 0.0), (1, "a", 2.0), (2, None, 5.0), (3, None, 9.0)], "i int, k string, x double")
    assert col(Standardize(by=["k"]).fit_transform(d, ["x"])) == [-1.0, 1.0, -1.0, 1.0]


def test_clip_keeps_nan(xs):
    out = col(Clip(0.0, 1.0).transform(xs(-5.0, 0.5, 7.0, NAN, None, INF), ["x"]))
    assert out[:3] == [0.0, 0.5, 1.0] and math.isnan(out[3]) and out[4] is None and out[5] == 1.0


def test_clip_quantiles(xs):
    v = np.arange(101.0)
    out = col(ClipQuantiles(0.05, 0.95).fit_transform(xs(*v.tolist()), ["x"]))
    assert (min(out), max(out)) == (5.0, 95.0)


def test_log(xs):
    out = col(Log().transform(xs(1.0, 0.0, -1.0), ["x"]))
    assert out[0] == pytest.approx(1e-8) and out[1] == pytest.approx(math.log(1e-8))
    assert math.isnan(out[2])


def test_raise_non_finite(xs):
    with pytest.raises(ValueError, match="missing"):
        RaiseNonFinite().transform(xs(1.0, NAN), ["x"])
    with pytest.raises(ValueError, match="neg_inf"):
        RaiseNonFinite(on_missing=False).transform(xs(-INF, NAN), ["x"])
    RaiseNonFinite(on_missing=False, on_inf=False).transform(xs(INF, None), ["x"])


def test_quantile_transform_matches_numpy(xs):
    rng = np.random.default_rng(1)
    v = rng.normal(size=400)
    n = 50
    got = col(QuantileTransform(n_quantiles=n).fit_transform(xs(*v.tolist(), NAN), ["x"]))
    knots = np.quantile(v, np.linspace(0, 1, n))
    np.testing.assert_allclose(got[:-1], np.interp(v, knots, np.linspace(0, 1, n)), atol=1e-9)
    assert math.isnan(got[-1])


def test_gaussian_quantiles(xs):
    got = col(QuantileTransform("gaussian", 101).fit_transform(xs(*np.arange(101.0).tolist()), ["x"]))
    assert got[50] == pytest.approx(0.0, abs=1e-9)
    assert got[0] == pytest.approx(-5.19933758, abs=1e-6)  # normal quantile of 1e-7
    assert got[84] == pytest.approx(0.99445788, abs=1e-6)


def test_repeated_knots_and_subsample(xs):
    d = xs(*([0.0] * 50 + [1.0] * 50))
    out = col(QuantileTransform(n_quantiles=11, subsample=60, seed=3).fit_transform(d, ["x"]))
    assert set(out[:50]) == {0.0} and all(0 < o <= 1 for o in out[50:])


def test_probit_and_erfinv(xs):
    p = [1e-7, 0.01, 0.3, 0.5, 0.9, 0.9999]
    out = col(xs(*p).withColumn("x", probit(F.col("x"))))
    back = [0.5 * math.erfc(-z / math.sqrt(2)) for z in out]
    np.testing.assert_allclose(back, p, rtol=1e-7)
    e = col(xs(0.5).withColumn("x", erfinv(F.col("x"))))[0]
    assert math.erf(e) == pytest.approx(0.5, rel=1e-8)


def test_row_standardize(frame):
    d = frame([(0, 1.0, 3.0, NAN)], "i int, a double, b double, c double")
    r = RowStandardize().transform(d, ["a", "b", "c"]).first()
    assert (r["a"], r["b"]) == (-1.0, 1.0) and math.isnan(r["c"])


def test_group_share_and_map(frame):
    d = frame([(0, "a", 1.0), (1, "a", 1.0), (2, "b", 800.0)], "i int, k string, x double")
    assert col(GroupShare(["k"]).transform(d, ["x"])) == [0.5, 0.5, 1.0]
    assert col(GroupMap(["k"], lambda p: p - p.mean()).transform(d, ["x"])) == [0.0, 0.0, 0.0]


def test_groups_first_match_wins_and_names_stay(spark, frame):
    d = frame([(1.0, 10.0, 3.0), (3.0, 30.0, 5.0)], "a1 double, b double, a2 double")
    with pytest.warns(UserWarning):
        g = FeatureGroups({"a.*": [Standardize()], ".*": [Elementwise(lambda x: x * 2)]}, d.columns)
    out = g.fit(d).orderBy("b").collect()
    assert [tuple(r) for r in out] == [(-1.0, 20.0, -1.0), (1.0, 60.0, 1.0)]
    again = g.transform(d).orderBy("b").collect()
    assert out == again
    info = [tuple(r) for r in g.match_info(spark).collect()]
    assert info == [("a1", 0, "a.*", 0), ("b", 1, ".*", 1), ("a2", 2, "a.*", 0)]


def test_unmatched_feature_is_an_error():
    with pytest.raises(ValueError):
        FeatureGroups({"a": [Identity()]}, ["a", "b"])


def test_scalar_rules(frame):
    d = frame([("1.5e10",), (" 1",), ("abc",), ("-1",), ("0",), ("inf",), ("NaN",), (None,)], "t string")
    got = [
        tuple(r) for r in d.select(
            parse_number("t").alias("v"), valid_price(parse_number("t")), valid_size(parse_number("t"))
        ).collect()
    ]
    assert [g[1] for g in got] == [True, False, False, False, True, False, False, False]
    assert [g[2] for g in got] == [True, False, False, False, False, False, False, False]
    assert got[0][0] == 1.5e10 and got[1][0] is None


def test_clip_and_log_functions_on_open_sides(xs):
    d = xs(-1.0, 2.0)
    assert col(d.withColumn("x", clip("x", None, 1.0))) == [-1.0, 1.0]
    assert col(d.withColumn("x", log_eps("x", 0.0)))[1] == pytest.approx(math.log(2))


def test_vector_steps_skip_what_is_missing(spark):
    nan = float("nan")
    rows = [(1, [1.0, 2.0, 6.0]), (2, [3.0, None, nan]), (3, None), (4, []), (5, [5.0, 5.0]), (6, [7.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    got = {r["id"]: r["z"] for r in df.select("id", row_standardized("v").alias("z")).collect()}
    std = (14 / 3) ** 0.5
    assert got[1] == pytest.approx([-2 / std, -1 / std, 3 / std])
    assert got[2] == [None] * 3 and got[3] is None and got[4] == [] and got[5] == [None, None]
    step = VectorStandardize().fit(df, "v")
    assert step.means == pytest.approx([4.0, 8 / 3, 3.0])
    got = {r["id"]: r["z"] for r in df.select("id", step.transform("v").alias("z")).collect()}
    assert got[2][0] == pytest.approx(-1 / 5**0.5) and got[2][1:] == [None, None] and got[3] is None and got[4] == []
    longer = spark.createDataFrame([([4.0, 8 / 3, 3.0, 9.0],)], "v array<double>")
    assert longer.select(step.transform("v")).first()[0][:3] == pytest.approx([0.0, 0.0, 0.0]) and longer.select(step.transform("v")).first()[0][3] is None
    with pytest.raises(ValueError, match="positions"):
        VectorStandardize().fit(df.where("id IN (4, 5)"), "v")
