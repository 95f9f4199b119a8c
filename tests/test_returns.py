from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry.base import bars10
from tickframe.operators.asof import asof_splits
from tickframe.plans.metadata import Metadata
from tickframe.plans.research import DEFAULT_MARKS, default_marks, mark
from tickframe.plans.returns import Returns

M = timedelta(minutes=1)


@pytest.fixture(scope="module")
def bars(spark, sf):
    return bars10(spark, sf).cache()


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_batch_equals_single_marks(bars):
    q = bars.select("symbol", "time")
    r = Returns(bars)
    marks = {"now_to_p10m": mark("now_to_p10m"), "m20m_to_now": mark("m20m_to_now")}
    both = r.query_batch(q, marks, tolerance=60 * M)
    for n, (s, d) in marks.items():
        one = r.query(q, s, d, tolerance=60 * M).withColumnsRenamed(
            {"return": f"return_{n}", "max_tick_to_query_lag": f"max_tick_to_query_lag_{n}"}
        )
        assert same(one, both.select(one.columns))


def test_column_start_equals_offset_start(bars):
    q = bars.select("symbol", "time")
    r = Returns(bars)
    off = r.query(q, -20 * M, 20 * M, tolerance=60 * M)
    col = r.query(q, F.col("time") - F.expr("INTERVAL 20 MINUTES"), 20 * M, tolerance=60 * M)
    assert same(off, col)


def test_duplicate_query_rows_are_kept(bars):
    q = bars.select("symbol", "time")
    r = Returns(bars)
    twice = r.query(q.unionAll(q), tolerance=60 * M)
    assert twice.count() == 2 * q.count()
    assert same(twice, r.query(q, tolerance=60 * M).unionAll(r.query(q, tolerance=60 * M)))


def test_date_pruning_changes_nothing_within_tolerance(bars):
    q = bars.where("date BETWEEN DATE'2024-01-10' AND DATE'2024-01-12'").select("symbol", "time")
    r = Returns(bars)
    full = r.query(q, -20 * M, 40 * M, tolerance=60 * M, append_lag=False)
    asked = r.query(q, -20 * M, 40 * M, tolerance=60 * M, append_lag=False, dates="query")
    given = r.query(
        q, -20 * M, 40 * M, tolerance=60 * M, append_lag=False,
        dates=(date(2024, 1, 10), date(2024, 1, 13)),
    )
    assert same(full, asked) and same(full, given)


def test_strict_pruning_hides_the_day_before(frame):
    b = frame(
        [("a", "2024-01-01 23:59:50", "2024-01-01", 1.0), ("a", "2024-01-02 00:05:00", "2024-01-02", 2.0)],
        "symbol string, last_event_time timestamp_ntz, date date, vwap_price double",
    )
    q = frame([("a", "2024-01-02 00:00:05")], "symbol string, time timestamp_ntz")
    opts = dict(duration=10 * M, tolerance=30 * M, append_start_end_fairs=True)
    loose = Returns(b).query(q, dates="query", **opts).first()
    strict = Returns(b).query(q, dates="query", strict_date_pruning=True, **opts).first()
    assert (loose["start_fair"], strict["start_fair"]) == (1.0, None)
    assert loose["end_fair"] == strict["end_fair"] == 2.0


def test_no_marks_is_an_error(bars):
    with pytest.raises(ValueError):
        Returns(bars).query_batch(bars, {})


def test_default_marks():
    m = default_marks()
    assert len(m) == len(DEFAULT_MARKS) == 28
    assert m["m1d_to_now"] == (timedelta(days=-1), timedelta(days=1))
    assert m["p1m_to_p11m"] == (M, 10 * M)
    assert m["now_to_p12h"] == (timedelta(0), timedelta(hours=12))


def test_metadata_is_point_in_time(spark, bars):
    """Dropping everything after a moment changes no earlier metadata row."""
    uni = bars.select("symbol", "date").distinct()
    cut = "2024-01-15 00:00:00"
    names = ["liquidity_1d", "trade_count_7d", "daily_vol_7d_lookback", "vol_ssize_30d_lookback"]
    keep = ["symbol", "time", *names]

    def at(b):
        rows = Metadata(b, uni).compute().where(f"time <= TIMESTAMP_NTZ'{cut}' - INTERVAL 1 HOUR")
        return {
            (r["symbol"], r["time"]): [None if r[n] is None else round(r[n], 6) for n in names]
            for r in rows.select(keep).collect()
        }

    assert at(bars) == at(bars.where(f"last_event_time <= TIMESTAMP_NTZ'{cut}'"))


def test_last_date_of_a_batch_is_kept(bars):
    uni = bars.select("symbol", "date").distinct()
    d = date(2024, 1, 12)
    one = Metadata(bars, uni).compute((d, d))
    assert {r[0] for r in one.select("date").distinct().collect()} == {d}
    full = Metadata(bars, uni).compute().where(F.col("date") == F.lit(d))
    cols = ["symbol", "time", "trade_count_7d", "vol_ssize_30d_lookback", "liquidity_1d_q"]
    assert same(one.select(cols), full.select(cols))


def test_hot_symbol_plan_equals_plain_plan(spark, sf, bars):
    """Returns and metadata with every symbol cut into parts."""
    uni = bars.select("symbol", "date").distinct()
    cut = asof_splits(bars, ["symbol"], "last_event_time", min_rows=30)
    assert cut.active
    q = bars.select("symbol", "time")
    marks = {n: mark(n) for n in ("now_to_p10m", "m1d_to_now")}
    assert same(
        Returns(bars).query_batch(q, marks, tolerance=60 * M),
        Returns(bars, splits=cut).query_batch(q, marks, tolerance=60 * M),
    )
    d = date(2024, 1, 20)
    key = ["symbol", "time"]
    pair = [
        Metadata(bars, uni, splits=s).compute((d, d)).toPandas().set_index(key).sort_index()
        for s in (None, cut)
    ]
    assert len(pair[0]) == len(pair[1]) > 0
    for c in pair[0].columns.drop(["date", "last_event_time"]):
        np.testing.assert_allclose(
            pair[1][c].astype(float), pair[0][c].astype(float), rtol=1e-8, atol=1e-8, err_msg=c
        )
