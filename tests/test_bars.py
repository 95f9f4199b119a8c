from datetime import date, datetime, timedelta

import pytest

from tickframe.operators.bars import quote_bars, time_bars

SCHEMA = (
    "symbol string, date date, peg_symbol string, time timestamp_ntz, price double, "
    "quantity double, quote_quantity double, is_buyer_maker boolean, trade_id bigint"
)


def trade(t, px, q=1.0, maker=True, i=0):
    return ("a", t[:10], "USDT", t, px, q, px * q, maker, i)


def bars(frame, rows, **kw):
    return time_bars(frame(rows, SCHEMA), timedelta(minutes=10), **kw).orderBy("date", "time").collect()


def test_last_bar_of_a_day_is_labelled_next_midnight(frame):
    b = bars(frame, [trade("2024-01-01 23:59:59.999999", 5.0)])[0]
    assert (b["date"], b["time"]) == (date(2024, 1, 1), datetime(2024, 1, 2))


def test_all_sell_bar_has_null_buy_price(frame):
    b = bars(frame, [trade("2024-01-01 00:01:00", 5.0, 2.0), trade("2024-01-01 00:02:00", 7.0, 2.0)])[0]
    assert b["vwap_taker_buy"] is None and b["taker_buy_volume"] == 0.0
    assert b["vwap_taker_sell"] == b["vwap_price"] == 6.0


@pytest.mark.parametrize("opts", [{}, {"tie": ("trade_id", "price")}])
def test_equal_times_follow_the_trade_id(frame, opts):
    rows = [trade("2024-01-01 00:01:00", float(i), i=i) for i in (3, 1, 2)]
    b = bars(frame, rows, **opts)[0]
    assert (b["open"], b["close"]) == (1.0, 3.0)


def test_left_label(frame):
    b = bars(frame, [trade("2024-01-01 00:10:00", 1.0)], label="left")[0]
    assert b["time"] == datetime(2024, 1, 1, 0, 10)


def test_quote_bar_offset(frame):
    d = frame([trade("2024-01-01 00:09:59", 2.0, 3.0)], SCHEMA)
    b = quote_bars(d, timedelta(minutes=10)).first()
    assert b["actual_time_offset_us"] == 1_000_000
    assert (b["volume_base"], b["volume_quote"]) == (3.0, 6.0)


def test_bigint_order_keeps_hash_aggregation(frame):
    d = frame([trade("2024-01-01 00:01:00", 1.0)], SCHEMA)
    plan = time_bars(d, timedelta(minutes=10))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan
