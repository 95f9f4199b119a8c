"""Bars, activity, price changes."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from registry.base import (
    BAR_COLS, BARS10_SQL, LOTS_SQL, M10, SCALE, bars10, bars_sql, exact, lots, query,
    tick_splits, ticks, tk_sql,
)
from tickframe.functions.numbers import spread, spread_bps, mid
from tickframe.functions.times import micros
from tickframe.operators.asof import order_position
from tickframe.operators.bars import quote_bars, time_bars
from tickframe.operators.scans import pct_change, previous
from tickframe.operators.tables import symbols_per_date


@query("bars_10m", f"WITH {BARS10_SQL} SELECT {BAR_COLS} FROM bars", digits=None)
def bars_10m(spark, sf):
    return bars10(spark, sf)


@query(
    "bars_1d_trades",
    "WITH " + LOTS_SQL + ",\n"
    + bars_sql("bars", "lots", "1 day", "time, l_orderkey, l_linenumber, l_partkey, l_suppkey")
    + f" SELECT {BAR_COLS} FROM bars",
    digits=None,
)
def bars_1d_trades(spark, sf):
    return time_bars(lots(spark, sf), timedelta(days=1), tie=("lot_id",), scale=SCALE)


@query(
    "bars_left_label",
    f"WITH {BARS10_SQL} SELECT symbol, date, time - INTERVAL '10 minutes' AS time, "
    "round(open, 6) AS open, round(close, 6) AS close, trade_count FROM bars",
)
def bars_left_label(spark, sf):
    b = time_bars(ticks(spark, sf), M10, label="left")
    return b.select("symbol", "date", "time", "open", "close", "trade_count")


@query(
    "bars_quote",
    f"""WITH {tk_sql()}
SELECT symbol, date, peg_symbol, time_bucket(INTERVAL '1 hour', time) AS time,
  first(price ORDER BY time, trade_id) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY time, trade_id) AS close,
  {exact('quantity')} AS volume_base, {exact('quote_quantity')} AS volume_quote, count(*) AS trade_count,
  {exact('CASE WHEN is_buyer_maker THEN 0 ELSE quote_quantity END')} AS taker_buy_volume_quote,
  {exact('CASE WHEN is_buyer_maker THEN quote_quantity ELSE 0 END')} AS taker_sell_volume_quote,
  {exact('CASE WHEN is_buyer_maker THEN 0 ELSE price * quote_quantity END')}
    / nullif({exact('CASE WHEN is_buyer_maker THEN 0 ELSE quote_quantity END')}, 0) AS vwap_taker_buy,
  {exact('CASE WHEN is_buyer_maker THEN price * quote_quantity ELSE 0 END')}
    / nullif({exact('CASE WHEN is_buyer_maker THEN quote_quantity ELSE 0 END')}, 0) AS vwap_taker_sell,
  {exact('price * quantity')} / nullif({exact('quantity')}, 0) AS vwap_total_by_base,
  epoch_us(time_bucket(INTERVAL '1 hour', tk.time) + INTERVAL '1 hour') - epoch_us(max(tk.time))
    AS actual_time_offset_us
FROM tk GROUP BY symbol, date, peg_symbol, time_bucket(INTERVAL '1 hour', tk.time)""",
    digits=None,
)
def bars_quote(spark, sf):
    return quote_bars(ticks(spark, sf), timedelta(hours=1), scale=SCALE)


@query(
    "active_symbols_by_date",
    f"WITH {tk_sql('user_id')} "
    "SELECT date, count(DISTINCT symbol) AS n_symbols FROM tk GROUP BY date",
)
def active_symbols_by_date(spark, sf):
    return symbols_per_date(ticks(spark, sf, "user_id"))


@query(
    "pct_change",
    f"""WITH {BARS10_SQL}
SELECT symbol, time, round(close, 6) AS close,
  round(close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY time), 0) - 1, 6)
    AS pct_change
FROM bars""",
)
def pct_change_close(spark, sf):
    b = bars10(spark, sf).select("symbol", "time", "close")
    pos = order_position(micros("time"), False)
    return pct_change(b, ["symbol"], pos, "close", splits=tick_splits(spark, sf))


@query(
    "spread_bps",
    f"""WITH {tk_sql()}, p AS (
  SELECT symbol, trade_id, price,
         lag(price) OVER (PARTITION BY symbol ORDER BY time, trade_id) AS prev FROM tk),
q AS (SELECT symbol, trade_id, least(price, prev) AS bid, greatest(price, prev) AS ask
      FROM p WHERE prev IS NOT NULL)
SELECT symbol, trade_id, bid, ask, round(ask - bid, 6) AS spread,
  round((ask + bid) / 2, 6) AS mid,
  round((ask - bid) / nullif((ask + bid) / 2, 0) * 10000, 6) AS bps FROM q""",
)
def spread_in_bps(spark, sf):
    pos = order_position(micros("time"), False)
    p = previous(
        ticks(spark, sf).select("symbol", "trade_id", "price", "time"), ["symbol"], pos,
        {"prev": F.col("price")}, tie=F.col("trade_id"), splits=tick_splits(spark, sf),
    ).where("prev IS NOT NULL")
    q = p.select(
        "symbol", "trade_id", F.least("price", "prev").alias("bid"),
        F.greatest("price", "prev").alias("ask"),
    )
    return q.select(
        "*", spread("bid", "ask").alias("spread"), mid("bid", "ask").alias("mid"),
        spread_bps("bid", "ask").alias("bps"),
    )
