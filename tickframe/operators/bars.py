"""Time bars: OHLC, volumes and volume-weighted prices per symbol, date and interval."""

from __future__ import annotations

from datetime import timedelta
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickframe.functions.numbers import ratio
from tickframe.functions.times import floor_us, from_micros, micros, to_us


def order_key(us: Column, start: Column, every: timedelta, tie: Sequence[str]):
    """One sortable value for (time, tie).

    One whole-number id below 5 * 10**26, which any bigint is, goes beside the offset into one
    DECIMAL(38): the aggregation stays a hash aggregation with map-side combine. A struct, for
    several columns or bars beyond a day, forces sort aggregation.
    """
    if not tie:
        return us
    if len(tie) == 1 and to_us(every) < 10**11:
        scale = F.lit("1" + "0" * 27).cast("decimal(28,0)")
        wide = (us - start).cast("decimal(11,0)") * scale
        return wide.cast("decimal(38,0)") + F.col(tie[0]).cast("decimal(27,0)")
    return F.struct(us.alias("us"), *[F.col(c) for c in tie])


def _sum(value: Column, scale: int | None) -> Column:
    """A sum of doubles, or of decimals with ``scale`` digits, which does not depend on the order."""
    return F.sum(value) if scale is None else F.sum(value.cast(f"decimal(28,{scale})")).cast("double")


def _weighted(price: Column, weight: Column, scale: int | None) -> Column:
    """sum(p*w) / sum(w); NULL when the weights add up to zero."""
    return ratio(_sum(price * weight, scale), _sum(weight, scale))


def _grid(trades: DataFrame, every: timedelta, time: str, tie, kept: list[str]):
    us = micros(time)
    start = floor_us(F.col("__us"), every)
    return (
        trades.select(*kept, *[c for c in tie if c not in kept], us.alias("__us"))
        .withColumn("__bar", start)
        .withColumn("__ord", order_key(F.col("__us"), F.col("__bar"), every, tie))
    )


def time_bars(
    trades: DataFrame,
    every: timedelta,
    time: str = "time",
    tie: Sequence[str] = ("trade_id",),
    label: str = "right",
    scale: int | None = None,
) -> DataFrame:
    """Base-currency bars. ``time`` is the right edge (visible once complete) unless
    ``label="left"``. ``date`` stays the trade date, so the bar ending at midnight belongs to
    the day it covers. First and last follow (time, tie). ``scale`` adds up amounts exactly, as
    decimals of so many digits: bars then repeat to the last bit."""
    kept = ["symbol", "date", "peg_symbol", "price", "quantity", "is_buyer_maker"]
    g = _grid(trades, every, time, tie, kept)
    edge = F.col("__bar") + (F.lit(to_us(every)) if label == "right" else F.lit(0))
    bars = g.groupBy("symbol", "date", "peg_symbol", "__bar").agg(*bar_measures(scale))
    return bar_columns(bars.withColumn("time", from_micros(edge)))


def bar_measures(scale: int | None = None) -> list[Column]:
    """Aggregates of one bar over price, quantity, is_buyer_maker, __us and __ord."""
    p, q = F.col("price"), F.col("quantity")
    buy = F.when(F.col("is_buyer_maker"), F.lit(0.0)).otherwise(q)
    sell = F.when(F.col("is_buyer_maker"), q).otherwise(F.lit(0.0))
    return [
        F.min_by(p, "__ord").alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, "__ord").alias("close"),
        _sum(q, scale).alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.max("__us").alias("__last"),
        _sum(buy, scale).alias("taker_buy_volume"),
        _sum(sell, scale).alias("taker_sell_volume"),
        _weighted(p, buy, scale).alias("vwap_taker_buy"),
        _weighted(p, sell, scale).alias("vwap_taker_sell"),
        _weighted(p, q, scale).alias("vwap_price"),
    ]


def bar_columns(bars: DataFrame) -> DataFrame:
    return bars.select(
        "symbol", "date", "time", "peg_symbol",
        "open", "high", "low", "close", "volume", "trade_count",
        from_micros("__last").alias("last_event_time"),
        "taker_buy_volume", "taker_sell_volume",
        "vwap_taker_buy", "vwap_taker_sell", "vwap_price",
    )


def quote_bars(
    trades: DataFrame,
    every: timedelta,
    time: str = "time",
    tie: Sequence[str] = ("trade_id",),
    scale: int | None = None,
) -> DataFrame:
    """Quote-currency bars: left label, both volumes, quote-weighted taker prices, and the
    distance from the bar end back to its last trade in microseconds."""
    kept = ["symbol", "date", "peg_symbol", "price", "quantity", "quote_quantity",
            "is_buyer_maker"]
    g = _grid(trades, every, time, tie, kept)
    p, q, qq = F.col("price"), F.col("quantity"), F.col("quote_quantity")
    buy = F.when(F.col("is_buyer_maker"), F.lit(0.0)).otherwise(qq)
    sell = F.when(F.col("is_buyer_maker"), qq).otherwise(F.lit(0.0))
    bars = g.groupBy("symbol", "date", "peg_symbol", "__bar").agg(
        F.min_by(p, "__ord").alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, "__ord").alias("close"),
        _sum(q, scale).alias("volume_base"),
        _sum(qq, scale).alias("volume_quote"),
        F.count(F.lit(1)).alias("trade_count"),
        F.max("__us").alias("__last"),
        _sum(buy, scale).alias("taker_buy_volume_quote"),
        _sum(sell, scale).alias("taker_sell_volume_quote"),
        _weighted(p, buy, scale).alias("vwap_taker_buy"),
        _weighted(p, sell, scale).alias("vwap_taker_sell"),
        _weighted(p, q, scale).alias("vwap_total_by_base"),
    )
    end = F.col("__bar") + F.lit(to_us(every))
    return bars.withColumns(
        {"actual_time_offset_us": end - F.col("__last"), "time": from_micros("__bar")}
    ).drop("__bar", "__last")
