"""Exchange JSON messages to typed rows. Every transform works on batch and streaming frames.

Input: a text column and, optionally, ``received_time``. Each parser returns all messages of
its channel; ``split_valid`` / ``complete`` separate the ones to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickframe.functions.numbers import parse_number
from tickframe.functions.text import clean_symbol, perp_name
from tickframe.schema import (
    BBO_JSON, BOOK_JSON, ENVELOPE_JSON, MIDS_JSON, PERP_CONTEXT_JSON, PERP_META_JSON,
    SHORT_DEPTH_JSON, SHORT_DIFF_KEYS, SHORT_TICKER_KEYS, SHORT_TRADE_KEYS, SPOT_CONTEXT_JSON,
    SPOT_META_JSON, TRADES_JSON,
)

# Channel names of the enveloped feed.
TRADES, BBO, BOOK = "trades", "bbo", "l2Book"
PERP_CONTEXT, SPOT_CONTEXT, MIDS = "activeAssetCtx", "activeSpotAssetCtx", "allMids"
CONTROL = ("subscriptionResponse", "pong")


def _received(df: DataFrame) -> Column:
    if "received_time" in df.columns:
        return F.col("received_time")
    return F.current_timestamp().alias("received_time")


def envelope(df: DataFrame, text: str = "value") -> DataFrame:
    """channel, data (JSON text) and received_time of each message."""
    return df.select(_received(df), F.json_tuple(text, "channel", "data").alias("channel", "data"))


def _parsed(df: DataFrame, keep: list, text: str, schema: str) -> DataFrame:
    """Fields of one JSON object as columns.

    The generator keeps the optimizer from copying the parse into every filter and field that
    uses it, so each message is parsed once.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def _channel(df: DataFrame, text: str, channel: str, schema: str) -> DataFrame:
    e = envelope(df, text).where(F.col("channel") == channel)
    return _parsed(e, ["received_time"], "data", schema)


def trades(df: DataFrame, text: str = "value") -> DataFrame:
    """All trades of each message, each with its own symbol."""
    e = envelope(df, text).where(F.col("channel") == TRADES)
    t = e.select("received_time", F.inline(F.from_json("data", TRADES_JSON)))
    return t.select(
        F.col("coin").alias("symbol"), "received_time", F.col("tid").alias("trade_id"),
        parse_number("px").alias("price"), parse_number("sz").alias("size"),
        F.timestamp_millis("time").alias("trade_time"),
        (F.col("side") == "B").alias("is_buy"),
    )


def best_quotes(df: DataFrame, text: str = "value") -> DataFrame:
    """Best bid and offer; a side the message lacks gives NULLs."""
    d = _channel(df, text, BBO, BBO_JSON)
    bid, ask = F.get("bbo", F.lit(0)), F.get("bbo", F.lit(1))
    return d.select(
        F.col("coin").alias("symbol"), "received_time",
        F.timestamp_millis("time").alias("time"),
        parse_number(bid["px"]).alias("bid_price"), parse_number(bid["sz"]).alias("bid_size"),
        bid["n"].alias("bid_orders"),
        parse_number(ask["px"]).alias("ask_price"), parse_number(ask["sz"]).alias("ask_size"),
        ask["n"].alias("ask_orders"),
    )


def complete(df: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """(rows with all required columns present, the others)."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.where(ok), df.where(~ok)


def _levels(side: Column) -> Column:
    return F.transform(
        side,
        lambda x: F.struct(
            parse_number(x["px"]).alias("price"), parse_number(x["sz"]).alias("size"),
            x["n"].alias("n_orders"),
        ),
    )


def books(df: DataFrame, text: str = "value") -> DataFrame:
    """Book snapshots with nested level arrays; two sides required."""
    d = _channel(df, text, BOOK, BOOK_JSON).where(F.size("levels") == 2)
    return d.select(
        F.col("coin").alias("symbol"), "received_time",
        F.timestamp_millis("time").alias("time"),
        _levels(F.get("levels", F.lit(0))).alias("bid_levels"),
        _levels(F.get("levels", F.lit(1))).alias("ask_levels"),
    )


def books_flat(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per level with its depth and the cumulative size of its side."""
    d = _channel(df, text, BOOK, BOOK_JSON).where(F.size("levels") == 2)
    return flat_levels(
        d.select(
            F.col("coin").alias("symbol"), "received_time",
            F.timestamp_millis("time").alias("time"), F.col("levels").alias("levels"),
        )
    )


def flat_levels(df: DataFrame) -> DataFrame:
    """symbol, received_time, time, levels (bids, asks) to one row per level.

    The running sizes are built once per side, inside the row: no shuffle.
    """
    sides = df.select(
        "symbol", "received_time", "time", F.posexplode("levels").alias("side_no", "side")
    )
    sizes = F.transform("side", lambda x: parse_number(x["sz"]))
    running = F.aggregate(
        sizes, F.array(F.lit(0.0)), lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x)
    )
    # Exploding the side itself: Spark also evaluates what it explodes in a filter before.
    s = sides.withColumn("running", running).select("*", F.posexplode("side").alias("depth", "level"))
    s = s.withColumn("csize", F.col("running")[F.col("depth") + 1])
    return s.select(
        "symbol", "received_time", "time", (F.col("side_no") == 0).alias("is_bid"),
        F.col("depth").cast("smallint").alias("depth"),
        parse_number("level.px").alias("price"),
        "csize",
        F.col("level.n").cast("smallint").alias("num_orders"),
    )


def top_levels(df: DataFrame, k: int = 3) -> DataFrame:
    """The best k levels of both sides of a nested book."""
    return df.withColumns(
        {s: F.slice(s, 1, k) for s in ("bid_levels", "ask_levels")}
    )


def perp_contexts(df: DataFrame, text: str = "value") -> DataFrame:
    d = _channel(df, text, PERP_CONTEXT, PERP_CONTEXT_JSON)
    return d.select(
        F.col("coin").alias("symbol"), "received_time",
        parse_number("ctx.markPx").alias("mark_price"),
        parse_number("ctx.midPx").alias("mid_price"),
        parse_number("ctx.funding").alias("funding_rate"),
        parse_number("ctx.openInterest").alias("open_interest"),
        parse_number("ctx.dayNtlVlm").alias("day_volume"),
        parse_number("ctx.oraclePx").alias("oracle_price"),
    )


def spot_contexts(df: DataFrame, text: str = "value") -> DataFrame:
    d = _channel(df, text, SPOT_CONTEXT, SPOT_CONTEXT_JSON)
    return d.select(
        F.col("coin").alias("symbol"), "received_time",
        parse_number("ctx.markPx").alias("mark_price"),
        parse_number("ctx.midPx").alias("mid_price"),
        parse_number("ctx.dayNtlVlm").alias("day_volume"),
        parse_number("ctx.circulatingSupply").alias("circulating_supply"),
        parse_number("ctx.totalSupply").alias("total_supply"),
    )


def mids(df: DataFrame, text: str = "value") -> DataFrame:
    d = _channel(df, text, MIDS, MIDS_JSON)
    return d.select("received_time", F.explode("mids").alias("symbol", "px")).select(
        "symbol", "received_time", parse_number("px").alias("price")
    )


def _pairs(side: str) -> Column:
    return F.transform(
        side,
        lambda x: F.struct(
            parse_number(F.get(x, F.lit(0))).alias("price"),
            parse_number(F.get(x, F.lit(1))).alias("size"),
        ),
    )


def _letters(df: DataFrame, text: str, keys: str) -> DataFrame:
    """Top-level fields of single-letter messages as text columns f0, f1, ...

    Keys may differ by case only, which a struct cannot tell apart; a tuple parse can.
    """
    names = keys.split()
    return df.select(_received(df), F.json_tuple(text, *names).alias(*[f"f{i}" for i in range(len(names))]))


def _whole(c: str) -> Column:
    return F.col(c).try_cast("bigint")


def short_trades(df: DataFrame, text: str = "value") -> DataFrame:
    """Single-letter trade messages. The trade time is the trade's own stamp."""
    d = _letters(df, text, SHORT_TRADE_KEYS)
    return d.select(
        F.col("f0").alias("symbol"), F.timestamp_millis(_whole("f1")).alias("event_time"),
        "received_time", _whole("f2").alias("trade_id"),
        parse_number("f3").alias("price"), parse_number("f4").alias("size"),
        _whole("f5").alias("buyer_order_id"), _whole("f6").alias("seller_order_id"),
        F.timestamp_millis(_whole("f7")).alias("trade_time"),
        F.col("f8").try_cast("boolean").alias("is_bid_quote"),
    )


def short_tickers(df: DataFrame, text: str = "value") -> DataFrame:
    d = _letters(df, text, SHORT_TICKER_KEYS)
    return d.select(
        F.col("f1").alias("symbol"), "received_time", _whole("f0").alias("update_id"),
        parse_number("f2").alias("bid_price"), parse_number("f3").alias("bid_size"),
        parse_number("f4").alias("ask_price"), parse_number("f5").alias("ask_size"),
    )


def depth_diffs(df: DataFrame, text: str = "value") -> DataFrame:
    """Level changes; size zero clears a level."""
    d = _letters(df, text, SHORT_DIFF_KEYS)
    sides = {c: F.from_json(c, "array<array<string>>") for c in ("f4", "f5")}
    return d.withColumns(sides).select(
        F.col("f0").alias("symbol"), F.timestamp_millis(_whole("f1")).alias("event_time"),
        "received_time", _whole("f2").alias("first_update_id"),
        _whole("f3").alias("final_update_id"),
        _pairs("f4").alias("bids"), _pairs("f5").alias("asks"),
    )


def depth_snapshots(df: DataFrame, text: str = "value") -> DataFrame:
    keep = [c for c in ("symbol",) if c in df.columns]
    d = _parsed(df, [*keep, _received(df)], text, SHORT_DEPTH_JSON)
    return d.select(
        *keep, "received_time", F.col("lastUpdateId").alias("last_update_id"),
        _pairs("bids").alias("bids"), _pairs("asks").alias("asks"),
    )


def perp_universe(df: DataFrame, text: str = "value") -> DataFrame:
    """Perpetuals that are not delisted: exchange name and normal name."""
    u = df.select(F.inline(F.from_json(text, PERP_META_JSON)["universe"]))
    u = u.where(~F.coalesce("isDelisted", F.lit(False)))
    return u.select(
        perp_name("name").alias("symbol"), F.col("name").alias("exchange_symbol"),
        F.col("szDecimals").alias("size_decimals"), F.col("maxLeverage").alias("max_leverage"),
        F.coalesce("onlyIsolated", F.lit(False)).alias("only_isolated"),
    )


def spot_universe(df: DataFrame, text: str = "value") -> DataFrame:
    """Spot pairs with the names of their two tokens resolved.

    Both sides come from the same message, so the token names are looked up in a map built
    inside the row.
    """
    m = df.select(F.from_json(text, SPOT_META_JSON).alias("m"))
    names = F.map_from_entries(
        F.transform("m.tokens", lambda t: F.struct(t["index"], t["name"]))
    )
    p = m.select(names.alias("names"), F.explode("m.universe").alias("p"))
    token = [F.try_element_at("names", F.get("p.tokens", F.lit(i))) for i in (0, 1)]
    return p.select(
        F.concat(clean_symbol(token[0]), F.lit("-"), clean_symbol(token[1])).alias("symbol"),
        F.col("p.name").alias("exchange_symbol"), F.col("p.index").alias("pair_index"),
        F.coalesce("p.isCanonical", F.lit(False)).alias("is_canonical"),
    )


def quarantine(df: DataFrame, text: str = "value") -> DataFrame:
    """Messages without a readable envelope."""
    bad = F.from_json(text, ENVELOPE_JSON)["channel"].isNull()
    return df.where(bad)
