"""Messages and streams, built row by row from ``events``."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from registry.base import (
    BAR_COLS, ORACLE, BARS10_SQL, M10, SCALE, query, table, ticks, tk_sql,
)
from tickframe.operators.tables import split_valid
from tickframe.session import scratch_path
from tickframe.streaming import messages as msg
from tickframe.streaming.recorder import Recorder
from tickframe.streaming.relay import relay, start_relay
from tickframe.streaming.universe import universe_changes
from tickframe.streaming.feeds import (
    LatestTable, as_text, current_values, drain, feed_health, file_sink, last_update, message_stream, stitch,
    streaming_bars, table_stream,
)

EV = "event_id"


def _ms(c: str = "ts") -> Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _wrap(spark, sf, channel: str, data: Column, where: str = "true") -> DataFrame:
    e = table(spark, sf, "events").where(where)
    return e.select(
        F.to_json(F.struct(F.lit(channel).alias("channel"), data.alias("data"))).alias("value"),
        F.col("ts").cast("timestamp").alias("received_time"),
    )


def _naive(df: DataFrame) -> DataFrame:
    """Instants shown as UTC wall time."""
    return df.select(
        *[F.col(f.name).cast("timestamp_ntz").alias(f.name)
          if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema]
    )


MS = "date_trunc('millisecond', ts)"


def trade_messages(spark, sf) -> DataFrame:
    """One or two trades per event; every third message holds two."""

    def one(shift: int) -> Column:
        return F.struct(
            F.col("event_type").alias("coin"),
            F.when(F.col(EV) % 2 == 0, "B").otherwise("A").alias("side"),
            _text(F.col("value") + shift).alias("px"), _text(F.col(EV) % 5).alias("sz"),
            _ms().alias("time"), (F.col(EV) + shift * 10_000_000).alias("tid"),
        )

    data = F.when(F.col(EV) % 3 == 0, F.array(one(0), one(1))).otherwise(F.array(one(0)))
    return _wrap(spark, sf, "trades", data)


TRADES_SQL = f"""t AS (
  SELECT event_type AS symbol, ts AS received_time, event_id AS trade_id, value AS price,
    CAST(event_id % 5 AS DOUBLE) AS size, {MS} AS trade_time, event_id % 2 = 0 AS is_buy
  FROM events
  UNION ALL
  SELECT event_type, ts, event_id + 10000000, value + 1, CAST(event_id % 5 AS DOUBLE), {MS},
    event_id % 2 = 0 FROM events WHERE event_id % 3 = 0)"""


@query(
    "parse_trades",
    f"WITH {TRADES_SQL} SELECT symbol, received_time, trade_id, round(price, 6) AS price, size, "
    "trade_time, is_buy FROM t WHERE size > 0",
)
def parse_trades(spark, sf):
    good, _ = split_valid(msg.trades(trade_messages(spark, sf)))
    return _naive(good)


@query(
    "parse_trades_rejected",
    f"WITH {TRADES_SQL} SELECT symbol, trade_id, size FROM t WHERE size <= 0",
)
def parse_trades_rejected(spark, sf):
    _, bad = split_valid(msg.trades(trade_messages(spark, sf)))
    return bad.select("symbol", "trade_id", "size")


def quote_messages(spark, sf) -> DataFrame:
    def side(px: Column, k: int, n: int) -> Column:
        return F.struct(
            _text(px).alias("px"), _text(F.col(EV) % k).alias("sz"),
            (F.col(EV) % n + 1).alias("n"),
        )

    ask = F.when(F.col(EV) % 13 != 0, side(F.col("value") + 0.5, 7, 4))
    data = F.struct(
        F.col("event_type").alias("coin"), _ms().alias("time"),
        F.array(side(F.col("value"), 5, 3), ask).alias("bbo"),
    )
    return _wrap(spark, sf, "bbo", data)


@query(
    "parse_bbo",
    f"""SELECT event_type AS symbol, ts AS received_time, {MS} AS time,
  round(value, 6) AS bid_price, CAST(event_id % 5 AS DOUBLE) AS bid_size,
  event_id % 3 + 1 AS bid_orders, round(value + 0.5, 6) AS ask_price,
  CAST(event_id % 7 AS DOUBLE) AS ask_size, event_id % 4 + 1 AS ask_orders
FROM events WHERE event_id % 13 <> 0""",
)
def parse_bbo(spark, sf):
    q, _ = msg.complete(msg.best_quotes(quote_messages(spark, sf)), "bid_price", "ask_price")
    return _naive(q)


def book_messages(spark, sf) -> DataFrame:
    """Bids fall and asks rise from the event's value; the depth depends on the event."""

    def side(sign: int, k: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), (F.col(EV) % k).cast("int")),
            lambda i: F.struct(
                _text(F.col("value") + sign * (i + 1) * 0.5).alias("px"),
                _text(i + 1).alias("sz"), (i + 2).cast("long").alias("n"),
            ),
        )

    data = F.struct(
        F.col("event_type").alias("coin"), _ms().alias("time"),
        F.array(side(-1, 4), side(1, 6)).alias("levels"),
    )
    return _wrap(spark, sf, "l2Book", data)


BOOK_SQL = f"""b AS (
  SELECT event_type AS symbol, ts AS received_time, {MS} AS time, true AS is_bid,
    unnest(range(event_id % 4 + 1)) AS d, value, event_id FROM events
  UNION ALL
  SELECT event_type, ts, {MS}, false, unnest(range(event_id % 6 + 1)), value, event_id
  FROM events)"""


@query(
    "parse_book_flat",
    f"""WITH {BOOK_SQL}
SELECT symbol, received_time, time, is_bid, CAST(d AS SMALLINT) AS depth,
  round(value + (CASE WHEN is_bid THEN -1 ELSE 1 END) * (d + 1) * 0.5, 6) AS price,
  CAST((d + 1) * (d + 2) / 2 AS DOUBLE) AS csize, CAST(d + 2 AS SMALLINT) AS num_orders
FROM b""",
)
def parse_book_flat(spark, sf):
    return _naive(msg.books_flat(book_messages(spark, sf)))


@query(
    "book_top_levels",
    """SELECT event_type AS symbol, ts AS received_time,
  CAST(least(event_id % 4 + 1, 3) AS INTEGER) AS n_bids,
  CAST(least(event_id % 6 + 1, 3) AS INTEGER) AS n_asks,
  round(value - 0.5, 6) AS best_bid, round(value + 0.5, 6) AS best_ask FROM events""",
)
def book_top_levels(spark, sf):
    b = msg.top_levels(msg.books(book_messages(spark, sf)), 3)
    return _naive(b.select(
        "symbol", "received_time", F.size("bid_levels").alias("n_bids"),
        F.size("ask_levels").alias("n_asks"),
        F.col("bid_levels")[0]["price"].alias("best_bid"),
        F.col("ask_levels")[0]["price"].alias("best_ask"),
    ))


@query(
    "parse_perp_context",
    """SELECT event_type AS symbol, ts AS received_time, round(value, 6) AS mark_price,
  CASE WHEN event_id % 2 = 0 THEN round(value + 0.25, 6) END AS mid_price,
  0.0125::DOUBLE AS funding_rate, CAST(event_id AS DOUBLE) AS open_interest,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id * 2 AS DOUBLE) END AS day_volume,
  round(value - 0.25, 6) AS oracle_price FROM events""",
)
def parse_perp_context(spark, sf):
    ctx = F.struct(
        _text("value").alias("markPx"),
        F.when(F.col(EV) % 2 == 0, _text(F.col("value") + 0.25)).alias("midPx"),
        F.lit("0.0125").alias("funding"), _text(EV).alias("openInterest"),
        F.when(F.col(EV) % 3 == 0, _text(F.col(EV) * 2)).alias("dayNtlVlm"),
        _text(F.col("value") - 0.25).alias("oraclePx"),
    )
    data = F.struct(F.col("event_type").alias("coin"), ctx.alias("ctx"))
    return _naive(msg.perp_contexts(_wrap(spark, sf, "activeAssetCtx", data)))


@query(
    "parse_spot_context",
    """SELECT event_type AS symbol, ts AS received_time, round(value, 6) AS mark_price,
  CASE WHEN event_id % 2 = 0 THEN round(value + 0.25, 6) END AS mid_price,
  CAST(event_id * 2 AS DOUBLE) AS day_volume,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id * 3 AS DOUBLE) END AS circulating_supply,
  CAST(event_id * 4 AS DOUBLE) AS total_supply FROM events""",
)
def parse_spot_context(spark, sf):
    ctx = F.struct(
        _text("value").alias("markPx"),
        F.when(F.col(EV) % 2 == 0, _text(F.col("value") + 0.25)).alias("midPx"),
        _text(F.col(EV) * 2).alias("dayNtlVlm"),
        F.when(F.col(EV) % 3 == 0, _text(F.col(EV) * 3)).alias("circulatingSupply"),
        _text(F.col(EV) * 4).alias("totalSupply"),
    )
    data = F.struct(F.col("event_type").alias("coin"), ctx.alias("ctx"))
    return _naive(msg.spot_contexts(_wrap(spark, sf, "activeSpotAssetCtx", data)))


@query(
    "parse_mids",
    """SELECT event_type AS symbol, ts AS received_time, round(value, 6) AS price FROM events
UNION ALL SELECT 'U' || user_id, ts, round(value + 1, 6) FROM events""",
)
def parse_mids(spark, sf):
    m = F.map_from_arrays(
        F.array(F.col("event_type"), F.concat(F.lit("U"), F.col("user_id"))),
        F.array(_text("value"), _text(F.col("value") + 1)),
    )
    return _naive(msg.mids(_wrap(spark, sf, "allMids", F.struct(m.alias("mids")))))


def _plain(spark, sf, *fields: Column) -> DataFrame:
    return table(spark, sf, "events").select(
        F.to_json(F.struct(*fields)).alias("value"),
        F.col("ts").cast("timestamp").alias("received_time"),
    )


@query(
    "parse_short_trades",
    f"""SELECT event_type AS symbol, {MS} + INTERVAL 5 MILLISECOND AS event_time,
  ts AS received_time, event_id AS trade_id, round(value, 6) AS price,
  CAST(event_id % 5 + 1 AS DOUBLE) AS size, event_id * 2 AS buyer_order_id,
  event_id * 2 + 1 AS seller_order_id, {MS} AS trade_time, event_id % 2 = 0 AS is_bid_quote
FROM events""",
)
def parse_short_trades(spark, sf):
    e = F.col(EV)
    return _naive(msg.short_trades(_plain(
        spark, sf, F.lit("trade").alias("e"), (_ms() + 5).alias("E"),
        F.col("event_type").alias("s"), e.alias("t"), _text("value").alias("p"),
        _text(e % 5 + 1).alias("q"), (e * 2).alias("b"), (e * 2 + 1).alias("a"),
        _ms().alias("T"), (e % 2 == 0).alias("m"), F.lit(True).alias("M"),
    )))


@query(
    "parse_short_tickers",
    """SELECT event_type AS symbol, ts AS received_time, event_id AS update_id,
  round(value, 6) AS bid_price, CAST(event_id % 5 AS DOUBLE) AS bid_size,
  round(value + 0.5, 6) AS ask_price, CAST(event_id % 7 AS DOUBLE) AS ask_size FROM events""",
)
def parse_short_tickers(spark, sf):
    e = F.col(EV)
    return _naive(msg.short_tickers(_plain(
        spark, sf, e.alias("u"), F.col("event_type").alias("s"), _text("value").alias("b"),
        _text(e % 5).alias("B"), _text(F.col("value") + 0.5).alias("a"),
        _text(e % 7).alias("A"),
    )))


def _strings(sign: int, k: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), (F.col(EV) % k).cast("int")),
        lambda i: F.array(_text(F.col("value") + sign * i), _text(i)),
    )


@query(
    "parse_depth_diffs",
    f"""SELECT event_type AS symbol, {MS} AS event_time, ts AS received_time,
  event_id AS first_update_id, event_id + 9 AS final_update_id,
  CAST(event_id % 3 + 1 AS INTEGER) AS n_bids, CAST(event_id % 5 + 1 AS INTEGER) AS n_asks,
  round(value - event_id % 3, 6) AS worst_bid, CAST(event_id % 5 AS DOUBLE) AS worst_ask_size,
  1 AS n_cleared FROM events""",
)
def parse_depth_diffs(spark, sf):
    d = msg.depth_diffs(_plain(
        spark, sf, F.col("event_type").alias("s"), _ms().alias("E"), F.col(EV).alias("U"),
        (F.col(EV) + 9).alias("u"), _strings(-1, 3).alias("b"), _strings(1, 5).alias("a"),
    ))
    return _naive(d.select(
        "symbol", "event_time", "received_time", "first_update_id", "final_update_id",
        F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"),
        F.element_at("bids", -1)["price"].alias("worst_bid"),
        F.element_at("asks", -1)["size"].alias("worst_ask_size"),
        F.size(F.filter("bids", lambda x: x["size"] == 0)).alias("n_cleared"),
    ))


@query(
    "parse_depth_snapshots",
    """SELECT ts AS received_time, event_id AS last_update_id,
  CAST(event_id % 3 + 1 AS INTEGER) AS n_bids, round(value, 6) AS best_ask FROM events""",
)
def parse_depth_snapshots(spark, sf):
    d = msg.depth_snapshots(_plain(
        spark, sf, F.col(EV).alias("lastUpdateId"), _strings(-1, 3).alias("bids"),
        _strings(1, 5).alias("asks"),
    ))
    return _naive(d.select(
        "received_time", "last_update_id", F.size("bids").alias("n_bids"),
        F.col("asks")[0]["price"].alias("best_ask"),
    ))


@query(
    "perp_universe",
    """SELECT 'S' || s_suppkey || '_PERP' AS symbol, 'S#' || s_suppkey AS exchange_symbol,
  3 AS size_decimals, CAST(s_suppkey % 50 AS INTEGER) AS max_leverage, false AS only_isolated
FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'T' || s_suppkey || '_PERP', 'T' || s_suppkey, 1, 20, true FROM supplier""",
)
def perp_universe(spark, sf):
    k = F.col("s_suppkey")
    first = F.struct(
        F.concat(F.lit("S#"), k).alias("name"), F.lit(3).alias("szDecimals"),
        (k % 50).cast("int").alias("maxLeverage"),
        F.when(k % 3 == 0, True).alias("isDelisted"), F.lit(None).cast("boolean").alias("onlyIsolated"),
    )
    second = F.struct(
        F.concat(F.lit("T"), k).alias("name"), F.lit(1).alias("szDecimals"),
        F.lit(20).alias("maxLeverage"), F.lit(False).alias("isDelisted"), F.lit(True).alias("onlyIsolated"),
    )
    m = table(spark, sf, "supplier").select(
        F.to_json(F.struct(F.array(first, second).alias("universe"))).alias("value")
    )
    return msg.perp_universe(m)


@query(
    "spot_universe",
    """SELECT 'A' || s_suppkey || '-USDC' AS symbol, '@' || s_suppkey AS exchange_symbol,
  s_suppkey AS pair_index, s_suppkey % 2 = 0 AS is_canonical FROM supplier""",
)
def spot_universe(spark, sf):
    k = F.col("s_suppkey")
    token = [
        F.struct(F.concat(F.lit("A/"), k).alias("name"), (k + 1).alias("index")),
        F.struct(F.lit("USDC").alias("name"), F.lit(0).cast("long").alias("index")),
    ]
    pair = F.struct(
        F.concat(F.lit("@"), k).alias("name"), F.array(k + 1, F.lit(0).cast("long")).alias("tokens"),
        k.alias("index"), (k % 2 == 0).alias("isCanonical"),
    )
    m = table(spark, sf, "supplier").select(
        F.to_json(F.struct(F.array(pair).alias("universe"), F.array(*token).alias("tokens")))
        .alias("value")
    )
    return msg.spot_universe(m)


def health_messages(spark, sf) -> DataFrame:
    one = F.struct(F.col("event_type").alias("coin"), _text("value").alias("px"))
    data = F.when(F.col(EV) % 3 == 0, F.array(one, one)).otherwise(F.array(one))
    good = F.to_json(F.struct(F.lit("trades").alias("channel"), data.alias("data")))
    text = (
        F.when(F.col(EV) % 50 == 0, '{"channel":"pong"}')
        .when(F.col(EV) % 51 == 0, "not json").otherwise(good)
    )
    return table(spark, sf, "events").select(
        text.alias("value"), F.col("ts").cast("timestamp").alias("received_time")
    )


HEALTH_SQL = """h AS (
  SELECT CASE WHEN event_id % 50 = 0 THEN 'pong' WHEN event_id % 51 = 0 THEN 'unreadable'
           ELSE 'trades' END AS channel, event_id FROM events)"""


@query(
    "feed_health",
    f"""WITH {HEALTH_SQL}, g AS (SELECT channel, count(*) AS n_messages,
  CAST(sum(CASE WHEN channel = 'trades' THEN 1 + (event_id % 3 = 0)::INT ELSE 0 END) AS BIGINT)
    AS n_trades FROM h GROUP BY channel)
SELECT channel, n_messages, n_trades, channel = 'pong' AS is_control,
  CASE WHEN channel = 'trades' THEN round(n_trades / n_messages, 6) END AS trades_per_message
FROM g""",
)
def health(spark, sf):
    return feed_health(health_messages(spark, sf))


@query("stream_health", ORACLE["feed_health"])
def stream_health(spark, sf):
    """The same messages as a stream of files, counted batch by batch in one pass."""
    folder, out = scratch_path(spark, "messages"), scratch_path(spark, "recorded")
    health_messages(spark, sf).select("value").repartition(4).write.text(folder)
    r = Recorder(spark, out, {"trades": ("trades", msg.trades)})
    drain(r.start(message_stream(spark, path=folder, maxFilesPerTrigger=2), f"{out}-checkpoint", every=None))
    return r.health()


@query(
    "stream_routed",
    f"""WITH {TRADES_SQL}, q AS (SELECT event_type AS symbol, value AS price FROM events)
SELECT 'trade' AS payload, symbol, count(*) AS n, round(sum(price), 4) AS price FROM t GROUP BY symbol
UNION ALL SELECT 'quote', symbol, count(*), round(sum(price), 4) FROM q GROUP BY symbol""",
    digits=4,
)
def stream_routed(spark, sf):
    """Trades and quotes in one stream of messages, each read once and routed to its table."""
    folder, out = scratch_path(spark, "messages"), scratch_path(spark, "routed")
    both = trade_messages(spark, sf).unionByName(quote_messages(spark, sf))
    both.select("value").repartition(4).write.text(folder)
    r = Recorder(spark, out, {"trade": ("trades", msg.trades), "quote": ("bbo", msg.best_quotes)})
    drain(r.start(message_stream(spark, path=folder, maxFilesPerTrigger=2), f"{out}-checkpoint", every=None))
    exact = lambda c: F.sum(F.col(c).cast("decimal(28, 6)")).cast("double").alias("price")
    parts = [
        r.read(p).groupBy(F.lit(p).alias("payload"), "symbol").agg(F.count(F.lit(1)).alias("n"), exact(c))
        for p, c in (("trade", "price"), ("quote", "bid_price"))
    ]
    return parts[0].union(parts[1])


UNIVERSE_SQL = """seen AS (SELECT DISTINCT event_type AS source, date_trunc('day', ts) AS time, 'u' || (user_id % 97) AS symbol FROM events),
times AS (SELECT source, time, row_number() OVER (PARTITION BY source ORDER BY time) AS k FROM (SELECT DISTINCT source, time FROM seen)),
s AS (SELECT source, k, symbol FROM seen JOIN times USING (source, time))"""


@query(
    "stream_text",
    f"""WITH {tk_sql()} SELECT symbol, count(*) AS n, round(sum(price), 4) AS price, min(trade_id) AS first, max(trade_id) AS last
FROM tk GROUP BY symbol""",
    digits=4,
)
def stream_text(spark, sf):
    """A typed stream seen as JSON text, stored, and typed again."""
    out = scratch_path(spark, "text")
    s = as_text(_tick_stream(spark, sf).select("symbol", "time", "price", "trade_id"))
    drain(file_sink(s, out, f"{out}-checkpoint", every=None))
    schema = "symbol string, time timestamp_ntz, price double, trade_id long"
    t = spark.read.parquet(out).select(F.from_json("value", schema).alias("r")).select("r.*")
    price = F.sum(F.col("price").cast("decimal(28, 6)")).cast("double")
    return t.groupBy("symbol").agg(
        F.count("time").alias("n"), price.alias("price"), F.min("trade_id").alias("first"), F.max("trade_id").alias("last")
    )


@query(
    "stream_universe_changes",
    f"""WITH {UNIVERSE_SQL},
added AS (SELECT n.source, n.k, n.symbol, 'added' AS change FROM s n ANTI JOIN s o ON o.source = n.source AND o.k = n.k - 1 AND o.symbol = n.symbol),
removed AS (SELECT o.source, o.k + 1 AS k, o.symbol, 'removed' AS change FROM s o ANTI JOIN s n ON o.source = n.source AND o.k = n.k - 1 AND o.symbol = n.symbol)
SELECT source, time, symbol, change FROM (SELECT * FROM added UNION ALL SELECT * FROM removed) JOIN times USING (source, k)""",
)
def stream_universe_changes(spark, sf):
    """A daily universe per event type: the users seen that day, in three micro-batches."""
    e = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.date_trunc("day", "ts").cast("timestamp").alias("time"),
        F.concat(F.lit("u"), F.col("user_id") % 97).alias("symbol"),
    )
    daily = e.groupBy("source", "time").agg(F.collect_set("symbol").alias("symbols"))
    end = e.agg((F.max("time") + F.expr("INTERVAL 60 DAYS")).alias("time")).select(F.lit("end").alias("source"), "time", F.array().cast("array<string>").alias("symbols"))
    folder, out = scratch_path(spark, "universes"), scratch_path(spark, "changes")
    daily.withColumn("part", F.floor(F.day("time") / 11)).repartition(3, "part").drop("part").write.parquet(folder)
    end.coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    s = universe_changes(table_stream(spark, folder, schema, files_per_trigger=2), "40 days")
    drain(start_relay(spark, lambda: file_sink(s, out, f"{out}-checkpoint", every=None)))
    return _naive(spark.read.parquet(out))


@query(
    "last_value",
    f"""WITH {tk_sql('user_id')} SELECT symbol, max(time) AS time,
  arg_max(price, time) AS price, arg_max(trade_id, time) AS trade_id FROM tk GROUP BY symbol""",
)
def last_value(spark, sf):
    t = ticks(spark, sf, "user_id").select("symbol", "time", "price", "trade_id")
    return current_values(t, ["symbol"], "time")


@query(
    "last_turn",
    """SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role FROM conversations
GROUP BY conv_id""",
)
def last_turn(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return current_values(c, ["conv_id"], "turn")


# ---- streams, drained to the end -------------------------------------------------------

def _tick_stream(spark, sf, closed: bool = False) -> DataFrame:
    """Events as a stream of trades; ``closed`` adds a row two days later that ends every bar."""
    schema = table(spark, sf, "events").schema
    if closed:
        folder = scratch_path(spark, "closed-events")
        e = table(spark, sf, "events")
        end = e.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts")).select(
            *[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        )
        e.union(end).write.parquet(folder)
        e = table_stream(spark, folder, schema)
    else:
        e = table_stream(spark, sf, schema, files="events.parquet")
    return e.select(
        F.col("event_type").alias("symbol"), F.col("ts").alias("time"),
        F.to_date("ts").alias("date"), F.lit("USD").alias("peg_symbol"),
        F.col("value").alias("price"), (1 + F.col(EV) % 7).cast("double").alias("quantity"),
        (F.col(EV) % 2 == 0).alias("is_buyer_maker"), F.col(EV).alias("trade_id"),
    )


@query(
    "stream_bars",
    f"WITH {BARS10_SQL} SELECT {BAR_COLS} FROM bars",
    digits=None,
)
def stream_bars(spark, sf):
    """All bars of a stream, closed by a row beyond the last watermark."""
    out = scratch_path(spark, "stream-bars")
    b = streaming_bars(_tick_stream(spark, sf, closed=True), M10, "1 hour", scale=SCALE)
    drain(file_sink(b, out, f"{out}-checkpoint", every=None))
    return spark.read.parquet(out)


@query("stitched_stream", "SELECT event_id, event_type AS symbol, value FROM events")
def stitched_stream(spark, sf):
    schema = table(spark, sf, "events").schema

    def source() -> DataFrame:
        return table_stream(spark, sf, schema, files="events.parquet").select(
            EV, F.col("event_type").alias("symbol"), "value", "ts"
        )

    out = scratch_path(spark, "stitched")
    s = stitch({1: source(), 2: source()}, [EV], "ts", "1 hour").drop("ts")
    drain(file_sink(s, out, f"{out}-checkpoint", every=None))
    return spark.read.parquet(out)


@query(
    "stitched_switch",
    """WITH ends AS (SELECT event_type AS symbol, epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last FROM events GROUP BY event_type)
SELECT event_id, event_type AS symbol, ts AS time, value,
  CAST(CASE WHEN epoch_us(ts) >= first + 7 * ((last - first) // 10) THEN 3
            WHEN epoch_us(ts) >= first + 4 * ((last - first) // 10) THEN 2 ELSE 1 END AS INTEGER) AS version
FROM events JOIN ends ON event_type = symbol""",
)
def stitched_switch(spark, sf):
    """Three versions of one feed, each with gaps outside its turn; per symbol, the control
    stream hands over at 0.4 and 0.7 of the symbol's time. Both sources run on around a switch."""
    e = table(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = e.groupBy(F.col("event_type").alias("symbol")).agg(F.min(us).alias("first"), F.max(us).alias("last"))
    tenth = F.floor((F.col("last") - F.col("first")) / 10).cast("long")
    at = lambda k: F.col("first") + k * tenth
    switches = ends.select("symbol", F.explode(F.array(*[
        F.struct(F.timestamp_micros(at(k)).alias("time"), F.lit(v).alias("version")) for k, v in ((0, 1), (4, 2), (7, 3))
    ])).alias("s")).select("symbol", "s.*")
    # Two days after the last row, one more switch of no symbol's: time goes on, and all rows come out.
    end = e.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).cast("timestamp").alias("time"))
    control = scratch_path(spark, "switches")
    switches.unionByName(end.select(F.lit("").alias("symbol"), "time", F.lit(1).alias("version"))).write.parquet(control)
    feeds = {}
    for v, (a, b) in {1: (-1, 5), 2: (3, 8), 3: (6, 11)}.items():
        path = scratch_path(spark, f"feed-{v}")
        rows = e.select(EV, F.col("event_type").alias("symbol"), F.col("ts").alias("time"), "value").join(ends, "symbol")
        rows = rows.where(F.unix_micros(F.col("time").cast("timestamp")).between(at(a), at(b)))
        rows.select(EV, "symbol", "time", "value").write.parquet(path)
        feeds[v] = table_stream(spark, path, spark.read.parquet(path).schema)
    s = relay(feeds, table_stream(spark, control, spark.read.parquet(control).schema), [EV], "time", "1 day", parts=2)
    out = scratch_path(spark, "switched")
    drain(start_relay(spark, lambda: file_sink(s, out, f"{out}-checkpoint", every=None)))
    return spark.read.parquet(out)


@query(
    "stream_last_value",
    f"""WITH {tk_sql()} SELECT symbol, max(time) AS time, arg_max(price, time) AS price
FROM tk GROUP BY symbol""",
)
def stream_last_value(spark, sf):
    """Over several micro-batches, of which each one rewrites the buckets of its symbols only."""
    days = scratch_path(spark, "days")
    t = ticks(spark, sf).select("symbol", "time", "price", (F.day("date") % 4).alias("part"))
    t.repartition(4, "part").drop("part").write.parquet(days)
    out = scratch_path(spark, "latest")
    s = table_stream(spark, days, t.drop("part").schema, files_per_trigger=1)
    latest = LatestTable(spark, out, ["symbol"], "time", buckets=16)
    drain(latest.start(current_values(s, ["symbol"], "time"), f"{out}-checkpoint", every=None))
    return latest.read()


@query(
    "stream_last_update",
    f"WITH {tk_sql()} SELECT symbol, max(time) AS last_update FROM tk GROUP BY symbol",
)
def stream_last_update(spark, sf):
    out = scratch_path(spark, "updates")
    s = last_update(_tick_stream(spark, sf), ["symbol"], "time")
    t = LatestTable(spark, out, ["symbol"], "last_update")
    drain(t.start(s, f"{out}-checkpoint", every=None))
    return t.read()
