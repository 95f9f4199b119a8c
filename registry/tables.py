"""Filters, universes, lookups, top-N, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query, table, tick_splits, ticks, tk_sql
from tickframe.functions import text
from tickframe.functions.numbers import (
    change_pct, parse_number, valid_price, valid_size, valid_symbol,
)
from tickframe.functions.times import from_micros, futures_stamp_us, micros, spot_stamp_us
from tickframe.operators.asof import order_position
from tickframe.operators.ranks import head, nearest, seeded_sample, tail, top_n
from tickframe.operators.scans import forward_fill, running_sums
from tickframe.operators.tables import (
    Ranges, column_ranges, histogram, known_symbols, map_symbol, missing_pairs, pair_symbols,
    pairs_with_token, split_valid, staleness, universe_changes, zip_positions,
)
from tickframe.sources.listing import keys_to_universe, universe_between


@query(
    "universe",
    f"WITH {tk_sql('user_id')} SELECT DISTINCT symbol, date FROM tk "
    "WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
)
def universe(spark, sf):
    u = ticks(spark, sf, "user_id").select("symbol", "date").distinct()
    return universe_between(u, "2024-01-05", "2024-01-20")


@query(
    "universe_from_keys",
    f"WITH {tk_sql('user_id')} SELECT DISTINCT 'U' || symbol AS symbol, date FROM tk",
)
def universe_from_keys(spark, sf):
    t = ticks(spark, sf, "user_id")
    key = F.format_string(
        "data/spot/daily/trades/U%s/U%s-trades-%s.zip", "symbol", "symbol",
        F.date_format("date", "yyyy-MM-dd"),
    )
    keys = t.select(
        F.explode(F.array(key, F.concat(key, F.lit(".CHECKSUM")))).alias("key")
    )
    return keys_to_universe(keys)


@query(
    "missing_pairs",
    f"WITH {tk_sql('user_id')}, u AS (SELECT DISTINCT symbol, date FROM tk) "
    "SELECT symbol, date FROM u WHERE day(date) % 2 = 1",
)
def missing(spark, sf):
    u = ticks(spark, sf, "user_id").select("symbol", "date")
    return missing_pairs(u, u.where("day(date) % 2 = 0"))


@query(
    "universe_diff",
    f"""WITH {tk_sql('user_id')},
a AS (SELECT DISTINCT symbol FROM tk WHERE date = DATE '2024-01-04'),
b AS (SELECT DISTINCT symbol FROM tk WHERE date = DATE '2024-01-27')
SELECT symbol, 'removed' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT symbol, 'added' AS change FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def universe_diff(spark, sf):
    t = ticks(spark, sf, "user_id")
    return universe_changes(
        t.where("date = DATE'2024-01-04'"), t.where("date = DATE'2024-01-27'")
    )


@query(
    "symbol_gate",
    "SELECT event_id, user_id FROM events WHERE user_id IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def symbol_gate(spark, sf):
    known = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return known_symbols(
        table(spark, sf, "events").select("event_id", "user_id"),
        known.select(F.col("c_custkey").alias("user_id")), "user_id",
    )


@query(
    "filter_ranges",
    "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice >= 100000 "
    "AND o_totalprice <= 300000 AND o_orderdate <= TIMESTAMP '1997-06-30'",
)
def filter_ranges(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    r = (
        Ranges().with_range("o_totalprice", 0.0, 1.0).with_range("o_custkey", 5, None)
        .with_range("o_totalprice", 100000.0, 300000.0).without("o_custkey")
        .with_range("o_orderdate", None, "1997-06-30")
    )
    return r.apply(o)


@query(
    "retention",
    "SELECT count(*) FILTER (WHERE o_totalprice BETWEEN 100000 AND 300000) AS kept_rows, "
    "count(*) AS total_rows, round(count(*) FILTER (WHERE o_totalprice BETWEEN 100000 AND "
    "300000) / count(*), 6) AS kept_share FROM orders",
)
def retention(spark, sf):
    return Ranges({"o_totalprice": (100000.0, 300000.0)}).retention(table(spark, sf, "orders"))


@query(
    "normalise_ts",
    """WITH s AS (SELECT event_id, epoch_us(ts) + (event_id % 3 - 1) * 31536000000000 AS us
  FROM events),
r AS (SELECT event_id, us, CASE WHEN us >= 1735689600000000 AND event_id % 2 = 0 THEN us
  ELSE us // 1000 END AS stamp FROM s)
SELECT event_id, stamp, make_timestamp(CASE WHEN stamp >= 10000000000000 THEN stamp
  ELSE stamp * 1000 END) AS spot_time,
  make_timestamp((us // 1000) * 1000) AS futures_time FROM r""",
)
def normalise_ts(spark, sf):
    us = micros("ts") + (F.col("event_id") % 3 - 1) * F.lit(31_536_000_000_000)
    e = table(spark, sf, "events").select("event_id", us.alias("us"))
    ms = F.floor(F.col("us") / 1000).cast("long")
    late = (F.col("us") >= F.lit(1_735_689_600_000_000)) & (F.col("event_id") % 2 == 0)
    r = e.withColumn("ms", ms).withColumn("stamp", F.when(late, F.col("us")).otherwise(F.col("ms")))
    return r.select(
        "event_id", "stamp", from_micros(spot_stamp_us("stamp")).alias("spot_time"),
        from_micros(futures_stamp_us("ms")).alias("futures_time"),
    )


@query(
    "histogram",
    """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
g AS (SELECT unnest(range(20)) AS bin),
c AS (SELECT least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin,
        count(*) AS n FROM orders, b GROUP BY 1)
SELECT 'o_totalprice' AS "column", CAST(g.bin AS INTEGER) AS bin,
  round(lo + g.bin * ((hi - lo) / 20), 4) AS bin_start,
  round(lo + (g.bin + 1) * ((hi - lo) / 20), 4) AS bin_end, coalesce(c.n, 0) AS "count"
FROM g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin""",
    digits=4,
)
def histogram_price(spark, sf):
    return histogram(table(spark, sf, "orders"), ["o_totalprice"], 20)


@query(
    "column_ranges",
    "SELECT 'o_orderkey' AS \"column\", CAST(min(o_orderkey) AS VARCHAR) AS min, "
    "CAST(max(o_orderkey) AS VARCHAR) AS max FROM orders UNION ALL "
    "SELECT 'o_orderdate', strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'), "
    "strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders",
)
def ranges_of_columns(spark, sf):
    return column_ranges(table(spark, sf, "orders"), ["o_orderkey", "o_orderdate"])


VOLUME_SQL = """v AS (
  SELECT p_name AS name, sum(l_extendedprice) AS volume FROM lineitem
  JOIN part ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY p_partkey, p_name)"""


def _part_volume(spark, sf):
    li = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_extendedprice").alias("volume")
    )
    p = table(spark, sf, "part")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey"), F.col("p_name").alias("name"), "volume", (F.col("p_size") > 10).alias("active")
    )


@query(
    "top_volume",
    f"""WITH v AS (
  SELECT p_partkey, p_name AS name, sum(l_extendedprice) AS volume FROM lineitem
  JOIN part ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY p_partkey, p_name)
SELECT p_partkey, name, round(volume, 2) AS volume FROM v WHERE volume > 0
ORDER BY v.volume DESC, p_partkey LIMIT 10""",
    digits=2,
)
def top_volume(spark, sf):
    v = _part_volume(spark, sf)
    return top_n(v, "volume", 10, ["p_partkey"], active=F.col("active")).drop("active")


@query(
    "top_volume_min",
    """WITH v AS (
  SELECT l_suppkey, l_partkey % 25 AS token, sum(l_extendedprice) AS volume FROM lineitem
  GROUP BY l_suppkey, l_partkey % 25),
n AS (SELECT v.*, s.s_nationkey, a.n_name AS base, b.n_name AS quote FROM v
  JOIN supplier s ON l_suppkey = s_suppkey
  LEFT JOIN nation a ON a.n_nationkey = s.s_nationkey
  LEFT JOIN nation b ON b.n_nationkey = v.token)
SELECT l_suppkey, token, round(volume, 2) AS volume,
  regexp_replace(base, '[^A-Za-z0-9_-]', '', 'g') || '/' ||
  regexp_replace(quote, '[^A-Za-z0-9_-]', '', 'g') AS symbol
FROM n WHERE volume >= 100000 ORDER BY n.volume DESC, l_suppkey, token LIMIT 20""",
    digits=2,
)
def top_volume_min(spark, sf):
    v = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", (F.col("l_partkey") % 25).alias("token"))
        .agg(F.sum("l_extendedprice").alias("volume"))
    )
    v = v.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    top = top_n(v, "volume", 20, ["l_suppkey", "token"], minimum=100000.0)
    pairs = top.select(
        "l_suppkey", "token", "volume",
        F.array(F.col("s_nationkey").cast("long"), F.col("token")).alias("tokens"),
    )
    tokens = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("index"), F.col("n_name").alias("name")
    )
    return pair_symbols(pairs, tokens, "/").select("l_suppkey", "token", "volume", "symbol")


@query(
    "pairs_by_token",
    """WITH p AS (SELECT s_nationkey AS a, CAST(l_partkey % 25 AS INTEGER) AS b,
    sum(l_quantity) AS volume FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY 1, 2),
q AS (SELECT a || ':' || b AS pair, a, b, volume FROM p WHERE a <> b),
legs AS (SELECT pair, a AS i, b AS o, volume FROM q UNION ALL
         SELECT pair, b AS i, a AS o, volume FROM q),
r AS (SELECT n.n_name AS token, pair, m.n_name AS other_token, volume,
        row_number() OVER (PARTITION BY n.n_name ORDER BY volume DESC, pair) AS rank
      FROM legs JOIN nation n ON n.n_nationkey = i JOIN nation m ON m.n_nationkey = o)
SELECT token, rank, pair, other_token, volume FROM r WHERE rank <= 5""",
)
def pairs_by_token(spark, sf):
    li = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    p = (
        li.groupBy("s_nationkey", (F.col("l_partkey") % 25).cast("int").alias("b"))
        .agg(F.sum("l_quantity").alias("volume")).where("s_nationkey <> b")
    )
    pairs = p.select(
        F.concat_ws(":", "s_nationkey", "b").alias("name"),
        F.array("s_nationkey", "b").alias("tokens"), "volume",
    )
    tokens = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("index"), F.col("n_name").alias("name")
    )
    return pairs_with_token(pairs, tokens)


@query(
    "map_symbols",
    "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN upper(event_type) || '_PERP'"
    " ELSE event_type END AS symbol FROM events",
)
def map_symbols(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("event_type").alias("symbol"))
    names = e.where("symbol IN ('click', 'view')").select("symbol").distinct()
    mapping = names.select("symbol", text.perp_name(F.upper("symbol")).alias("normal"))
    return map_symbol(e, mapping, "symbol", "symbol", "normal")


@query(
    "zip_positions",
    """WITH o AS (SELECT p_partkey, string_split(p_name, ' ') AS p, string_split(p_type, '_') AS q
  FROM part)
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, p[i] AS name, q[i] AS ctx
FROM (SELECT *, unnest(range(1, least(len(p), len(q)) + 1)) AS i FROM o)""",
)
def zipped(spark, sf):
    o = table(spark, sf, "part").select(
        "p_partkey", F.split("p_name", " ").alias("p"), F.split("p_type", "_").alias("q")
    )
    return zip_positions(o, "p", "q", ("name", "ctx"))


@query(
    "row_validity",
    """WITH t AS (SELECT event_id,
  CASE WHEN event_id % 17 = 0 THEN '' ELSE event_type END AS symbol,
  CASE event_id % 11 WHEN 0 THEN '-1.5' WHEN 1 THEN 'abc' WHEN 2 THEN '1.5e3'
    WHEN 3 THEN ' 2.5' ELSE CAST(value AS VARCHAR) END AS px,
  CAST(event_id % 7 AS DOUBLE) AS size FROM events),
p AS (SELECT *, CASE WHEN px = trim(px) THEN TRY_CAST(px AS DOUBLE) END AS price FROM t)
SELECT event_id, price, size,
  (length(symbol) > 0 AND coalesce(price >= 0, false) AND size > 0) AS ok FROM p""",
)
def row_validity(spark, sf):
    m = F.col("event_id") % 11
    t = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 17 == 0, "").otherwise(F.col("event_type")).alias("symbol"),
        parse_number(
            F.when(m == 0, "-1.5").when(m == 1, "abc").when(m == 2, "1.5e3")
            .when(m == 3, " 2.5").otherwise(F.col("value").cast("string"))
        ).alias("price"),
        (F.col("event_id") % 7).cast("double").alias("size"),
    )
    good, bad = split_valid(t)
    both = good.withColumn("ok", F.lit(True)).unionByName(bad.withColumn("ok", F.lit(False)))
    return both.drop("symbol")


@query(
    "running_by_key",
    f"""WITH {tk_sql()} SELECT symbol, trade_id,
  sum(quantity) OVER w AS volume_so_far,
  last_value(CASE WHEN trade_id % 5 = 0 THEN price END IGNORE NULLS) OVER w AS last_fifth
FROM tk WINDOW w AS (PARTITION BY symbol ORDER BY time, trade_id ROWS UNBOUNDED PRECEDING)""",
)
def running_by_key(spark, sf):
    t = ticks(spark, sf).select("symbol", "trade_id", "time", "quantity", "price")
    pos, tie, s = order_position(micros("time"), False), F.col("trade_id"), tick_splits(spark, sf)
    r = running_sums(t, ["symbol"], pos, {"volume_so_far": F.col("quantity")}, tie, s)
    r = forward_fill(
        r, ["symbol"], pos,
        {"last_fifth": F.when(F.col("trade_id") % 5 == 0, F.col("price"))}, tie, s,
    )
    return r.select("symbol", "trade_id", "volume_so_far", "last_fifth")


@query(
    "nearest_rows",
    """WITH t AS (SELECT unnest([0.0, 50.0, 123.456, 1000.0]::DOUBLE[]) AS target,
  unnest([0, 1, 2, 3]) AS target_no)
SELECT t.target_no, t.target,
  (SELECT first(event_id ORDER BY abs(value - t.target), value, event_id) FROM events) AS event_id,
  (SELECT first(value ORDER BY abs(value - t.target), value, event_id) FROM events) AS value
FROM t""",
)
def nearest_rows(spark, sf):
    e = table(spark, sf, "events")
    return nearest(e, "value", [0.0, 50.0, 123.456, 1000.0], ["event_id", "value"], ["event_id"])


@query("head_rows", "SELECT event_id, value FROM events ORDER BY value, event_id LIMIT 25")
def head_rows(spark, sf):
    return head(table(spark, sf, "events").select("event_id", "value"), 25, ["value", "event_id"])


@query(
    "tail_rows", "SELECT event_id, value FROM events ORDER BY value DESC, event_id DESC LIMIT 25"
)
def tail_rows(spark, sf):
    return tail(table(spark, sf, "events").select("event_id", "value"), 25, ["value", "event_id"])


@query(
    "sample_rows",
    "SELECT event_id, value FROM events ORDER BY md5(event_id || '|7'), event_id LIMIT 2000",
)
def sample_rows(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return seeded_sample(e, 2000, seed=7, key=["event_id"], order=["value", "event_id"])


@query(
    "day_change",
    f"""WITH {tk_sql()}, d AS (
  SELECT symbol, date, first(price ORDER BY time, trade_id) AS prev,
         last(price ORDER BY time, trade_id) AS mark FROM tk GROUP BY symbol, date)
SELECT symbol, date, round((mark / nullif(prev, 0) - 1) * 100, 6) AS change_pct FROM d""",
)
def day_change(spark, sf):
    at = F.struct("time", "trade_id")
    d = ticks(spark, sf).groupBy("symbol", "date").agg(
        F.min_by("price", at).alias("prev"), F.max_by("price", at).alias("mark")
    )
    return d.select("symbol", "date", change_pct("mark", "prev").alias("change_pct"))


@query(
    "names_and_labels",
    """SELECT event_id, regexp_replace(props, '[^A-Za-z0-9_-]', '', 'g') AS clean,
  event_type || '_PERP' AS perp, event_type || '-USDC' AS pair,
  CAST(ts AS DATE) AS found_date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_label,
  printf('%.2f', value) AS value_label,
  regexp_matches(props, '^[A-Za-z0-9_/-]+$') AS name_ok, length(event_type) AS n_chars
FROM events""",
)
def names_and_labels(spark, sf):
    e = table(spark, sf, "events")
    file = F.concat(F.lit("x-trades-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".zip"))
    return e.select(
        "event_id", text.clean_symbol("props").alias("clean"),
        text.perp_name("event_type").alias("perp"),
        text.pair_name(F.col("event_type"), F.lit("USDC")).alias("pair"),
        text.date_in(file).alias("found_date"), text.label("ts", "timestamp").alias("time_label"),
        text.label("value", "float").alias("value_label"),
        text.valid_stream_name("props").alias("name_ok"),
        F.char_length("event_type").alias("n_chars"),
    )


@query(
    "staleness",
    f"""WITH {tk_sql()} SELECT symbol, max(time) AS last_update,
  epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(time)) AS staleness_us FROM tk GROUP BY symbol""",
)
def stale(spark, sf):
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    return staleness(ticks(spark, sf), ["symbol"], "time", now)
