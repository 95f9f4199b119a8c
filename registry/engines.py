"""As-of joins, returns, rolling metadata, research table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from registry.base import (
    BARS10_SQL, ORACLE, M10, bars10, query, stored, stored_bars10, tick_splits, ticks, tk_sql,
)
from tickframe.functions.numbers import ratio
from tickframe.operators.asof import asof_join
from tickframe.operators.bars import time_bars
from tickframe.operators.merging import count_of, greatest_of, least_of, rolling_merged
from tickframe.operators.quantiles import IN_TASK_ROWS
from tickframe.operators.ranks import rank_columns
from tickframe.operators.rolling import last_per_interval, rolling, total
from tickframe.operators.scans import forward_fill, running_sums
from tickframe.operators.asof import order_position
from tickframe.functions.times import micros
from tickframe.operators.tables import null_summary, pivot_by
from tickframe.plans.metadata import Metadata, append_metadata
from tickframe.plans.research import default_marks, mark, research_dates, research_table
from tickframe.plans.returns import Returns
from tickframe.session import scratch_path

MIN30 = timedelta(minutes=30)
# Sums that are equal on paper may differ in the last bits between engines; both sides rank so many digits.
RANK_DIGITS = 10
FIVE = ["now_to_p10m", "p1m_to_p11m", "m10m_to_now", "m20m_to_now", "m30m_to_now"]


def _minutes(d: timedelta) -> int:
    return int(d / timedelta(minutes=1))


def returns_sql(query_cte: str, marks: dict, tol: str, backend: str = "bars") -> str:
    """CTEs ``pts``, ``m``, ``ret``: one ASOF join over all distinct offsets (minutes)."""
    offs = sorted({_minutes(x) for s, d in marks.values() for x in (s, s + d)})
    rows = ", ".join(f"({o})" for o in offs)
    cols = []
    for n, (s, d) in marks.items():
        a, b = _minutes(s), _minutes(s + d)
        f = "max(fair) FILTER (WHERE off = {})"
        lag = "max(lag) FILTER (WHERE off = {})"
        cols.append(
            f"({f.format(b)} - {f.format(a)}) / nullif({f.format(a)}, 0) AS return_{n}, "
            f"greatest({lag.format(a)}, {lag.format(b)}) AS max_tick_to_query_lag_{n}"
        )
    return f"""pts AS (
  SELECT q.symbol, q.time, o.off, q.time + o.off * INTERVAL 1 MINUTE AS qt
  FROM {query_cte} q, (VALUES {rows}) o(off)),
m AS (
  SELECT p.symbol, p.time, p.off, epoch_us(p.qt) - epoch_us(b.last_event_time) AS lag,
    CASE WHEN b.last_event_time + INTERVAL '{tol}' >= p.qt THEN b.vwap_price END AS fair
  FROM pts p ASOF LEFT JOIN {backend} b
    ON p.symbol = b.symbol AND p.qt >= b.last_event_time),
ret AS (SELECT symbol, time, {', '.join(cols)} FROM m GROUP BY symbol, time)"""


def _mark_cols(names, digits=6):
    return ", ".join(
        f"round(return_{n}, {digits}) AS return_{n}, max_tick_to_query_lag_{n}" for n in names
    )


@query(
    "asof_last_tick",
    f"""WITH {tk_sql()}, {tk_sql('user_id').replace('tk AS', 'tu AS', 1)},
q AS (SELECT symbol, time + INTERVAL '1 hour' AS query_time, trade_id AS query_id FROM tu)
SELECT q.symbol, q.query_time, q.query_id, t.time AS tick_time,
  CASE WHEN t.time + INTERVAL '3 days' >= q.query_time THEN t.price END AS price,
  CASE WHEN t.time + INTERVAL '3 days' >= q.query_time THEN t.trade_id END AS trade_id,
  epoch_us(q.query_time) - epoch_us(t.time) AS lag_us
FROM q ASOF LEFT JOIN (SELECT * FROM tu WHERE trade_id % 3 = 0) t
  ON q.symbol = t.symbol AND q.query_time >= t.time""",
)
def asof_last_tick(spark, sf):
    t = ticks(spark, sf, "user_id")
    q = t.select(
        "symbol", (F.col("time") + F.expr("INTERVAL 1 HOUR")).alias("query_time"),
        F.col("trade_id").alias("query_id"),
    )
    return asof_join(
        q, t.where("trade_id % 3 = 0"), "query_time", "time", ["symbol"],
        tolerance=timedelta(days=3), values=["price", "trade_id"], tie=["trade_id"],
        time_as="tick_time", lag_as="lag_us", splits=tick_splits(spark, sf, "user_id"),
    )


@query(
    "returns_single",
    f"""WITH {BARS10_SQL}, {returns_sql('bars', {'x': mark('now_to_p10m')}, '30 minutes')}
SELECT symbol, time, round(return_x, 6) AS "return",
  max_tick_to_query_lag_x AS max_tick_to_query_lag FROM ret""",
)
def returns_single(spark, sf):
    b = stored_bars10(spark, sf)
    r = Returns(b, splits=tick_splits(spark, sf))
    return r.query(
        b.select("symbol", "time"), timedelta(0), M10, tolerance=MIN30,
        row_key=["symbol", "time"],
    )


@query(
    "returns_batch",
    f"""WITH {BARS10_SQL}, {returns_sql('bars', {n: mark(n) for n in FIVE}, '30 minutes')}
SELECT symbol, time, {_mark_cols(FIVE)} FROM ret""",
)
def returns_batch(spark, sf):
    b = stored_bars10(spark, sf)
    return Returns(b, splits=tick_splits(spark, sf)).query_batch(
        b.select("symbol", "time"), {n: mark(n) for n in FIVE}, tolerance=MIN30,
        row_key=["symbol", "time"],
    )


@query(
    "returns_unknown_symbol",
    f"""WITH {BARS10_SQL}, q AS (
  SELECT symbol, time, trade_id FROM tk
  UNION ALL SELECT 'click_none' AS symbol, time, trade_id FROM tk WHERE symbol = 'click'),
s AS (SELECT q.*, q.time AS st, b.last_event_time AS stt,
        CASE WHEN b.last_event_time + INTERVAL '1 hour' >= q.time THEN b.vwap_price END AS sf
      FROM q ASOF LEFT JOIN bars b ON q.symbol = b.symbol AND q.time >= b.last_event_time),
e AS (SELECT s.*, s.time + INTERVAL '1 hour' AS et, b.last_event_time AS ett,
        CASE WHEN b.last_event_time + INTERVAL '1 hour' >= s.time + INTERVAL '1 hour'
             THEN b.vwap_price END AS ef
      FROM s ASOF LEFT JOIN bars b
        ON s.symbol = b.symbol AND s.time + INTERVAL '1 hour' >= b.last_event_time)
SELECT symbol, time, trade_id,
  CASE WHEN symbol <> 'click_none' THEN st END AS start_query_time,
  CASE WHEN symbol <> 'click_none' THEN et END AS end_query_time,
  stt AS start_tick_time, ett AS end_tick_time,
  greatest(epoch_us(st) - epoch_us(stt), epoch_us(et) - epoch_us(ett))
    AS max_tick_to_query_lag,
  round(sf, 6) AS start_fair, round(ef, 6) AS end_fair,
  round((ef - sf) / nullif(sf, 0), 6) AS "return" FROM e""",
)
def returns_unknown_symbol(spark, sf):
    t = ticks(spark, sf).select("symbol", "time", "trade_id")
    q = t.unionByName(t.where("symbol = 'click'").withColumn("symbol", F.concat("symbol", F.lit("_none"))))
    return Returns(stored_bars10(spark, sf), splits=tick_splits(spark, sf)).query(
        q, F.col("time"), timedelta(hours=1), tolerance=timedelta(hours=1),
        append_query_tick_times=True, append_start_end_fairs=True,
    )


UNIVERSE_SQL = "uni AS (SELECT DISTINCT symbol, date FROM tk)"
GRID_SQL = f"""{UNIVERSE_SQL},
grid AS (
  SELECT symbol, date, unnest(generate_series(CAST(date AS TIMESTAMP),
    CAST(date AS TIMESTAMP) + INTERVAL '1 day' - INTERVAL '10 minutes',
    INTERVAL '10 minutes')) AS time FROM uni)"""

RET_GRID_SQL = (
    GRID_SQL + ",\n" + returns_sql("grid", {"x": mark("now_to_p10m")}, "10 minutes")
)

ROLL_RET_SQL = """rr AS (
  SELECT symbol, time,
    avg(return_x) OVER w7 * 144 AS daily_returns_drift_7d_lookback,
    stddev_samp(return_x) OVER w7 * 12 AS daily_vol_7d_lookback,
    count(return_x) OVER w7 AS vol_ssize_7d_lookback,
    avg(return_x) OVER w30 * 144 AS daily_returns_drift_30d_lookback,
    stddev_samp(return_x) OVER w30 * 12 AS daily_vol_30d_lookback,
    count(return_x) OVER w30 AS vol_ssize_30d_lookback
  FROM ret
  WINDOW w7 AS (PARTITION BY symbol ORDER BY time
           RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
         w30 AS (PARTITION BY symbol ORDER BY time
           RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))"""


def _liq(d: int) -> str:
    w = f"w{d}"
    return f"""coalesce(sum(vwap_price * volume) OVER {w}, 0) AS liquidity_{d}d,
    sqrt(coalesce(sum(vwap_price * volume) OVER {w}, 0)) AS sqrtliq_{d}d,
    sum(taker_buy_volume - taker_sell_volume) OVER {w} / nullif(sum(volume) OVER {w}, 0)
      AS excess_buy_ratio_{d}d,
    CAST(coalesce(sum(trade_count) OVER {w}, 0) AS BIGINT) AS trade_count_{d}d"""


ROLL_BAR_SQL = f"""rb AS (
  SELECT symbol, date, last_event_time, {_liq(1)}, {_liq(7)} FROM bars
  WINDOW w1 AS (PARTITION BY symbol ORDER BY last_event_time
           RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
         w7 AS (PARTITION BY symbol ORDER BY last_event_time
           RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))"""

BAR_NAMES = [f"{m}_{d}d" for d in (1, 7)
             for m in ("liquidity", "sqrtliq", "excess_buy_ratio", "trade_count")]
RET_NAMES = [f"{m}_{d}d_lookback" for d in (7, 30)
             for m in ("daily_returns_drift", "daily_vol", "vol_ssize")]


def snap_sql(name: str, src: str, time: str, cols: str) -> str:
    return f"""{name} AS (
  SELECT symbol, time_bucket(INTERVAL '1 hour', {time}) + INTERVAL '1 hour' AS grid_time, {cols}
  FROM {src}
  QUALIFY row_number() OVER (PARTITION BY symbol, time_bucket(INTERVAL '1 hour', {time})
                             ORDER BY {time} DESC) = 1)"""


def rank_sql(v: str, digits: int | None = None) -> str:
    k = v
    if digits:
        scale = f"pow(10, {digits - 1} - floor(log10(abs(nullif({v}, 0)))))"
        k = f"(CASE WHEN {v} = 0 THEN 0 ELSE round({v} * {scale}) / {scale} END)"
    return f"""CASE WHEN {v} IS NOT NULL THEN
    (rank() OVER (PARTITION BY grid_time ORDER BY {k} NULLS LAST)
     + (count(*) OVER (PARTITION BY grid_time, {k}) - 1) / 2.0::DOUBLE)
    / count({v}) OVER (PARTITION BY grid_time) END AS {v}_q"""


RANKED_NAMES = ["liquidity_1d", "liquidity_7d", "daily_vol_7d_lookback",
                "daily_vol_30d_lookback"]
META_SQL = ",\n".join([
    BARS10_SQL, RET_GRID_SQL, ROLL_RET_SQL, ROLL_BAR_SQL,
    snap_sql("sb", "rb", "last_event_time", "date, last_event_time, " + ", ".join(BAR_NAMES)),
    snap_sql("sr", "rr", "time", ", ".join(RET_NAMES)),
    f"""meta AS (
  SELECT symbol, grid_time AS time, date, last_event_time, {', '.join(BAR_NAMES)},
    {', '.join(RET_NAMES)}, {', '.join(rank_sql(v, RANK_DIGITS) for v in RANKED_NAMES)}
  FROM sb JOIN sr USING (symbol, grid_time))""",
])


def _rounded_meta(prefix: str = "") -> str:
    cols = []
    for n in BAR_NAMES + RET_NAMES + [v + "_q" for v in RANKED_NAMES]:
        c = f"{prefix}{n}"
        cols.append(f"{c} AS {n}" if n.startswith(("trade_count", "vol_ssize"))
                    else f"round({c}, 3) AS {n}")
    return ", ".join(cols)


def _meta(spark, sf) -> Metadata:
    t = ticks(spark, sf)
    return Metadata(
        stored_bars10(spark, sf), t.select("symbol", "date").distinct(),
        splits=tick_splits(spark, sf), rank_digits=RANK_DIGITS,
    )


@query(
    "returns_grid",
    f"WITH {tk_sql()}, {GRID_SQL} SELECT symbol, date, time AS returns_grid_time FROM grid",
)
def returns_grid(spark, sf):
    t = ticks(spark, sf)
    return Metadata(t.withColumns({"vwap_price": F.col("price"), "last_event_time": F.col("time")}),
                    t.select("symbol", "date").distinct()).returns_grid()


@query(
    "rolling_liquidity",
    f"WITH {BARS10_SQL}, {ROLL_BAR_SQL} SELECT symbol, last_event_time, "
    + ", ".join(n if n.startswith("trade") else f"round({n}, 3) AS {n}" for n in BAR_NAMES)
    + " FROM rb",
    digits=3,
)
def rolling_liquidity(spark, sf):
    m = Metadata(bars10(spark, sf), ticks(spark, sf), splits=tick_splits(spark, sf))
    return m.rolling_bars().select("symbol", "last_event_time", *BAR_NAMES)


@query(
    "rolling_volatility",
    f"WITH {BARS10_SQL}, {RET_GRID_SQL}, {ROLL_RET_SQL} "
    "SELECT symbol, time AS returns_grid_time, "
    + ", ".join(n if n.startswith("vol_ssize") else f"round({n}, 3) AS {n}" for n in RET_NAMES)
    + " FROM rr",
    digits=3,
)
def rolling_volatility(spark, sf):
    return _meta(spark, sf).rolling_returns().drop("return")


@query(
    "rolling_any_aggregate",
    f"""WITH {BARS10_SQL}
SELECT symbol, last_event_time, max(high) OVER w AS high_1d, min(low) OVER w AS low_1d,
  count(*) OVER w AS n_bars_1d FROM bars
WINDOW w AS (PARTITION BY symbol ORDER BY last_event_time
  RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
)
def rolling_any_aggregate(spark, sf):
    b = bars10(spark, sf).select("symbol", "last_event_time", "high", "low")
    r = rolling_merged(b, ["symbol"], "last_event_time", timedelta(days=1), {
        "high_1d": greatest_of(F.col("high")), "low_1d": least_of(F.col("low")), "n_bars_1d": count_of(F.lit(1)),
    })
    return r.withColumn("n_bars_1d", F.coalesce("n_bars_1d", F.lit(0).cast("long"))).drop("high", "low")


@query(
    "snapshot_hourly",
    f"WITH {BARS10_SQL}, {ROLL_BAR_SQL}, "
    + snap_sql("sb", "rb", "last_event_time", "last_event_time, liquidity_1d, trade_count_7d")
    + " SELECT symbol, grid_time, last_event_time, round(liquidity_1d, 3) AS liquidity_1d, "
    "trade_count_7d FROM sb",
    digits=3,
)
def snapshot_hourly(spark, sf):
    m = Metadata(bars10(spark, sf), ticks(spark, sf), splits=tick_splits(spark, sf))
    s = last_per_interval(
        m.rolling_bars(), ["symbol"], "last_event_time", timedelta(hours=1), "grid_time"
    )
    return s.select("symbol", "grid_time", "last_event_time", "liquidity_1d", "trade_count_7d")


@query(
    "xs_rank",
    f"""WITH {tk_sql('user_id')}, v AS (
  SELECT symbol, date AS grid_time, CASE WHEN count(*) > 1 THEN sum(quantity) END AS volume
  FROM tk GROUP BY symbol, date)
SELECT symbol, grid_time, volume, round(volume_q, 6) AS volume_q
FROM (SELECT *, {rank_sql('volume')} FROM v)""",
)
def xs_rank(spark, sf):
    v = ticks(spark, sf, "user_id").groupBy("symbol", F.col("date").alias("grid_time")).agg(
        F.when(F.count(F.lit(1)) > 1, F.sum("quantity")).alias("volume")
    )
    return rank_columns(v, ["volume"], ["grid_time"], in_task_rows=IN_TASK_ROWS)


@query(
    "metadata_full",
    f"WITH {META_SQL} SELECT symbol, time, date, last_event_time, {_rounded_meta()} FROM meta",
    digits=3,
)
def metadata_full(spark, sf):
    return _meta(spark, sf).compute()


@query(
    "metadata_append",
    f"""WITH {META_SQL}
SELECT t.symbol, t.time, t.trade_id, {_rounded_meta('m.')}
FROM tk t ASOF LEFT JOIN meta m ON t.symbol = m.symbol AND t.time >= m.time""",
    digits=3,
)
def metadata_append(spark, sf):
    m = _meta(spark, sf)
    t = ticks(spark, sf).select("symbol", "time", "trade_id")
    return append_metadata(t, m.compute().drop("date", "last_event_time"), splits=m.splits)


ALL = default_marks()


@query(
    "research_table",
    f"""WITH {META_SQL.replace('pts AS', 'gpts AS').replace('m AS (', 'gm AS (', 1)
              .replace('FROM pts p', 'FROM gpts p').replace('FROM m GROUP', 'FROM gm GROUP')
              .replace('ret AS (', 'gret AS (', 1).replace('FROM ret', 'FROM gret')},
fine AS (SELECT symbol, max(time) AS last_event_time,
           sum(price * quantity) / nullif(sum(quantity), 0) AS vwap_price
         FROM tk GROUP BY symbol, date, time_bucket(INTERVAL '5 seconds', time)),
{returns_sql('bars', ALL, '30 minutes', 'fine')},
br AS (SELECT b.symbol, b.date, b.time, b.close, ret.* EXCLUDE (symbol, time)
       FROM bars b JOIN ret ON b.symbol = ret.symbol AND b.time = ret.time)
SELECT br.symbol, br.date, br.time, br.close, {_mark_cols(ALL)}, {_rounded_meta('meta.')}
FROM br ASOF LEFT JOIN meta ON br.symbol = meta.symbol AND br.time >= meta.time""",
)
def research(spark, sf):
    fine = stored(time_bars(ticks(spark, sf), timedelta(seconds=5)), "fine-bars")
    m = _meta(spark, sf)
    index = m.bars.select("symbol", "date", "time", "close")
    meta = stored(m.compute().drop("date", "last_event_time"), "metadata")
    meta = meta.select(
        "symbol", "time",
        *[F.round(f.name, 3).alias(f.name) if f.dataType.typeName() == "double" else f.name
          for f in meta.schema if f.name not in ("symbol", "time")],
    )
    return research_table(index, fine, meta, tolerance=MIN30, splits=m.splits)


@query("research_incremental", ORACLE["research_table"])
def research_incremental(spark, sf):
    """Dates up to the 12th from sources that end there, then all dates from the grown sources: the
    last dates of the first run look ahead and are computed again."""
    fine = stored(time_bars(ticks(spark, sf), timedelta(seconds=5)), "fine-bars")
    m = _meta(spark, sf)
    index = stored(m.bars.select("symbol", "date", "time", "close"), "index-bars")
    meta = stored(m.compute().drop("last_event_time"), "metadata")
    meta = meta.select(*[
        F.round(f.name, 3).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in meta.schema
    ])
    path = scratch_path(spark, "research")
    for upto in (12, 31):
        sources = [df.where(F.day("date") <= upto) for df in (index, fine, meta)]
        t = research_dates(spark, path, *sources, tolerance=MIN30, splits=m.splits)
        t.compute(days_per_batch=16)
    return t[None]


@query(
    "null_fraction",
    f"""WITH {BARS10_SQL}, {returns_sql('bars', {'x': mark('now_to_p10m')}, '30 minutes')}
SELECT symbol, CAST(time AS DATE) AS date, count(*) AS n_rows,
  round(count(*) FILTER (WHERE return_x IS NULL) / count(*), 6) AS null_frac,
  round(sum(return_x), 6) AS sum_value, max(max_tick_to_query_lag_x) AS max_lag,
  round(avg(max_tick_to_query_lag_x), 3) AS mean_lag
FROM ret GROUP BY symbol, CAST(time AS DATE)""",
)
def null_fraction(spark, sf):
    r = returns_single(spark, sf).withColumn("date", F.to_date("time"))
    s = null_summary(r, ["symbol", "date"], "return", "max_tick_to_query_lag")
    return s.withColumn("mean_lag", F.round("mean_lag", 3))


# The event types of the test tables, which SQL has to spell out.
KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "cum_null_pivot",
    f"""WITH {BARS10_SQL}, {returns_sql('bars', {'x': mark('now_to_p10m')}, '30 minutes')},
d AS (SELECT symbol, CAST(time AS DATE) AS date, count(*) AS n,
        count(*) FILTER (WHERE return_x IS NULL) AS n_null
      FROM ret GROUP BY symbol, CAST(time AS DATE)),
c AS (SELECT symbol, date,
        sum(n_null) OVER (PARTITION BY symbol ORDER BY date)
        / sum(n) OVER (PARTITION BY symbol ORDER BY date) AS f FROM d),
p AS (SELECT date, {', '.join(f"max(f) FILTER (WHERE symbol = '{k}') AS {k}" for k in KINDS)}
      FROM c GROUP BY date)
SELECT date, {', '.join(
    f"round(last_value({k} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING), 6) AS {k}"
    for k in KINDS)} FROM p""",
)
def cum_null_pivot(spark, sf):
    r = returns_single(spark, sf)
    d = r.groupBy("symbol", F.to_date("time").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("return").isNull()).alias("n_null")
    )
    day = F.unix_date("date")
    c = running_sums(d, ["symbol"], day, {"cn": F.col("n"), "cnull": F.col("n_null")})
    c = c.withColumn("f", ratio(F.col("cnull"), F.col("cn")))
    p = pivot_by(c, "date", "symbol", "f")
    names = [x for x in p.columns if x != "date"]
    # one row per date: a calendar, so a single ordered scan is small by nature
    return forward_fill(p, [], day, {f"__{k}": F.col(f"`{k}`") for k in names}).select(
        "date", *[F.col(f"`__{k}`").alias(k) for k in names]
    )
