"""The plans for large inputs, forced on the test tables: split hot keys, null keys, large ids,
batches of dates, and the record of valid dates."""

from __future__ import annotations

import datetime as dt
from datetime import timedelta

from pyspark.sql import functions as F

from registry.base import BARS10_SQL, M10, query, stored_bars10, table, tick_splits, ticks, tk_sql
from registry.curves import CURVE_SQL, _input
from registry.engines import META_SQL, MIN30, _meta, _rounded_meta, returns_sql
from tickframe.functions.times import micros
from tickframe.operators.asof import asof_splits
from tickframe.operators.bars import time_bars
from tickframe.operators.curves import dependence_curve
from tickframe.operators.quantiles import exact_quantiles
from tickframe.operators.ranks import rank_columns
from tickframe.operators.rolling import filled, rolling, sample_std, total
from tickframe.operators.scans import previous, running_sums
from tickframe.operators.splits import measure_splits
from tickframe.plans.dataset import DateTable
from tickframe.plans.metadata import metadata_table
from tickframe.plans.returns import Returns
from tickframe.session import scratch_path

PART = 64  # rows from which a key counts as hot here
HOT_SQL = """hot AS (SELECT event_id, ts AS time, value,
  CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 'hot' ELSE event_type END AS symbol
  FROM events)"""


def _hot(spark, sf):
    """Events of which a third has no symbol and another third shares one."""
    kind = F.when(F.col("event_id") % 3 == 1, "hot").when(F.col("event_id") % 3 == 2, F.col("event_type"))
    return table(spark, sf, "events").select("event_id", F.col("ts").alias("time"), "value", kind.alias("symbol"))


@query(
    "split_rolling",
    f"""WITH {HOT_SQL}
SELECT event_id, round(sum(value) OVER w, 4) AS value_7d,
  CASE WHEN count(value) OVER w >= 2 THEN round(stddev_samp(value) OVER w, 4) END AS std_7d,
  count(value) OVER w AS n_7d FROM hot
WINDOW w AS (PARTITION BY symbol ORDER BY time
  RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
    digits=4,
)
def split_rolling(spark, sf):
    d = _hot(spark, sf)
    splits = asof_splits(d, ["symbol"], "time", min_rows=PART)
    ms = {timedelta(days=7): {
        "value_7d": total(F.col("value")), "std_7d": sample_std("value"), "n_7d": filled("value"),
    }}
    r = rolling(d, ["symbol"], "time", ms, splits)
    return r.select(
        "event_id", F.when(F.col("n_7d") > 0, F.col("value_7d")).alias("value_7d"), "std_7d",
        F.col("n_7d").cast("long").alias("n_7d"),
    )


@query(
    "split_running",
    f"""WITH {HOT_SQL} SELECT event_id, round(sum(value) OVER w, 4) AS total,
  lag(event_id) OVER (PARTITION BY symbol ORDER BY time, event_id) AS before FROM hot
WINDOW w AS (PARTITION BY symbol ORDER BY time, event_id ROWS UNBOUNDED PRECEDING)""",
    digits=4,
)
def split_running(spark, sf):
    d = _hot(spark, sf)
    tie = F.col("event_id")
    splits = measure_splits(d, ["symbol"], micros("time"), tie, min_rows=PART)
    r = running_sums(d, ["symbol"], micros("time"), {"total": F.col("value")}, tie, splits)
    r = previous(r.select(*d.columns, "total"), ["symbol"], micros("time"), {"before": F.col("event_id")}, tie, splits)
    return r.select("event_id", "total", "before")


@query(
    "split_curve",
    f"""WITH {CURVE_SQL} SELECT CAST(tie AS VARCHAR) AS tie, round(weight_norm, 6) AS weight_norm,
  round(l_discount_cumsum, 4) AS l_discount_cumsum FROM c""",
)
def split_curve(spark, sf):
    c = dependence_curve(_input(spark, sf), "l_extendedprice", ["l_discount"], "l_quantity", "tie", rows_per_part=PART)
    return c.select(F.col("tie").cast("string").alias("tie"), "weight_norm", F.round("l_discount_cumsum", 4).alias("l_discount_cumsum"))


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@query(
    "split_quantiles",
    "SELECT name, prob, round(value, 6) AS value FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, unnest({PROBS}::DOUBLE[]) AS prob, unnest(quantile_cont({c}, {PROBS})) AS value FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ) + ")",
)
def split_quantiles(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    q = exact_quantiles(table(spark, sf, "lineitem"), names, PROBS, in_task_rows=PART)
    rows = [(n, p, v) for n in names for p, v in zip(PROBS, q[n])]
    return spark.createDataFrame(rows, "name string, prob double, value double")


@query(
    "split_ranks",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(((rank() OVER w) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE)
    / count(*) OVER (PARTITION BY l_returnflag), 6) AS l_quantity_q
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_quantity)""",
)
def split_ranks(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    return rank_columns(d, ["l_quantity"], ["l_returnflag"], in_task_rows=PART).drop("l_returnflag", "l_quantity")


@query(
    "bars_large_ids",
    """WITH t AS (SELECT event_type AS symbol, date_trunc('hour', ts) AS time, value AS price,
    (100000000 - event_id) * 8589934592 AS trade_id FROM events)
SELECT symbol, time + INTERVAL 1 HOUR AS time, round(first(price ORDER BY trade_id), 6) AS open,
  round(last(price ORDER BY trade_id), 6) AS close, count(*) AS trade_count FROM t GROUP BY symbol, time""",
)
def bars_large_ids(spark, sf):
    """Trades of equal time whose ids lie far beyond 32 bits: the id alone orders them."""
    t = ticks(spark, sf).withColumns({
        "time": F.date_trunc("hour", "time").cast("timestamp_ntz"),
        "trade_id": (F.lit(100_000_000) - F.col("trade_id")) * F.lit(1 << 33),
    })
    b = time_bars(t, timedelta(hours=1))
    return b.select("symbol", "time", "open", "close", "trade_count")


SPAN = "DATE '2024-01-10' AND DATE '2024-01-12'"


@query(
    "returns_column_mark_dates",
    f"""WITH {BARS10_SQL}, q AS (SELECT symbol, time FROM bars WHERE date BETWEEN {SPAN}),
{returns_sql('q', {'x': (timedelta(days=-3), timedelta(minutes=10))}, '30 minutes')}
SELECT symbol, time, round(return_x, 6) AS return_x, max_tick_to_query_lag_x FROM ret""",
)
def returns_column_mark_dates(spark, sf):
    """A mark that starts at a column, three days back, with the query's own dates."""
    b = stored_bars10(spark, sf)
    q = b.where(f"date BETWEEN {SPAN}").select("symbol", "time")
    start = F.col("time") - F.expr("INTERVAL 3 DAYS")
    return Returns(b, splits=tick_splits(spark, sf)).query_batch(
        q, {"x": (start, M10)}, tolerance=MIN30, row_key=["symbol", "time"],
        dates=(dt.date(2024, 1, 10), dt.date(2024, 1, 12)),
    )


@query(
    "metadata_incremental",
    f"WITH {META_SQL} SELECT symbol, time, date, last_event_time, {_rounded_meta()} FROM meta",
    digits=3,
)
def metadata_incremental(spark, sf):
    """Two batches of dates, the second one in parts of ten days, equal to the whole."""
    m = _meta(spark, sf)
    t = metadata_table(spark, m, scratch_path(spark, "metadata"))
    t.compute([d for d in t.partitions() if d.day <= 12], days_per_batch=30)
    t.compute(days_per_batch=10)
    return t[None]


@query(
    "validity_record",
    f"""WITH {tk_sql()}, d AS (SELECT DISTINCT date FROM tk)
SELECT count(*) AS partitions,
  count(*) FILTER (WHERE day(date) % 5 <> 0 AND day(date) NOT BETWEEN 11 AND 14) AS validated,
  count(*) FILTER (WHERE day(date) % 5 = 0 OR day(date) BETWEEN 11 AND 14) AS invalid,
  count(*) FILTER (WHERE day(date) BETWEEN 11 AND 14) AS failed FROM d""",
)
def validity_record(spark, sf):
    """Some dates compute to nothing and the batches of days 11 to 14 fail: neither is valid."""
    t = ticks(spark, sf)

    def compute(dates):
        if any(11 <= d.day <= 14 for d in dates):
            raise OSError("no space")
        return t.where(F.col("date").isin(dates) & (F.day("date") % 5 != 0))

    d = DateTable(spark, scratch_path(spark, "record"), t.select("symbol", "date"), compute)
    failed = 0
    days = d.partitions()
    for part in ([x for x in days if x.day < 11], [x for x in days if 11 <= x.day <= 14], [x for x in days if x.day > 14]):
        try:
            d.compute(part)
        except RuntimeError:
            failed += len(part)
    row = (d.num_partitions(), d.num_validated(), len(d.invalid()), failed)
    return spark.createDataFrame([row], "partitions long, validated long, invalid long, failed long")
