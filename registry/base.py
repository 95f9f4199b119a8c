"""Registration and the shared views over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickframe import prepare
from tickframe.operators.asof import asof_splits
from tickframe.operators.bars import time_bars
from tickframe.operators.splits import Splits
from tickframe.session import scratch_path
from tickframe.sinks.tables import write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

M10 = timedelta(minutes=10)
SCALE = 4  # digits of the amounts in the test tables


def query(name: str, sql: str | None = None, digits: int | None = 6):
    """Register a query; double columns of its result are rounded to ``digits``, or left as they are."""

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            made = fn(prepare(spark), sf_dir)
            return made if digits is None else rounded(made, digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Round doubles; adding 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(f.name, digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """``events`` as trades."""
    e = table(spark, sf_dir, "events")
    q = (1 + F.col("event_id") % 7).cast("double")
    return e.select(
        F.col(symbol).cast("string").alias("symbol"),
        F.col("ts").alias("time"),
        F.to_date("ts").alias("date"),
        F.lit("USD").alias("peg_symbol"),
        F.col("value").alias("price"),
        q.alias("quantity"),
        (F.col("value") * q).alias("quote_quantity"),
        (F.col("event_id") % 2 == 0).alias("is_buyer_maker"),
        F.col("event_id").alias("trade_id"),
    )


# The four identity columns as one ordered number.
LOT_ID = (
    "CASE WHEN l_partkey < 10000000 AND l_suppkey < 10000000 AND l_linenumber < 10 THEN "
    "((CAST(l_orderkey AS DECIMAL(12)) * 10 + l_linenumber) * 10000000 + l_partkey) * 10000000 "
    "+ l_suppkey ELSE raise_error('a lot key has too many digits') END"
)


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as trades: many equal times, a four-column trade identity."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_shipdate").alias("time"),
        F.to_date("l_shipdate").alias("date"),
        F.lit("USD").alias("peg_symbol"),
        price.alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("quote_quantity"),
        (F.col("l_linenumber") % 2 == 0).alias("is_buyer_maker"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_discount", "l_extendedprice", F.expr(LOT_ID).alias("lot_id"),
    )


def bars10(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    return time_bars(ticks(spark, sf_dir, symbol), M10, scale=SCALE)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: what several steps build on is a table, as in production."""
    return write_table(df, scratch_path(df.sparkSession, name))


def stored_bars10(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    return stored(bars10(spark, sf_dir, symbol), "bars")


def tick_splits(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> Splits:
    """Hot symbols of the raw ticks; reused by everything derived from them."""
    return asof_splits(ticks(spark, sf_dir, symbol), ["symbol"], "time")


def tk_sql(symbol: str = "event_type") -> str:
    return f"""tk AS (
  SELECT CAST({symbol} AS VARCHAR) AS symbol, ts AS time, CAST(ts AS DATE) AS date,
         'USD' AS peg_symbol, value AS price, CAST(1 + event_id % 7 AS DOUBLE) AS quantity,
         value * CAST(1 + event_id % 7 AS DOUBLE) AS quote_quantity,
         (event_id % 2 = 0) AS is_buyer_maker, event_id AS trade_id
  FROM events)"""


LOTS_SQL = """lots AS (
  SELECT l_returnflag || l_linestatus AS symbol, l_shipdate AS time,
         CAST(l_shipdate AS DATE) AS date, 'USD' AS peg_symbol,
         l_extendedprice / l_quantity AS price, l_quantity AS quantity,
         l_extendedprice AS quote_quantity, (l_linenumber % 2 = 0) AS is_buyer_maker,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, l_extendedprice
  FROM lineitem)"""


def exact(value: str) -> str:
    """A sum of amounts as decimals, the same in whatever order they come."""
    return f"CAST(sum(CAST({value} AS DECIMAL(28, {SCALE}))) AS DOUBLE)"


def bars_sql(name: str, src: str, every: str, order: str) -> str:
    """Bar CTE over a trade CTE."""
    return f"""{name} AS (
  SELECT symbol, date, time_bucket(INTERVAL '{every}', time) + INTERVAL '{every}' AS time,
         peg_symbol,
         first(price ORDER BY {order}) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY {order}) AS close,
         {exact('quantity')} AS volume, count(*) AS trade_count, max(time) AS last_event_time,
         {exact('CASE WHEN is_buyer_maker THEN 0 ELSE quantity END')} AS taker_buy_volume,
         {exact('CASE WHEN is_buyer_maker THEN quantity ELSE 0 END')} AS taker_sell_volume,
         {exact('CASE WHEN is_buyer_maker THEN 0 ELSE price * quantity END')}
           / nullif({exact('CASE WHEN is_buyer_maker THEN 0 ELSE quantity END')}, 0) AS vwap_taker_buy,
         {exact('CASE WHEN is_buyer_maker THEN price * quantity ELSE 0 END')}
           / nullif({exact('CASE WHEN is_buyer_maker THEN quantity ELSE 0 END')}, 0) AS vwap_taker_sell,
         {exact('price * quantity')} / nullif({exact('quantity')}, 0) AS vwap_price
  FROM {src}
  GROUP BY symbol, date, time_bucket(INTERVAL '{every}', time), peg_symbol)"""


BARS10_SQL = tk_sql() + ",\n" + bars_sql("bars", "tk", "10 minutes", "time, trade_id")

BAR_COLS = """symbol, date, time, peg_symbol, open, high, low, close, volume, trade_count, last_event_time,
  taker_buy_volume, taker_sell_volume, vwap_taker_buy, vwap_taker_sell, vwap_price"""


def rounds(digits: int, *names: str) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)
