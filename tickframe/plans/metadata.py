"""Point-in-time metadata per symbol: rolling liquidity and return statistics, taken hourly,
with their cross-sectional rank shares."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickframe.functions.times import as_col, day_points, micros
from tickframe.operators.asof import asof_join
from tickframe.operators.ranks import rank_columns
from tickframe.operators.rolling import (
    Measure, filled, last_per_interval, mean, rolling, root_total, sample_std, total, total_ratio,
)
from tickframe.operators.splits import Splits
from tickframe.plans.dataset import DateTable
from tickframe.operators.tables import columns_matching
from tickframe.plans.returns import Returns

Measures = dict[timedelta, dict[str, Measure]]

DAY = timedelta(days=1)
# Fixed pattern: columns that get a rank share.
RANKED = r"^(daily_vol|liquidity)"


def liquidity_measures() -> Measures:
    traded = F.col("vwap_price") * F.col("volume")
    excess = F.col("taker_buy_volume") - F.col("taker_sell_volume")
    return {
        timedelta(days=d): {
            f"liquidity_{d}d": total(traded),
            f"sqrtliq_{d}d": root_total(traded),
            f"excess_buy_ratio_{d}d": total_ratio(excess, F.col("volume")),
            f"trade_count_{d}d": total(F.col("trade_count")),
        }
        for d in (1, 7)
    }


def return_measures(interval: timedelta) -> Measures:
    """Drift and volatility per day: scaled by the number of intervals in a day."""
    n = DAY / interval
    return {
        timedelta(days=d): {
            f"daily_returns_drift_{d}d_lookback": mean("return", n),
            f"daily_vol_{d}d_lookback": sample_std("return", n**0.5),
            f"vol_ssize_{d}d_lookback": filled("return"),
        }
        for d in (7, 30)
    }


class Metadata:
    """Metadata over a bar table and its (symbol, date) universe."""

    def __init__(
        self,
        bars: DataFrame,
        universe: DataFrame,
        event_time: str = "last_event_time",
        returns_interval: timedelta = timedelta(minutes=10),
        grid_interval: timedelta = timedelta(hours=1),
        by_bar: Measures | None = None,
        by_return: Measures | None = None,
        ranked: str = RANKED,
        fair: str | Column = "vwap_price",
        splits: Splits | None = None,
        rank_digits: int | None = None,
    ):
        """``rank_digits`` ranks by that many significant digits, so that equal sums stay tied in
        whatever order they were added up; without it values are ranked as they are."""
        self.rank_digits = rank_digits
        self.bars, self.universe, self.event_time = bars, universe, event_time
        self.returns_interval, self.grid_interval = returns_interval, grid_interval
        self.by_bar = by_bar or liquidity_measures()
        self.by_return = by_return or return_measures(returns_interval)
        self.ranked, self.splits = ranked, splits
        self.returns = Returns(bars, fair, event_time, splits=splits)

    def returns_grid(self) -> DataFrame:
        """Every (symbol, date) of the universe at each interval of the day."""
        return self.universe.select("symbol", "date").select(
            "symbol", "date",
            F.explode(day_points("date", self.returns_interval)).alias("returns_grid_time"),
        )

    def grid_returns(self, dates: tuple[date, date] | None = None) -> DataFrame:
        grid = self.returns_grid()
        if dates:
            grid = grid.where(
                F.col("date").between(F.lit(dates[0] - max(self.by_return)), F.lit(dates[1]))
            )
        return self.returns.query(
            grid, timedelta(0), self.returns_interval, time="returns_grid_time",
            tolerance=self.returns_interval, row_key=["symbol", "returns_grid_time"],
            dates=(dates[0] - max(self.by_return), dates[1]) if dates else None,
        )

    def rolling_returns(self, dates: tuple[date, date] | None = None) -> DataFrame:
        r = self.grid_returns(dates).select("symbol", "returns_grid_time", "return")
        return rolling(r, ["symbol"], "returns_grid_time", self.by_return, self.splits)

    def rolling_bars(self, dates: tuple[date, date] | None = None) -> DataFrame:
        b = self.bars
        if dates:
            b = b.where(
                F.col("date").between(F.lit(dates[0] - max(self.by_bar)), F.lit(dates[1]))
            )
        return rolling(b, ["symbol"], self.event_time, self.by_bar, self.splits)

    def snapshot(self, rolled: DataFrame, time: str, names: list[str], dates) -> DataFrame:
        """Last rolling row per symbol and grid interval, labelled with the interval's end.

        ``dates`` is inclusive and names the partitions of the output: a snapshot belongs to
        the date of the rows it sums up, so its label runs from after the first midnight to the
        midnight that ends the last date, and no row falls into a partition not asked for.
        """
        s = last_per_interval(
            rolled, ["symbol"], time, self.grid_interval, "grid_time"
        )
        if dates:
            g = F.col("grid_time").cast("timestamp")
            lo, hi = (F.lit(d).cast("timestamp") for d in (dates[0], dates[1] + DAY))
            s = s.where((g > lo) & (g <= hi))
        return s.select("symbol", "grid_time", *names)

    def compute(self, dates: tuple[date, date] | None = None) -> DataFrame:
        bar_names = [n for by_name in self.by_bar.values() for n in by_name]
        ret_names = [n for by_name in self.by_return.values() for n in by_name]
        of_bars = self.snapshot(
            self.rolling_bars(dates), self.event_time,
            ["date", self.event_time, *bar_names], dates,
        )
        of_returns = self.snapshot(
            self.rolling_returns(dates), "returns_grid_time", ret_names, dates
        )
        both = of_bars.join(of_returns, ["symbol", "grid_time"])
        both = rank_columns(
            both, columns_matching(both, self.ranked), ["grid_time"], digits=self.rank_digits
        )
        return both.withColumnRenamed("grid_time", "time")


def append_metadata(
    df: DataFrame, metadata: DataFrame, time: str = "time", symbol: str = "symbol",
    splits: Splits | None = None,
) -> DataFrame:
    """The latest metadata known at each row's time. Names that exist already get ``_right``."""
    values = [c for c in metadata.columns if c not in ("symbol", "time")]
    return asof_join(
        df, metadata, time, "time", [symbol], ["symbol"], values=values, tie=(), splits=splits
    )


def metadata_table(spark: SparkSession, metadata: Metadata, path: str) -> DateTable:
    """Metadata as an incremental table: a batch of dates reads only the bars its lookbacks reach."""

    def compute(dates: list[date]) -> DataFrame:
        return metadata.compute((min(dates), max(dates))).where(F.col("date").isin(dates))

    return DateTable(spark, path, metadata.universe, compute)
