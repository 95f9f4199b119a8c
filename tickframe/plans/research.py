"""Research table: index bars, returns over many marks on fine bars, and metadata."""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickframe.operators.splits import Splits
from tickframe.plans.dataset import DateTable
from tickframe.plans.metadata import append_metadata
from tickframe.plans.returns import Mark, Returns

_UNITS = {"m": timedelta(minutes=1), "h": timedelta(hours=1), "d": timedelta(days=1)}

# The default marks. "m10m_to_now" starts 10 minutes before the row's time and
# ends at it; "p1m_to_p11m" starts 1 minute after and ends 11 minutes after.
DEFAULT_MARKS = (
    "m10m_to_now", "m12h_to_now", "m1d_to_now", "m1h_to_now", "m1m_to_now", "m20m_to_now", "m2h_to_now",
    "m2m_to_now", "m30m_to_now", "m3h_to_now", "m5m_to_now", "m6h_to_now",
    "now_to_p1m", "now_to_p2m", "now_to_p5m", "now_to_p10m", "now_to_p20m", "now_to_p30m", "now_to_p1h",
    "now_to_p2h", "now_to_p3h", "now_to_p6h", "now_to_p12h", "now_to_p1d",
    "p1m_to_p11m", "p1m_to_p2m", "p1m_to_p3m", "p1m_to_p6m",
)


def _offset(word: str) -> timedelta:
    if word == "now":
        return timedelta(0)
    size = int(word[1:-1]) * _UNITS[word[-1]]
    return -size if word[0] == "m" else size


def mark(name: str) -> Mark:
    """A mark from its name."""
    start, end = (_offset(w) for w in name.split("_to_"))
    return start, end - start


def default_marks() -> dict[str, Mark]:
    return {n: mark(n) for n in DEFAULT_MARKS}


def research_table(
    index_bars: DataFrame,
    backend_bars: DataFrame,
    metadata: DataFrame,
    dates: tuple[date, date] | None = None,
    marks: dict[str, Mark] | None = None,
    tolerance: timedelta = timedelta(seconds=30),
    splits: Splits | None = None,
) -> DataFrame:
    """Bars of the asked dates with returns and point-in-time metadata."""
    bars = index_bars
    if dates:
        bars = bars.where(F.col("date").between(F.lit(dates[0]), F.lit(dates[1])))
    with_returns = Returns(backend_bars, splits=splits).query_batch(
        bars, marks or default_marks(), tolerance=tolerance,
        row_key=["symbol", "date", "time"], dates=dates,
    )
    return append_metadata(with_returns, metadata, splits=splits)


def span_of(marks: dict[str, Mark]) -> tuple[int, int]:
    """Whole days that the marks look back and ahead of a row's time."""
    day = timedelta(days=1)
    points = [timedelta(0), *(x for start, length in marks.values() for x in (start, start + length))]
    return math.ceil(-min(points) / day), math.ceil(max(points) / day)


def from_day(df: DataFrame, day: date, time: str, reach: timedelta | None = None) -> DataFrame:
    """Rows of ``day`` and later, and the last row of each symbol before, by ``time``.

    With ``reach`` the last row is looked for in that many days only.
    """
    older = df.where(F.col("date") < F.lit(day))
    if reach is not None:
        older = older.where(F.col("date") >= F.lit(day - reach))
    last = older.groupBy("symbol").agg(F.max_by(F.struct(*[c for c in df.columns if c != "symbol"]), time).alias("r"))
    return df.where(F.col("date") >= F.lit(day)).unionByName(last.select("symbol", "r.*"))


def research_dates(
    spark: SparkSession, path: str, index_bars: DataFrame, backend_bars: DataFrame, metadata: DataFrame,
    marks: dict[str, Mark] | None = None, reach: timedelta | None = None, **options,
) -> DateTable:
    """The research table as an incremental table over the dates of the index bars.

    A batch reads, by partition, the backend's dates from the marks' look-back to their look-ahead,
    the metadata of its own dates, and of both the last row per symbol before, which keeps lags and
    metadata as in one pass over everything; ``reach`` bounds how far back that last row is looked
    for, and what is older then counts as absent. A date whose look-ahead the backend has not yet
    covered is computed again once there is more. ``marks`` start at offsets; ``options`` go to
    ``research_table``.

    A row that ends a day lies on the next midnight, so one more date counts as ahead.
    """
    marks = marks or default_marks()
    back, ahead = span_of(marks)
    ahead += 1

    def compute(dates: list[date]) -> DataFrame:
        first, last = min(dates), max(dates)
        ticks = backend_bars.where(F.col("date") <= F.lit(last + timedelta(days=ahead)))
        known = metadata.where(F.col("date") <= F.lit(last))
        return research_table(
            index_bars.where(F.col("date").isin(dates)), from_day(ticks, first - timedelta(days=back), "last_event_time", reach),
            from_day(known, first, "time", reach).drop("date"), marks=marks, **options,
        )

    def newest() -> date | None:
        return backend_bars.agg(F.max("date")).first()[0]

    return DateTable(spark, path, index_bars.select("symbol", "date"), compute, ahead=ahead, last=newest)
