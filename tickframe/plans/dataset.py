"""Date-partitioned tables with incremental compute and persistent validation."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, timedelta
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickframe.operators.bars import time_bars
from tickframe.sinks.files import children
from tickframe.sinks.manifest import NONE, PLAIN, Commits, Manifest
from tickframe.sinks.tables import write_partitioned

Compute = Callable[[list[date]], DataFrame]
Check = Callable[[DataFrame], DataFrame]


def rows_present(table: DataFrame) -> DataFrame:
    """Default rule: a partition is valid when it holds rows. One job for all dates."""
    return table.groupBy("date").agg((F.count(F.lit(1)) > 0).alias("ok"))


class DateTable:
    """A parquet table partitioned by ``date``, its universe and its validated dates.

    What ``compute`` makes is committed by manifests; partitions that other writers left in the
    folder itself count until a commit names their dates.

    ``compute`` maps dates to rows; ``check`` maps the table to (date, ok); ``post`` is applied
    to everything that is read. The number of dates is a calendar, so date lists may live on
    the driver.

    Rows of a table that looks ahead depend on up to ``ahead`` later dates of its sources, whose
    last date ``last`` tells. A date computed before its sources had come so far is open: it
    counts as valid and is read, and is computed again when the sources have grown.
    """

    def __init__(
        self, spark: SparkSession, path: str, universe: DataFrame, compute: Compute | None = None,
        check: Check = rows_present, post: Callable[[DataFrame], DataFrame] | None = None,
        sort: str | None = "time", ahead: int = 0, last: Callable[[], date | None] | None = None,
    ):
        missing = {"symbol", "date"} - set(universe.columns)
        if missing:
            raise ValueError(f"the universe lacks {sorted(missing)}")
        self.spark, self.path, self.universe = spark, path.rstrip("/"), universe
        self._compute, self._check, self._post, self._sort = compute, check, post, sort
        self._ahead, self._last = timedelta(days=ahead), last
        self.commits = Commits(spark, self.path)

    # -- reading
    def _table(self, manifest: Manifest, dates: Sequence[date] | None = None) -> DataFrame | None:
        """The rows that a manifest names, of all dates or the given ones. Without any: an empty table
        of the last committed schema, or None before the first commit."""
        plain = {date.fromisoformat(n[5:]): PLAIN for n in children(self.spark, self.path) if n.startswith("date=") and "__HIVE" not in n}
        folders = plain | manifest.folders
        if dates is not None:
            folders = {d: b for d, b in folders.items() if d in set(dates)}
        parts = []
        own = [f"{self.path}/date={d}" for d, b in sorted(folders.items()) if b == PLAIN and d in plain]
        if own:
            parts.append(self.spark.read.option("basePath", self.path).parquet(*own))
        made = [f"{self.commits.batch_path(b)}/date={d}" for d, b in sorted(folders.items()) if b not in (PLAIN, NONE)]
        if made:
            parts.append(self.spark.read.option("basePath", f"{self.path}/_batches").parquet(*made).drop("batch"))
        if not parts:
            schema = manifest.schema and T.StructType.fromJson(json.loads(manifest.schema))
            return self.spark.createDataFrame([], schema) if schema else None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, validate: bool = False) -> DataFrame:
        """The committed rows."""
        t = self._table(self.commits.read())
        if t is None:
            raise FileNotFoundError(f"no data under {self.path}")
        if validate:
            t.limit(1).collect()
        return self._post(t) if self._post else t

    def __getitem__(self, dates: Sequence[date] | date | None) -> DataFrame:
        """Rows of the given dates, which must be valid; None means everything."""
        if dates is None:
            return self.read()
        wanted = [dates] if isinstance(dates, date) else list(dates)
        bad = self.invalid(dates=wanted)
        unknown = sorted(set(wanted) - set(self.partitions()))
        if bad or unknown:
            raise ValueError(f"dates without valid data: {sorted(set(bad + unknown))}")
        return self.read().where(F.col("date").isin(wanted))

    # -- bookkeeping
    def partitions(self) -> list[date]:
        return [r[0] for r in self.universe.select("date").distinct().orderBy("date").collect()]

    def validated(self) -> list[date]:
        return sorted(self.commits.read().valid)

    def mark_valid(self, dates: Sequence[date]) -> None:
        self.commits.commit(lambda m: replace(m, valid=m.valid | set(dates)))

    def unmark(self, dates: Sequence[date]) -> None:
        """Take dates out of the valid ones; the rest stays."""
        self.commits.commit(lambda m: replace(m, valid=m.valid - set(dates)))

    def clear_validation(self) -> None:
        self.commits.commit(lambda m: replace(m, valid=frozenset()))

    def check(self, dates: Sequence[date] | None = None) -> DataFrame:
        """(date, ok) for the given dates, or every date of the universe; absent partitions are
        included and not ok. Only the partitions of these dates are read."""
        days = self.universe.select("date").distinct()
        if dates is not None:
            days = days.where(F.col("date").isin(list(dates)))
        table = self._table(self.commits.read(), dates)
        if table is None:
            return days.withColumn("ok", F.lit(False))
        return days.join(self._check(table), "date", "left").select(
            "date", F.coalesce("ok", F.lit(False)).alias("ok")
        )

    def invalid(self, recompute: bool = False, dates: Sequence[date] | None = None) -> list[date]:
        """Dates (of the given ones, or all) of the universe without valid data. Only dates not
        known as valid are checked; fresh results are kept."""
        if recompute:
            self.clear_validation()
        known = set(self.validated())
        left = [d for d in self.partitions() if d not in known and (dates is None or d in dates)]
        if not left:
            return []
        ok = {r["date"] for r in self.check(left).where("ok").collect()}
        if ok:
            self.mark_valid([d for d in left if d in ok])
        return [d for d in left if d not in ok]

    def validate(self, recompute: bool = False) -> None:
        bad = self.invalid(recompute)
        if bad:
            raise ValueError(f"{len(bad)} invalid partitions: {bad}")

    def num_partitions(self) -> int:
        return len(self.partitions())

    def num_validated(self) -> int:
        return len(self.validated())

    def reopened(self) -> list[date]:
        """Valid dates that would see more of the sources now than when they were computed."""
        m = self.commits.read()
        last = self._last() if self._last and self._ahead and m.seen else None
        return [] if last is None else sorted(d for d, x in m.seen.items() if d in m.valid and x < min(d + self._ahead, last))

    # -- computing
    def compute(
        self, dates: Sequence[date] | None = None, recompute: bool = False,
        days_per_batch: int = 30,
    ) -> list[date]:
        """Compute missing dates in batches of days.

        Each batch is written to a folder of its own, checked there, and committed by one manifest:
        its dates then have just the new rows, none where nothing was computed, and those that
        pass the check are valid. A failing batch keeps its old rows, which are no longer valid, and
        does not stop the others; all failed dates are raised together at the end. Returns the
        dates that passed the check.
        """
        if self._compute is None:
            raise TypeError("this table has no compute function")
        wanted = set(self.partitions())
        if dates is not None:
            wanted &= set(dates)
        todo = sorted(wanted if recompute else wanted - (set(self.validated()) - set(self.reopened())))
        done: list[date] = []
        failed: dict[date, str] = {}
        for days in day_batches(todo, days_per_batch):
            try:
                done += self._commit_batch(days)
            except Exception as e:  # noqa: BLE001  (collected and raised below)
                self.unmark(days)
                failed.update({d: f"{type(e).__name__}: {str(e)[:200]}" for d in days})
        if failed:
            first = next(iter(failed.values()))
            raise RuntimeError(f"failed dates {sorted(failed)}; first error: {first}")
        return done

    def _commit_batch(self, days: list[date]) -> list[date]:
        batch = self.commits.new_batch()
        path = self.commits.batch_path(batch)
        last = self._last() if self._last and self._ahead else None  # before the rows are read
        rows = self._compute(days)
        write_partitioned(rows, path, ["date"], self._sort, mode="append")
        made = {date.fromisoformat(n[5:]) for n in children(self.spark, path) if n.startswith("date=")}
        stray = made - set(days)
        if stray:
            raise ValueError(f"rows of dates that were not asked for: {sorted(stray)}")
        columns = [f for f in rows.schema if f.name != "date"] + [f for f in rows.schema if f.name == "date"]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in columns]).json()
        fresh = Manifest(folders={d: batch if d in made else NONE for d in days}, schema=schema)
        ok = {r["date"] for r in self._check(self._table(fresh, days)).where("ok").collect()}
        self.commits.commit(lambda m: replace(
            m, folders=m.folders | fresh.folders, valid=(m.valid - set(days)) | (ok & set(days)), schema=schema,
            seen=m.seen if last is None else m.seen | dict.fromkeys(days, last),
        ))
        return [d for d in days if d in ok]


def day_batches(dates: list[date], days: int) -> list[list[date]]:
    """Chunks of at most ``days`` dates, in order."""
    return [dates[i : i + days] for i in range(0, len(dates), days)]


def bar_table(
    spark: SparkSession, trades: DataFrame, universe: DataFrame, path: str, every: timedelta,
    **bar_options,
) -> DateTable:
    """Bars of a trade table as an incremental table."""

    def compute(dates: list[date]) -> DataFrame:
        return time_bars(trades.where(F.col("date").isin(dates)), every, **bar_options)

    return DateTable(spark, path, universe, compute)
