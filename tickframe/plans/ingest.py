"""Trade ingest: what is missing, raw files to typed partitions, per-file status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickframe.operators.tables import missing_pairs
from tickframe.session import scratch_path
from tickframe.sinks.files import exists
from tickframe.sinks.tables import write_partitioned, write_table
from tickframe.sources.listing import pairs_on_disk
from tickframe.sources.trades import read_zipped, with_symbol_date


@dataclass
class Ingest:
    """Raw zip archives named ``<symbol>-trades-<date>.zip`` into a hive table."""

    spark: SparkSession
    raw: str
    hive: str
    kind: str = "spot"
    peg_symbol: str = "USDT"

    def on_disk(self) -> DataFrame:
        if not exists(self.spark, self.hive):
            return self.spark.createDataFrame([], "symbol string, date date")
        return pairs_on_disk(self.spark.read.parquet(self.hive))

    def missing(self, universe: DataFrame) -> DataFrame:
        return missing_pairs(universe, self.on_disk())

    def update(self, universe: DataFrame) -> DataFrame:
        """Ingest the missing pairs. Returns one row per pair of the universe with a status:
        skipped (was there), success, failed (no file, or one that cannot be read to its end;
        none of its rows is kept). Success means read whole, also when it holds no rows."""
        # fixed before anything is written: both lists must not see this run's partitions
        before = write_table(self.on_disk(), scratch_path(self.spark, "had"))
        todo = write_table(
            missing_pairs(universe, before), scratch_path(self.spark, "todo")
        )
        known = self.spark.read.format("binaryFile").load(self.raw).select("path")
        found = with_symbol_date(known, F.col("path")).join(todo, ["symbol", "date"], "left_semi")
        # Everything goes to staging first: an archive may prove broken after its first rows.
        staged = write_table(
            with_symbol_date(read_zipped(found, self.kind), F.col("path")), scratch_path(self.spark, "staged")
        )
        ends = staged.where("error IS NOT NULL").select("path", "symbol", "date", "error")
        whole = ends.groupBy("symbol", "date").agg((F.max("error") == "").alias("__ok")).where("__ok")
        good = (
            staged.where("error IS NULL").join(whole, ["symbol", "date"], "left_semi")
            .drop("error", "path").withColumn("peg_symbol", F.lit(self.peg_symbol))
        )
        if not good.isEmpty():
            write_partitioned(good, self.hive, ["date", "symbol"], "time")
        all_pairs = universe.select("symbol", "date").distinct()
        had = before.withColumn("__had", F.lit(True))
        j = all_pairs.join(had, ["symbol", "date"], "left").join(whole, ["symbol", "date"], "left")
        s = F.when(F.col("__had"), "skipped").when(F.col("__ok"), "success").otherwise("failed")
        return j.select("symbol", "date", s.alias("status"))


def update_summary(status: DataFrame) -> DataFrame:
    """Counts of a run: total, success, skipped, failed."""
    return status.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "skipped", "failed")],
    )


def ensure_ready(ingest: Ingest, universe: DataFrame) -> None:
    """Raise unless every pair of the universe is in the table."""
    left = ingest.missing(universe)
    if not left.isEmpty():
        raise RuntimeError(f"{left.count()} (symbol, date) pairs are missing")
