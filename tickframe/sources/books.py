"""Archived book snapshots: one JSON line per snapshot, files per hour and symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickframe.schema import BOOK_ARCHIVE_JSON
from tickframe.streaming.messages import flat_levels


def read_book_archive(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(levels, rejected lines). The symbol comes from the file name, and a line must carry the
    same symbol, version 1, the book channel and exactly two sides.

    Plain, gzip and zstd text are read; other frames must be decompressed first.
    """
    lines = spark.read.text(path).select(
        F.trim("value").alias("line"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1).alias("symbol"),
    ).where("line <> ''")
    # As a generator's output: each line is parsed once, not once per condition and use.
    r = lines.select("*", F.explode(F.array(F.from_json("line", BOOK_ARCHIVE_JSON))).alias("r"))
    ok = F.coalesce(
        (F.col("r.ver_num") == 1) & (F.col("r.raw.channel") == "l2Book")
        & (F.col("r.raw.data.coin") == F.col("symbol"))
        & (F.size("r.raw.data.levels") == 2),
        F.lit(False),
    )
    good = r.where(ok).select(
        "symbol",
        F.to_timestamp("r.time").alias("received_time"),
        F.timestamp_millis("r.raw.data.time").alias("time"),
        F.col("r.raw.data.levels").alias("levels"),
    )
    return flat_levels(good), r.where(~ok).select("symbol", "line")
