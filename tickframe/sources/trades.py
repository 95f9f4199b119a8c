"""Daily trade files: CSV (plain or compressed) and zip archives."""

from __future__ import annotations

import zipfile
from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickframe.functions.text import date_in
from tickframe.functions.times import from_micros, futures_stamp_us, spot_stamp_us
from tickframe.schema import FUTURES_RENAMES, FUTURES_TRADES, SPOT_TRADES

ZIP_CHUNK_ROWS = 200_000


def read_table(spark: SparkSession, path: str, dates: Sequence | None = None) -> DataFrame:
    """A hive-partitioned table, or only some of its dates (partition pruning)."""
    t = spark.read.parquet(path)
    return t if dates is None else t.where(F.col("date").isin(list(dates)))


def read_spot_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return normalise_spot(spark.read.schema(SPOT_TRADES).option("mode", "FAILFAST").csv(path))


def read_futures_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    raw = (
        spark.read.schema(FUTURES_TRADES).option("header", True).option("mode", "FAILFAST")
        .csv(path)
    )
    return normalise_futures(raw)


def normalise_spot(raw: DataFrame) -> DataFrame:
    return raw.withColumn("time", from_micros(spot_stamp_us("time")))


def normalise_futures(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(FUTURES_RENAMES).withColumn(
        "time", from_micros(futures_stamp_us("time"))
    )


def with_symbol_date(df: DataFrame, path: Column) -> DataFrame:
    """Symbol and date out of ``<symbol>-trades-<date>`` file names."""
    return df.withColumn(
        "symbol", F.regexp_extract(path, r"([^/]+)-trades-\d{4}-\d{2}-\d{2}", 1)
    ).withColumn("date", date_in(F.regexp_extract(path, r"[^/]+$", 0)))


def read_zipped(files: DataFrame, kind: str, path: str = "path") -> DataFrame:
    """Rows of the first CSV member of each archive in ``files``, with its path, then one closing
    row per archive without values: ``error`` tells what went wrong, empty text that all is well.

    Tasks get paths, open their archives one after the other and hand them on in bounded chunks.
    The checksum of a member is known only at its end, so rows may come before an error: use
    those of a path only if its closing row has an empty error.
    """
    spec, header = (SPOT_TRADES, None) if kind == "spot" else (FUTURES_TRADES, 0)
    names = [f.split()[0] for f in spec.split(", ")]
    flags = [f.split()[0] for f in spec.split(", ") if f.endswith("boolean")]
    out = f"path string, error string, {spec}"

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs

        for batch in batches:
            for name in batch["path"]:
                error = ""
                try:
                    fs, place = pafs.FileSystem.from_uri(name)
                    with fs.open_input_file(place) as raw, zipfile.ZipFile(raw) as z:
                        member = next(n for n in z.namelist() if n.endswith(".csv"))
                        with z.open(member) as f:
                            for part in pd.read_csv(f, names=names, header=header, chunksize=ZIP_CHUNK_ROWS):
                                for c in flags:
                                    part[c] = part[c].astype(str).str.lower() == "true"
                                part.insert(0, "error", None)
                                part.insert(0, "path", name)
                                yield part
                except Exception as e:  # noqa: BLE001  (reported per file)
                    error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame({"path": [name], "error": [error], **{n: [None] for n in names}})

    tasks = max(1, files.sparkSession.sparkContext.defaultParallelism)
    rows = files.select(F.col(path).alias("path")).repartition(tasks, "path").mapInPandas(unzip, out)
    return normalise_spot(rows) if kind == "spot" else normalise_futures(rows)
