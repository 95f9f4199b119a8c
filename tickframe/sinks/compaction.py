"""Small feed files into one table partitioned by date and symbol; file audit."""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickframe.functions.times import as_col
from tickframe.session import scratch_path
from tickframe.sinks.files import exists, remove
from tickframe.sinks.tables import write_partitioned, write_table

# Fixed pattern: <kind>/<symbol>_<yy-MM-dd HH:mm:ss>.pq; "-" may stand for ":" in the time,
# because not every file system allows colons.
_NAME = r"([^/]+)/([^/]+)_(\d{2}-\d{2}-\d{2} \d{2}[:-]\d{2}[:-]\d{2})\.pq$"


def file_parts(path: str | Column) -> Column:
    """Struct (kind, symbol, file_time) of a small file's path; NULLs when it does not fit."""
    p = F.regexp_replace(F.regexp_replace(as_col(path), "%20", " "), "%3A", ":")
    stamp = F.regexp_replace(F.regexp_extract(p, _NAME, 3), "[: ]", "-")
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(p, _NAME, i), F.lit(""))

    return F.struct(
        part(1).alias("kind"), part(2).alias("symbol"),
        F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yy-MM-dd-HH-mm-ss"))
        .cast("timestamp_ntz").alias("file_time"),
    )


SOURCE = "source_file"


def finished_files(spark: SparkSession, source: str) -> DataFrame:
    """(path, kind, symbol, file_time) of the small files that have a newer one of their kind and
    symbol. Only the listing is read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.pq").option("recursiveFileLookup", True)
        .load(source).select("path").withColumn("f", file_parts("path")).where("f.symbol IS NOT NULL")
        .select("path", "f.*")
    )
    newest = files.groupBy("kind", "symbol").agg(F.max("file_time").alias("newest"))
    return files.join(newest, ["kind", "symbol"]).where("file_time < newest").drop("newest")


def compact(
    spark: SparkSession, source: str, target: str, time: str = "time", compression: str = "zstd",
) -> DataFrame:
    """Merge the finished small files ``source/<kind>/...`` into ``target/<kind>/date=/symbol=``.

    The rows keep the name of their file (column ``source_file``), and rows of a file that is
    merged again replace the earlier ones: a run may be repeated, also one that stopped half way.
    A kind's partitions are written to staging first, so nothing is read and overwritten in one
    plan. Returns the list of merged files (path, kind, symbol, file_time).
    """
    done = write_table(finished_files(spark, source), scratch_path(spark, "compact-files"))
    for row in done.select("kind").distinct().collect():  # one per kind of feed
        _compact_kind(spark, f"{source}/{row['kind']}", f"{target}/{row['kind']}", done, time, compression)
    return done


def _compact_kind(spark, source, target, done, time, compression) -> None:
    rows = (
        spark.read.option("pathGlobFilter", "*.pq").option("recursiveFileLookup", True).parquet(source)
        .withColumn(SOURCE, file_name("_metadata.file_path"))
    )
    names = done.select(file_name("path").alias(SOURCE), F.col("symbol").alias("__symbol")).distinct()
    kept = [c for c in rows.columns if c not in ("symbol", "date")]
    picked = rows.join(names, SOURCE).select(
        *kept, F.col("__symbol").alias("symbol"), F.to_date(time).alias("date")
    )
    if exists(spark, target):
        old = spark.read.parquet(target)
        touched = picked.select("symbol", "date").distinct()
        old = old.join(touched, ["symbol", "date"], "left_semi").join(names, SOURCE, "left_anti")
        picked = picked.unionByName(old.select(*picked.columns), allowMissingColumns=True)
    staging = scratch_path(spark, "compact-rows")
    staged = write_table(picked, staging)
    write_partitioned(staged, target, ["date", "symbol"], time, compression)
    remove(spark, staging)


def file_name(path: str | Column) -> Column:
    """The last part of a path, the same for escaped and plain forms."""
    p = F.regexp_replace(F.regexp_replace(as_col(path), "%20", " "), "%3A", ":")
    return F.regexp_extract(p, r"[^/]+$", 0)


def drop_files(spark: SparkSession, merged: DataFrame) -> int:
    """Delete merged source files, after their rows are safe in the target."""
    n = 0
    for r in merged.select("path").toLocalIterator():
        n += bool(remove(spark, r["path"].replace("%20", " ").replace("%3A", ":")))
    return n


def audit_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Open each parquet file's footer and first row: (path, ok, n_rows, symbol, date, error).

    Bad files are listed, never deleted. The file list is spread over tasks.
    """

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for p in batch[path]:
                try:
                    fs, name = pafs.FileSystem.from_uri(p)
                    with fs.open_input_file(name) as f:
                        pf = pq.ParquetFile(f)
                        first = next(pf.iter_batches(batch_size=1), None)
                        row = first.to_pylist()[0] if first is not None and len(first) else {}
                        parts = dict(x.split("=", 1) for x in name.split("/") if "=" in x)
                        row = {**parts, **row}
                        out.append((p, True, pf.metadata.num_rows, str(row.get("symbol", "")),
                                    str(row.get("date", "")), None))
                except Exception as e:  # noqa: BLE001  (reported per file)
                    out.append((p, False, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(
                out, columns=["path", "ok", "n_rows", "symbol", "date", "error"]
            ).astype({"n_rows": "Int64"})

    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return files.select(path).repartition(n, path).mapInPandas(
        check, "path string, ok boolean, n_rows bigint, symbol string, date string, error string"
    )
