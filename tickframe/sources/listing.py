"""Universes: from object-key listings, from tables on disk, and within date bounds."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickframe.functions.text import date_in
from tickframe.sinks.files import children

# Fixed pattern: "<symbol>-trades-<date>.zip" at the end of a key.
_SYMBOL = r"([^/]+)-trades-\d{4}-\d{2}-\d{2}\.zip$"


def keys_to_universe(keys: DataFrame, key: str = "key", suffix: str = ".zip") -> DataFrame:
    """Object keys of daily files to distinct (symbol, date); checksum files fall out."""
    k = F.col(key)
    return (
        keys.where(k.endswith(suffix))
        .select(F.regexp_extract(k, _SYMBOL, 1).alias("symbol"), date_in(k).alias("date"))
        .where("symbol <> '' AND date IS NOT NULL")
        .distinct()
    )


def universe_between(
    universe: DataFrame, first: date | str | None, last: date | str | None
) -> DataFrame:
    u = universe
    if first is not None:
        u = u.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        u = u.where(F.col("date") <= F.lit(last).cast("date"))
    return u


def pairs_on_disk(table: DataFrame, cached: DataFrame | None = None) -> DataFrame:
    """(symbol, date) pairs of a partitioned table, added to a cached inventory.

    Only the two columns are read, of all files; pairs that the inventory already holds are dropped
    before the union. Where symbols have folders, ``pairs_in_folders`` reads nothing.
    """
    found = table.select("symbol", "date").distinct()
    if cached is None:
        return found
    new = found.join(cached.select("symbol", "date"), ["symbol", "date"], "left_anti")
    return cached.select("symbol", "date").unionByName(new)


def pairs_in_folders(
    spark: SparkSession, path: str, cached: DataFrame | None = None, complete: Collection[date] = (),
) -> DataFrame:
    """(symbol, date) pairs of a table in folders ``date=.../symbol=...``, from the names of its files alone.

    Folders of dates are listed first; those in ``complete`` are not looked into: their pairs come
    from ``cached``. The others are listed by Spark, many of them in parallel, and no file is opened.
    A pair without files is absent; a null symbol's folder gives a null.
    """
    found = {n: date.fromisoformat(n[5:]) for n in children(spark, path) if n.startswith("date=") and n[5:6].isdigit()}
    todo = [f"{path}/{n}" for n, d in sorted(found.items()) if d not in set(complete)]
    if todo:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(todo).select("path")
        name = F.regexp_extract("path", r"/symbol=([^/]+)/[^/]+$", 1)
        day = F.regexp_extract("path", r"/date=([^/]+)/symbol=", 1).cast("date")
        # partition names escape some characters as %XX; a plus sign is itself
        symbol = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        pairs = files.select(F.when(name != "__HIVE_DEFAULT_PARTITION__", symbol).alias("symbol"), day.alias("date")).where("date IS NOT NULL").distinct()
    else:
        pairs = spark.createDataFrame([], "symbol string, date date")
    if cached is None or not complete:
        return pairs
    return pairs.union(cached.select("symbol", "date").where(F.col("date").isin(list(complete))))


def one_pair(table: DataFrame, universe: DataFrame, symbol: str, day: date) -> DataFrame:
    """Rows of one (symbol, date); an error when the pair is not in the universe."""
    pick = (F.col("symbol") == symbol) & (F.col("date") == F.lit(day))
    if universe.where(pick).isEmpty():
        raise KeyError(f"({symbol}, {day}) is not in the universe")
    return table.where(pick)
