"""Tables written and read back: partitions, incremental compute, files, compaction."""

from __future__ import annotations

import datetime as dt
from datetime import timedelta

from pyspark.sql import functions as F

from registry.base import (
    BAR_COLS, BARS10_SQL, M10, SCALE, query, stored, table, ticks, tk_sql,
)
from registry.curves import CURVE_SQL, _input
from registry.feeds import BOOK_SQL, book_messages
from tickframe.functions.times import micros
from tickframe.operators.curves import CurveStore
from tickframe.plans.dataset import DateTable, bar_table
from tickframe.plans.ingest import Ingest, update_summary
from tickframe.session import scratch_path
from tickframe.sinks.compaction import audit_files, compact, file_parts
from tickframe.sinks.files import children, rename
from tickframe.sinks.tables import cached_result, write_partitioned, write_table
from tickframe.sources.books import read_book_archive
from tickframe.sources.listing import one_pair, pairs_in_folders, pairs_on_disk
from tickframe.sources.trades import read_futures_csv, read_spot_csv, read_table

FROM, TO = dt.date(2024, 1, 5), dt.date(2024, 1, 12)


@query(
    "table_by_date",
    f"WITH {tk_sql()} SELECT date, symbol, time, trade_id, price FROM tk "
    "WHERE date IN (DATE '2024-01-05', DATE '2024-01-12')",
)
def table_by_date(spark, sf):
    path = scratch_path(spark, "by-date")
    write_partitioned(ticks(spark, sf), path)
    return read_table(spark, path, [FROM, TO]).select(
        "date", "symbol", "time", "trade_id", "price"
    )


@query(
    "table_by_peg_and_date",
    f"WITH {tk_sql()} SELECT CASE WHEN trade_id % 2 = 0 THEN 'USDT' ELSE 'USDC' END AS "
    "peg_symbol, date, count(*) AS n FROM tk GROUP BY 1, 2",
)
def table_by_peg_and_date(spark, sf):
    path = scratch_path(spark, "by-peg")
    peg = F.when(F.col("trade_id") % 2 == 0, "USDT").otherwise("USDC")
    write_partitioned(ticks(spark, sf).withColumn("peg_symbol", peg), path, ["peg_symbol", "date"])
    return read_table(spark, path).groupBy("peg_symbol", "date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "inventory",
    f"WITH {tk_sql('user_id')} SELECT DISTINCT symbol, date FROM tk",
)
def inventory(spark, sf):
    path = scratch_path(spark, "inventory")
    t = ticks(spark, sf, "user_id")
    write_partitioned(t, path)
    cached = t.where("day(date) <= 10").select("symbol", "date").distinct()
    return pairs_on_disk(spark.read.parquet(path), cached)


@query("inventory_folders", f"WITH {tk_sql()} SELECT DISTINCT symbol, date FROM tk")
def inventory_folders(spark, sf):
    """From folder names; the first ten days are complete and come from the inventory."""
    path = scratch_path(spark, "inventory")
    t = ticks(spark, sf)
    write_partitioned(t, path, ["date", "symbol"])
    cached = t.where("day(date) <= 10").select("symbol", "date").distinct()
    complete = [r[0] for r in cached.select("date").distinct().collect()]
    return pairs_in_folders(spark, path, cached, complete)


@query(
    "partition_validity",
    f"WITH {tk_sql()} SELECT date, (day(date) % 4 <> 0) AS ok FROM tk GROUP BY date",
)
def partition_validity(spark, sf):
    path = scratch_path(spark, "validity")
    t = ticks(spark, sf)
    write_partitioned(t.where("day(date) % 4 <> 0"), path)
    return DateTable(spark, path, t.select("symbol", "date")).check()


@query("bars_incremental", f"WITH {BARS10_SQL} SELECT {BAR_COLS} FROM bars", digits=None)
def bars_incremental(spark, sf):
    t = ticks(spark, sf)
    path = scratch_path(spark, "bars")
    b = bar_table(spark, t, t.select("symbol", "date"), path, M10, scale=SCALE)
    b.compute([d for d in b.partitions() if d.day <= 10], days_per_batch=6)
    b.compute(days_per_batch=30)
    return b[None].select(*[c.strip() for c in BAR_COLS.split(",")])


@query(
    "recompute_shrinks",
    f"""WITH {tk_sql()}, kept AS (
  SELECT symbol, date, round(sum(CASE WHEN day(date) BETWEEN 5 AND 12 THEN 2 * price ELSE price END), 4) AS value, count(*) AS n
  FROM tk WHERE NOT (day(date) BETWEEN 5 AND 12 AND day(date) % 3 = 0) GROUP BY symbol, date),
days AS (SELECT date, sum(n) > 1 AS ok FROM kept GROUP BY date)
SELECT symbol, date, n, value, ok AS valid FROM kept JOIN days USING (date)""",
    digits=4,
)
def recompute_shrinks(spark, sf):
    """A table computed once, then again for some dates, of which every third now has no rows."""
    t = ticks(spark, sf)
    late = {"again": False}

    def compute(dates):
        rows = t.where(F.col("date").isin(dates))
        if late["again"]:
            rows = rows.where(F.day("date") % 3 != 0).withColumn("price", F.col("price") * 2)
        value = F.sum(F.col("price").cast("decimal(28, 4)")).cast("double")
        return rows.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("n"), value.alias("value"))

    many = lambda table: table.groupBy("date").agg((F.sum("n") > 1).alias("ok"))
    d = DateTable(spark, scratch_path(spark, "shrinks"), t.select("symbol", "date"), compute, check=many, sort="symbol")
    d.compute(days_per_batch=10)
    late["again"] = True
    d.compute([x for x in d.partitions() if 5 <= x.day <= 12], recompute=True)
    valid = spark.createDataFrame([(x,) for x in d.validated()], "date date").withColumn("valid", F.lit(True))
    rows = d.read().join(valid, "date", "left")
    return rows.select("symbol", "date", "n", "value", F.coalesce("valid", F.lit(False)).alias("valid"))


@query(
    "csv_spot",
    "SELECT event_id AS trade_id, round(value, 6) AS price, "
    "CAST(1 + event_id % 7 AS DOUBLE) AS quantity, "
    "date_trunc('millisecond', ts) AS time, event_id % 2 = 0 AS is_buyer_maker FROM events",
)
def csv_spot(spark, sf):
    path = scratch_path(spark, "csv-spot")
    ms = F.floor(micros("time") / 1000).cast("long")
    ticks(spark, sf).select(
        "trade_id", "price", "quantity", "quote_quantity", ms.alias("time"), "is_buyer_maker",
        F.lit(True).alias("is_best_match"),
    ).write.option("header", False).option("compression", "gzip").csv(path)
    return read_spot_csv(spark, path).select(
        "trade_id", "price", "quantity", "time", "is_buyer_maker"
    )


@query(
    "csv_futures",
    "SELECT event_id AS trade_id, round(value, 6) AS price, "
    "CAST(1 + event_id % 7 AS DOUBLE) AS quantity, round(value * (1 + event_id % 7), 6) AS "
    "quote_quantity, date_trunc('millisecond', ts) AS time, event_id % 2 = 0 AS is_buyer_maker "
    "FROM events",
)
def csv_futures(spark, sf):
    path = scratch_path(spark, "csv-futures")
    ms = F.floor(micros("time") / 1000).cast("long")
    ticks(spark, sf).select(
        F.col("trade_id").alias("id"), "price", F.col("quantity").alias("qty"),
        F.col("quote_quantity").alias("quote_qty"), ms.alias("time"), "is_buyer_maker",
    ).write.option("header", True).csv(path)
    return read_futures_csv(spark, path)


@query(
    "result_cache",
    "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
)
def result_cache(spark, sf):
    root = scratch_path(spark, "cache")

    @cached_result(spark, root, version=2)
    def flags():
        return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("n")
        )

    flags()
    return flags()


@query(
    "file_audit",
    f"WITH {tk_sql()} SELECT CAST(date AS VARCHAR) AS date, true AS ok, count(*) AS n_rows FROM tk GROUP BY date",
)
def file_audit(spark, sf):
    path = scratch_path(spark, "audit")
    write_partitioned(ticks(spark, sf), path)
    files = read_table(spark, path).select(F.col("_metadata.file_path").alias("path")).distinct()
    return audit_files(files).groupBy("date", "ok").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "file_names",
    """SELECT event_id, 'trades' AS kind, event_type AS symbol,
  date_trunc('second', ts) AS file_time FROM events""",
)
def file_names(spark, sf):
    p = F.concat(
        F.lit("/live/trades/"), "event_type", F.lit("_"),
        F.date_format("ts", "yy-MM-dd HH:mm:ss"), F.lit(".pq"),
    )
    return table(spark, sf, "events").select("event_id", file_parts(p).alias("f")).select(
        "event_id", "f.*"
    )


@query(
    "compacted",
    f"""WITH {tk_sql()}, w AS (SELECT *, CASE WHEN trade_id % 3 = 0 THEN 'bbo' ELSE 'trades' END AS kind,
    (day(date) - 1) // 7 AS week FROM tk),
n AS (SELECT kind, symbol, max(week) AS newest FROM w GROUP BY kind, symbol)
SELECT w.kind, w.symbol, w.date, w.time, w.trade_id, w.price FROM w JOIN n USING (kind, symbol)
WHERE week < newest""",
)
def compacted(spark, sf):
    """Two kinds of feed, merged twice into one target: the second run changes nothing."""
    source, target = scratch_path(spark, "small"), scratch_path(spark, "merged")
    week = F.floor((F.day("date") - 1) / 7)
    (
        ticks(spark, sf).select("time", "trade_id", "price", week.alias("week"), F.concat_ws(
            "-", F.when(F.col("trade_id") % 3 == 0, "bbo").otherwise("trades"), "symbol").alias("s"))
        .repartition("s", "week").write.partitionBy("s", "week")
        .parquet(f"{source}-parts")
    )
    # give the files the feed recorder's names: <symbol>_<time>.pq
    for kind in ("bbo", "trades"):
        _mkdir(spark, f"{source}/{kind}")
    for s in children(spark, f"{source}-parts"):
        for w in children(spark, f"{source}-parts/{s}") if s.startswith("s=") else []:
            folder = f"{source}-parts/{s}/{w}"
            for i, f in enumerate(n for n in children(spark, folder) if n.endswith(".parquet")):
                stamp = f"24-01-{1 + int(w.split('=')[1]) * 7:02d} 00-00-{i:02d}"
                kind, _, symbol = s.split("=")[1].partition("-")
                rename(spark, f"{folder}/{f}", f"{source}/{kind}/{symbol}_{stamp}.pq")
    for _ in range(2):
        compact(spark, source, target)
    one = lambda kind: spark.read.parquet(f"{target}/{kind}").withColumn("kind", F.lit(kind))
    return one("bbo").unionByName(one("trades")).select("kind", "symbol", "date", "time", "trade_id", "price")


def _mkdir(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


@query(
    "curve_stored",
    "WITH lineitem AS (SELECT * FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 40), "
    + CURVE_SQL
    + " SELECT l_extendedprice, l_quantity, l_discount, CAST(tie AS VARCHAR) AS tie, round(weight_norm, 6) AS weight_norm,"
    " round(l_discount_cumsum, 6) AS l_discount_cumsum FROM c",
)
def curve_stored(spark, sf):
    path = scratch_path(spark, "curves")
    d = _input(spark, sf)
    store = CurveStore.create(d, path, ["l_discount", "tie"], ["l_extendedprice"], "l_quantity")
    store.set_range("l_quantity", 10.0, 40.0)
    again = CurveStore(spark, path)
    again.options.accum = ["l_discount"]
    curve, _ = again.curves("tie")["l_extendedprice"]
    return curve.withColumn("tie", F.col("tie").cast("string"))


# ---- raw archives ----------------------------------------------------------------------

def _archives(spark, t) -> str:
    """Daily zip archives ``<symbol>-trades-<date>.zip`` of the spot layout."""
    parts, out = scratch_path(spark, "zip-csv"), scratch_path(spark, "zip")
    ms = F.floor(micros("time") / 1000).cast("long")
    (
        t.select("trade_id", "price", "quantity", "quote_quantity", ms.alias("time"),
                 "is_buyer_maker", F.lit(True).alias("best"), F.col("symbol").alias("s"),
                 F.col("date").alias("d"))
        .repartition("s", "d").write.partitionBy("s", "d").option("header", False).csv(parts)
    )

    def pack(batches):
        import io
        import zipfile

        import pandas as pd
        import pyarrow.fs as pafs

        for batch in batches:
            done = []
            for path, content in zip(batch["path"], batch["content"]):
                tags = dict(x.split("=", 1) for x in path.split("/") if "=" in x)
                name = f"{tags['s']}-trades-{tags['d']}"
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(f"{name}.csv", content)
                fs, folder = pafs.FileSystem.from_uri(out)
                fs.create_dir(folder, recursive=True)
                data = bytearray(buf.getvalue())
                if tags["d"][-1] == "3":
                    data = data[: len(data) // 2]
                elif tags["d"][-1] == "7":  # inside the packed rows, behind the member's header
                    data[30 + len(f"{name}.csv") + 9] ^= 0x55
                with fs.open_output_stream(f"{folder}/{name}.zip") as f:
                    f.write(bytes(data))
                done.append(name)
            yield pd.DataFrame({"name": done})

    csvs = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").load(parts).select("path", "content")
    )
    csvs.mapInPandas(pack, "name string").count()
    return out


def _ingested(spark, sf):
    """Archives exist for four days out of five, those of days 3, 13 and 23 are cut short and those
    of days 7, 17 and 27 have a changed byte; every tenth day is already in the table."""
    t = ticks(spark, sf)
    job = Ingest(spark, _archives(spark, t.where("day(date) % 5 <> 0")), scratch_path(spark, "hive"))
    ready = t.where("day(date) % 10 = 0").withColumns(
        {"peg_symbol": F.lit("USDT"), "is_best_match": F.lit(True)}
    )
    write_partitioned(ready, job.hive, ["date", "symbol"])
    return job, stored(job.update(t.select("symbol", "date")), "status")


STATUS = (
    "CASE WHEN day(date) % 10 = 0 THEN 'skipped' WHEN day(date) % 10 IN (3, 5, 7) THEN 'failed' "
    "ELSE 'success' END"
)


@query(
    "ingest_status",
    f"WITH {tk_sql()} SELECT DISTINCT symbol, date, {STATUS} AS status FROM tk",
)
def ingest_status(spark, sf):
    return _ingested(spark, sf)[1]


@query(
    "ingest_summary",
    f"""WITH {tk_sql()}, s AS (SELECT DISTINCT symbol, date, {STATUS} AS status FROM tk)
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success,
  count(*) FILTER (WHERE status = 'skipped') AS skipped,
  count(*) FILTER (WHERE status = 'failed') AS failed FROM s""",
)
def ingest_summary(spark, sf):
    return update_summary(_ingested(spark, sf)[1])


@query(
    "ingested_trades",
    f"""WITH {tk_sql()} SELECT symbol, date, trade_id, round(price, 6) AS price, quantity,
  date_trunc('millisecond', time) AS time, is_buyer_maker FROM tk
WHERE day(date) % 10 NOT IN (3, 5, 7)""",
)
def ingested_trades(spark, sf):
    job, _ = _ingested(spark, sf)
    return spark.read.parquet(job.hive).withColumn("time", F.date_trunc("millisecond", "time").cast("timestamp_ntz")).select(
        "symbol", "date", "trade_id", "price", "quantity", "time", "is_buyer_maker"
    )


@query(
    "one_symbol_date",
    f"WITH {tk_sql()} SELECT symbol, date, trade_id, price FROM tk "
    "WHERE symbol = 'click' AND date = DATE '2024-01-08'",
)
def one_symbol_date(spark, sf):
    t = ticks(spark, sf).select("symbol", "date", "trade_id", "price")
    return one_pair(t, t, "click", dt.date(2024, 1, 8))


@query(
    "book_archive",
    f"""WITH {BOOK_SQL}
SELECT symbol, received_time, time, is_bid, CAST(d AS SMALLINT) AS depth,
  round(value + (CASE WHEN is_bid THEN -1 ELSE 1 END) * (d + 1) * 0.5, 6) AS price,
  CAST((d + 1) * (d + 2) / 2 AS DOUBLE) AS csize, CAST(d + 2 AS SMALLINT) AS num_orders
FROM b WHERE epoch_us(received_time) % 20 <> 0""",
)
def book_archive(spark, sf):
    """Archive lines in gzip text files per hour and symbol, as the archive has them, several hours
    to a file; about one line in twenty has a wrong version."""
    parts, folder = scratch_path(spark, "book-parts"), scratch_path(spark, "books")
    raw = F.from_json("value", "channel string, data struct<coin:string,time:bigint,"
                      "levels:array<array<struct<px:string,sz:string,n:bigint>>>>")
    m = book_messages(spark, sf).withColumn("raw", raw)
    wrong = micros("received_time") % 20 == 0
    line = F.to_json(F.struct(
        F.date_format("received_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
        F.when(wrong, 2).otherwise(1).alias("ver_num"), "raw",
    ))
    hour = F.date_trunc("hour", "received_time").alias("hour")
    m.select(line.alias("value"), F.col("raw.data.coin").alias("s"), hour).repartition("s", "hour").drop("hour").write.partitionBy(
        "s"
    ).option("compression", "gzip").text(parts)
    _mkdir(spark, folder)
    for s in (n for n in children(spark, parts) if n.startswith("s=")):
        for i, f in enumerate(n for n in children(spark, f"{parts}/{s}") if n.endswith(".txt.gz")):
            rename(spark, f"{parts}/{s}/{f}", f"{folder}/{s.split('=')[1]}.{i}.txt.gz")
    good, _ = read_book_archive(spark, folder)
    return good.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("received_time", "time")})
