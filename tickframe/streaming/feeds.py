"""Streams over feeds: reading, current values, bars, stitching, health, sinks."""

from __future__ import annotations

import json
import uuid
from datetime import timedelta
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickframe.functions.times import floor_us, from_micros, micros
from tickframe.operators.bars import bar_columns, bar_measures, order_key
from tickframe.sinks.files import children, remove
from tickframe.sinks.manifest import NumberedFiles
from tickframe.streaming.messages import CONTROL, TRADES, envelope


def message_stream(spark: SparkSession, fmt: str = "text", **options) -> DataFrame:
    """Raw messages as a stream with a text column ``value``: files, or Kafka by options."""
    path = options.pop("path", None)
    r = spark.readStream.format(fmt).options(**options)
    s = r.load(path) if path else r.load()
    if fmt == "kafka":
        s = s.select(F.col("value").cast("string").alias("value"),
                     F.col("timestamp").alias("received_time"))
    return s


def table_stream(
    spark: SparkSession, path: str, schema, files: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A parquet folder as a stream."""
    r = spark.readStream.schema(schema)
    if files:
        r = r.option("pathGlobFilter", files)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def as_text(df: DataFrame) -> DataFrame:
    """Any typed stream as JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def current_values(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """Latest row per key; for a stream, run it in update or complete mode."""
    rest = [c for c in df.columns if c not in by]
    last = F.max_by(F.struct(*rest), F.struct(F.col(time), *[c for c in rest if c != time]))
    return df.groupBy(*by).agg(last.alias("r")).select(*by, "r.*")


def streaming_bars(
    trades: DataFrame, every: timedelta, lateness: str, time: str = "time",
    tie: Sequence[str] = ("trade_id",), scale: int | None = None,
) -> DataFrame:
    """Batch bars on a stream: same columns, state bounded by the watermark.

    ``time`` may be TIMESTAMP or TIMESTAMP_NTZ (the watermark needs the former). In append
    mode a bar comes out once the watermark passes its end; in update mode at every change.
    """
    seconds = f"{every.total_seconds()} seconds"
    d = trades.withColumn("__ts", F.col(time).cast("timestamp")).withWatermark("__ts", lateness)
    us = micros("__ts")
    start = floor_us(F.col("__us"), every)
    d = d.withColumn("__us", us).withColumn("__ord", order_key(F.col("__us"), start, every, tie))
    g = d.groupBy("symbol", "date", "peg_symbol", F.window("__ts", seconds).alias("__w")).agg(
        *bar_measures(scale)
    )
    end = from_micros(micros(F.col("__w.end")))
    return bar_columns(g.withColumn("time", end))


def stitch(
    versions: dict[int, DataFrame], ids: Sequence[str], time: str, lateness: str,
    active: DataFrame | None = None, symbol: str = "symbol",
) -> DataFrame:
    """One continuous stream out of several versions of a source.

    ``active`` (symbol, version) names the version that counts per symbol; every row that
    several versions deliver within the watermark comes out once.
    """
    streams = [
        s.withColumn("version", F.lit(v)) for v, s in sorted(versions.items())
    ]
    u = streams[0]
    for s in streams[1:]:
        u = u.unionByName(s)
    if active is not None:
        a = active.select(F.col(symbol).alias("__s"), F.col("version").alias("__v"))
        u = u.join(a, (F.col(symbol) == F.col("__s")) & (F.col("version") == F.col("__v")))
        u = u.drop("__s", "__v")
    u = u.withColumn("__ts", F.col(time).cast("timestamp")).withWatermark("__ts", lateness)
    return u.dropDuplicatesWithinWatermark(list(ids)).drop("__ts", "version")


def feed_health(df: DataFrame, text: str = "value") -> DataFrame:
    """Messages, trades and trades per message by channel; unreadable ones as 'unreadable'."""
    return health_ratios(feed_counts(df, text))


def feed_counts(df: DataFrame, text: str = "value") -> DataFrame:
    """Messages and trades by channel: counts that add up over batches."""
    e = envelope(df, text)
    channel = F.coalesce("channel", F.lit("unreadable"))
    n = F.when(
        F.col("channel") == TRADES, F.size(F.from_json("data", "array<string>"))
    ).otherwise(0)
    return e.groupBy(channel.alias("channel")).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum(F.greatest(n, F.lit(0))).cast("long").alias("n_trades"),
    )


def health_ratios(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "is_control": F.col("channel").isin(*CONTROL),
        "trades_per_message": F.try_divide(
            F.col("n_trades").cast("double"),
            F.when(F.col("channel") == TRADES, F.col("n_messages")),
        ),
    })


def last_update(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """Newest time per key; subtract it from the clock when reading."""
    return df.groupBy(*by).agg(F.max(time).alias("last_update"))


# ---- sinks -----------------------------------------------------------------------------

def file_sink(
    df: DataFrame, path: str, checkpoint: str, by: Sequence[str] = (),
    every: str | None = "30 seconds", name: str | None = None, compression: str = "snappy",
) -> StreamingQuery:
    """Micro-batches to parquet. ``every=None`` drains what is available and stops."""
    w = (
        df.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).option("compression", compression)
        .outputMode("append")
    )
    if by:
        w = w.partitionBy(*by)
    if name:
        w = w.queryName(name)
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    return w.start()


def routed_sink(
    df: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds",
    payload: str = "payload", symbol: str = "symbol",
) -> StreamingQuery:
    """Route rows to folders by payload type and symbol."""
    return file_sink(df, path, checkpoint, (payload, symbol), every)


def record_feeds(
    feeds: dict[str, DataFrame], root: str, every: str | None = "30 seconds"
) -> dict[str, StreamingQuery]:
    """One independent recording query per feed."""
    return {
        n: file_sink(d, f"{root}/{n}", f"{root}/_checkpoints/{n}", every=every, name=n)
        for n, d in feeds.items()
    }


class LatestTable:
    """A table that always holds the newest row per key of an update-mode stream.

    Keys are dealt to ``buckets`` by hash, and each bucket has a folder of its newest version. A
    micro-batch reads and rewrites the buckets that its rows fall into, and no others; then one
    manifest names the new folder of each, so readers see all of a batch or nothing of it. A batch
    that is repeated after its commit does nothing, before it leaves a folder nobody reads.
    Folders that the last ``keep`` manifests do not name are removed.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: str | None, buckets: int = 64, keep: int = 2):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), order
        self.buckets, self.keep = buckets, keep
        self.files = NumberedFiles(spark, f"{path}/_commits")

    def manifest(self) -> dict:
        """``batch``: the last one; ``buckets``: their number; ``folders``: bucket -> version."""
        numbers = self.files.numbers()
        if not numbers:
            return {"number": 0, "batch": -1, "buckets": self.buckets, "folders": {}}
        return json.loads(self.files.read(numbers[-1])) | {"number": numbers[-1]}

    def _rows(self, folders: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/version={v}/bucket={b}" for b, v in sorted(folders.items())]
        return self.spark.read.option("basePath", self.path).parquet(*paths).drop("version", "bucket")

    def read(self) -> DataFrame:
        found = self.manifest()
        if not found["folders"]:
            raise FileNotFoundError(f"no finished version under {self.path}")
        return self._rows(found["folders"])

    def merge(self, batch: DataFrame, batch_id: int) -> list[int]:
        """Take a batch in; the buckets it rewrote."""
        found = self.manifest()
        if batch_id <= found["batch"]:
            return []
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(found["buckets"])).cast("int")
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        rows = batch.withColumn("__b", F.lit(batch_id))
        old = {b: v for b, v in found["folders"].items() if int(b) in touched}
        if old:
            rows = rows.unionByName(self._rows(old).withColumn("__b", F.lit(-1)))
        rank = [F.col(self.order)] if self.order else []
        rest = [c for c in batch.columns if c not in self.keys]
        best = F.max_by(F.struct(*rest), F.struct(*rank, F.col("__b")))
        out = rows.groupBy(*self.keys).agg(best.alias("r")).select(*self.keys, "r.*", bucket.alias("bucket"))
        version = f"v{uuid.uuid4().hex}"
        if touched:
            out.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/version={version}")
        made = {"batch": batch_id, "buckets": found["buckets"], "folders": found["folders"] | {str(b): version for b in touched}}
        if not self.files.publish(found["number"] + 1, json.dumps(made)):
            raise RuntimeError(f"two streams write {self.path}")
        self._clean()
        return sorted(touched)

    def _clean(self) -> None:
        numbers = self.files.numbers()
        held = {v for n in numbers[-self.keep :] for v in json.loads(self.files.read(n))["folders"].values()}
        for n in numbers[: -self.keep]:
            self.files.remove(n)
        for name in children(self.spark, self.path):
            if name.startswith("version=") and name.removeprefix("version=") not in held:
                remove(self.spark, f"{self.path}/{name}")

    def start(
        self, df: DataFrame, checkpoint: str, every: str | None = "30 seconds",
        extra: Callable[[DataFrame, int], None] | None = None,
    ) -> StreamingQuery:
        def on_batch(batch: DataFrame, batch_id: int) -> None:
            self.merge(batch, batch_id)
            if extra:
                extra(batch, batch_id)

        w = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
        return w.foreachBatch(on_batch).start()


def drain(query: StreamingQuery) -> None:
    """Wait for a drain-and-stop query and raise its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def symbol_filter(df: DataFrame, keep: Column) -> DataFrame:
    """Drop empty payloads and unwanted symbols before a sink."""
    return df.where(F.col("symbol").isNotNull() & keep)
