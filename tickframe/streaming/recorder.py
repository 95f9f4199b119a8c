"""One pass over a message stream: typed tables by payload and symbol, and health by channel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickframe.sinks.files import children, remove
from tickframe.sinks.manifest import NumberedFiles
from tickframe.streaming.feeds import feed_counts, health_ratios
from tickframe.streaming.messages import envelope


class Recorder:
    """Fans micro-batches of messages out to one table per payload.

    ``parsers``: payload -> (channel, parser); a parser gets the messages (value, received_time) of
    its channel only and returns rows with a ``symbol``. A micro-batch is read and cut by channel
    once; each channel is then parsed from its part. Every batch has folders of its own and is
    committed by its number after all of them are written: a batch that is repeated before that
    writes them again, one that is repeated after it does nothing, and readers see committed
    batches only. Messages of other channels, and unreadable ones, are counted.
    """

    def __init__(self, spark: SparkSession, path: str, parsers: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]]):
        self.spark, self.path, self.parsers = spark, path.rstrip("/"), parsers
        self.files = NumberedFiles(spark, f"{self.path}/_commits")

    def record(self, batch: DataFrame, batch_id: int) -> None:
        number = batch_id + 1  # commits are numbered from 1
        if number <= max(self.files.numbers(), default=0):
            return
        raw = f"{self.path}/_parts/batch={batch_id}"
        text = batch if "received_time" in batch.columns else batch.withColumn("received_time", F.current_timestamp())
        cut = text.select("value", "received_time", F.json_tuple("value", "channel").alias("channel"))
        named = F.concat(F.lit("c:"), F.col("channel"))  # apart from the folder of null
        cut.withColumn("channel", named).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("channel").parquet(raw)
        if children(self.spark, raw) == ["_SUCCESS"]:  # no messages
            for payload in (*self.parsers, "health"):
                remove(self.spark, self._folder(payload, batch_id))
            self._publish(number, raw)
            return
        parts = self.spark.read.schema("value string, received_time timestamp, channel string").parquet(raw)
        for payload, (channel, parse) in self.parsers.items():
            rows = parse(parts.where(F.col("channel") == f"c:{channel}").select("value", "received_time"))
            rows.hint("rebalance", "symbol").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("symbol").parquet(self._folder(payload, batch_id))
        feed_counts(parts).coalesce(1).write.mode("overwrite").parquet(self._folder("health", batch_id))
        self._publish(number, raw)

    def _publish(self, number: int, raw: str) -> None:
        if not self.files.publish(number, "{}"):
            raise RuntimeError(f"two streams write {self.path}")
        remove(self.spark, raw)

    def _folder(self, payload: str, batch_id: int) -> str:
        return f"{self.path}/payload={payload}/batch={batch_id}"

    def start(self, messages: DataFrame, checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
        w = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.record)
        return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()

    def read(self, payload: str, after: int = -1) -> DataFrame:
        """Rows of a payload from the committed batches, or those after a batch."""
        root = f"{self.path}/payload={payload}"
        done = {f"batch={n - 1}" for n in self.files.numbers() if n - 1 > after}
        paths = [f"{root}/{b}" for b in children(self.spark, root) if b in done]
        if not paths:
            raise FileNotFoundError(f"no committed {payload} under {self.path}")
        r = self.spark.read.option("basePath", root)
        if payload in self.parsers:  # symbols stay text, whatever they look like
            empty = self.spark.createDataFrame([], "value string, received_time timestamp")
            r = r.schema(self.parsers[payload][1](empty).schema)
        return r.parquet(*paths).drop("batch")

    def health(self) -> DataFrame:
        """Messages, trades and trades per message by channel over all committed batches."""
        counts = self.read("health").groupBy("channel").agg(
            F.sum("n_messages").alias("n_messages"), F.sum("n_trades").alias("n_trades")
        )
        return health_ratios(counts)


def unrouted(messages: DataFrame, parsers: dict[str, tuple[str, Callable]]) -> DataFrame:
    """Messages that no parser of a recorder takes."""
    known = [channel for channel, _ in parsers.values()]
    return envelope(messages).where(F.col("channel").isNull() | ~F.col("channel").isin(known))
