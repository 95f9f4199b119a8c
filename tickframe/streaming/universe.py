"""Changes of a universe as a stream: which symbols came and went between snapshots."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickframe.functions.times import micros

CHANGES = "source string, time timestamp, symbol string, change string"


class Changes(StatefulProcessor):
    """State of a key: the symbols of its last snapshot, and later snapshots that wait until the
    watermark says that none comes before them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.current = handle.getMapState("current", "symbol string", "us long")
        self.waiting = handle.getListState("waiting", "ms long, time timestamp, symbols array<string>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        new = [(r["us"] // 1000, r["time"], r["symbols"]) for r in rows if r["us"] // 1000 >= mark]
        if new:
            self.waiting.appendList(new)
            self.handle.registerTimer(min(r[0] for r in new) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = [tuple(r) for r in self.waiting.get()]
        ripe = sorted((r for r in held if r[0] < mark), key=lambda r: r[1])
        if not ripe:
            return
        made = Row("source", "time", "symbol", "change")
        merged: dict = {}
        for _, time, symbols in ripe:  # parts of one snapshot belong together
            merged.setdefault(time, set()).update(s for s in symbols or () if s is not None)
        before = {k[0] for k in self.current.keys()}
        now = set(before)
        for time, symbols in merged.items():
            for symbol in sorted(symbols - now):
                yield made(key[0], time, symbol, "added")
            for symbol in sorted(now - symbols):
                yield made(key[0], time, symbol, "removed")
            now = symbols
        for symbol in now - before:
            self.current.updateValue((symbol,), (0,))
        for symbol in before - now:
            self.current.removeKey((symbol,))
        left = [r for r in held if r[0] >= mark]
        if left:
            self.waiting.put(left)
            self.handle.registerTimer(min(r[0] for r in left) + 1)
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def universe_changes(snapshots: DataFrame, lateness: str, parts: int = 8) -> DataFrame:
    """(source, time, symbol, change): what each snapshot added to, or removed from, the one before.

    ``snapshots``: a stream of (source, time, symbols array<string>), one row per snapshot or several of
    one time that belong together; an empty array is a universe without symbols. The first snapshot
    of a source adds all of its symbols. Snapshots count in the order of their time, whatever the order
    of arrival within ``lateness``; later ones are left out, as are those without a source or time.
    The symbols of a source are dealt to ``parts`` keys by hash, each with its share of the state.
    Start the query with ``start_relay``, which chooses the state store.
    """
    of_part = F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda p: F.struct(p.alias("part"), F.filter("symbols", lambda s: F.pmod(F.xxhash64(s), F.lit(parts)) == p).alias("symbols")),
    )
    known = snapshots.where(F.col("source").isNotNull() & F.col("time").isNotNull())
    dealt = known.select(
        "source", F.col("time").cast("timestamp").alias("time"), micros("time").alias("us"), F.explode(of_part).alias("p")
    ).select("source", "time", "us", F.col("p.part").alias("part"), F.col("p.symbols").alias("symbols"))
    return dealt.withWatermark("time", lateness).groupBy("source", "part").transformWithState(
        statefulProcessor=Changes(), outputStructType=CHANGES, outputMode="Append", timeMode="EventTime",
    )
