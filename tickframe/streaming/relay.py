"""A relay: several versions of a source as one stream, switched per symbol by a control stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tickframe.functions.times import micros

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INSIDE = ("__key", "__part", "__ts", "__us", "__version")
#: Keys that the rows of a part are dealt to; Python holds the rows of one key at a time.
SHARES = 16
#: Rows that are dealt out to packs at a time, and at most so many in a pack that comes out.
GATHERED, EMITTED = 65_536, 10_000
#: Bytes of packs that are added to a key's state in one call; each call reads what the key holds.
ADDED = 32 << 20


def packed(rows: pa.Table) -> bytes:
    """Rows as one value: an Arrow stream, which keeps all types, nulls and NaN as they are."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpacked(pack: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(pack)).read_all()


def deal(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows to packs of one symbol, part and version, with the latest time and the first microsecond."""
    gathered: list[pa.RecordBatch] = []

    def packs() -> pa.RecordBatch:
        t = pa.Table.from_batches(gathered)
        n = pa.array(np.arange(t.num_rows))
        groups = t.select(["__key", "__part", "__version"]).append_column("__n", n).group_by(["__key", "__part", "__version"])
        groups = groups.aggregate([("__n", "list")])
        held, ts, us, made = t.select([*columns, "__us"]), [], [], []
        for at in groups["__n_list"]:
            rows = held.take(at.values)
            times = np.asarray(rows["__us"])
            us.append(times.min())
            ts.append(times.max())
            made.append(packed(rows))
        return pa.RecordBatch.from_arrays(
            [groups["__key"].combine_chunks(), groups["__part"].combine_chunks(), pa.array(ts, pa.int64()).cast(t.schema.field("__ts").type),
             pa.array(us, pa.int64()), groups["__version"].combine_chunks(), pa.array(made, pa.binary())],
            names=["key", "part", "ts", "us", "version", "rows"],
        )

    for b in batches:
        gathered.append(b)
        if sum(x.num_rows for x in gathered) >= GATHERED:
            yield packs()
            gathered.clear()
    if any(x.num_rows for x in gathered):
        yield packs()


def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for pack in b.column(0):
            yield from unpacked(pack.as_buffer()).to_batches()


class Relay(StatefulProcessor):
    """Holds rows until the watermark says that all switches up to them are known.

    Rows come, wait and go in packs. State of a key: the packs that wait as (first microsecond,
    version, rows), and the switches that still matter as (microseconds, version). A row comes out
    if its version was the active one at its time; of rows with equal ``ids`` one does. Rows and
    switches behind the watermark are late and go.
    """

    def __init__(self, ids: Sequence[str]):
        self.ids = list(ids)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.packs = handle.getListState("packs", "us long, version int, rows binary")
        self.switches = handle.getListState("switches", "us long, version int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        packs, size, first = [], 0, None
        for frame in rows:
            switches = []
            for us, version, pack in frame[["us", "version", "rows"]].itertuples(index=False, name=None):
                if pack is None:
                    if us >= mark:
                        switches.append((int(us), int(version)))
                elif (kept := self._from(mark, int(us), int(version), bytes(pack))) is not None:
                    packs.append(kept)
                    size += len(kept[2])
                    first = kept[0] if first is None else min(first, kept[0])
                    if size >= ADDED:
                        self.packs.appendList(packs)
                        packs, size = [], 0
            if switches:
                self.switches.appendList(switches)
        if packs:
            self.packs.appendList(packs)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        return iter(())

    @staticmethod
    def _from(mark: int, us: int, version: int, pack: bytes) -> tuple[int, int, bytes] | None:
        """A pack without its rows before ``mark``, or None if no row is left."""
        if us >= mark:
            return us, version, pack
        rows = unpacked(pack)
        times = np.asarray(rows["__us"])
        later = times >= mark
        return (int(times[later].min()), version, packed(rows.filter(pa.array(later)))) if later.any() else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        switches = sorted(tuple(s) for s in self.switches.get())
        starts, versions = np.array([s[0] for s in switches], np.int64), np.array([s[1] for s in switches], np.int64)
        ripe, left, some = [], [], False
        for us, version, pack in self.packs.get():
            if us < mark:
                some, rows = True, unpacked(pack)
                times = np.asarray(rows["__us"])
                at = np.searchsorted(starts, times, "right")
                active = (times < mark) & (at > 0)
                active[active] = versions[at[active] - 1] == version
                rows = rows.filter(pa.array(active))
                ripe.append(rows.append_column("version", pa.array(np.full(rows.num_rows, version, np.int32))))
            if (kept := self._from(mark, us, version, bytes(pack))) is not None:
                left.append(kept)
        if not some:
            return  # another timer of the same moment has done it
        yield from self._once(pa.concat_tables(ripe))
        # The last switch before the mark still names the version of what is to come.
        keep = switches[max(int(np.searchsorted(starts, mark)) - 1, 0) :]
        self.switches.put(keep) if keep else self.switches.clear()
        if left:
            self.packs.put(left)
            self.handle.registerTimer(min(p[0] for p in left) // 1000 + 1)
        else:
            self.packs.clear()

    def _once(self, rows: pa.Table) -> Iterator[pd.DataFrame]:
        """In the order of time, of rows with equal ids the first, in packs."""
        rows = rows.take(pa.array(np.argsort(np.asarray(rows["__us"]), kind="stable"))).drop_columns("__us")
        seen: set = set()
        new = [not (name in seen or seen.add(name)) for name in zip(*(rows[c].to_pylist() for c in self.ids))]
        rows = rows.filter(pa.array(new, pa.bool_()))
        for k in range(0, rows.num_rows, EMITTED):
            yield pd.DataFrame({"rows": [packed(rows.slice(k, EMITTED))]})

    def close(self) -> None:
        pass


def relay(
    versions: dict[int, DataFrame], control: DataFrame, ids: Sequence[str], time: str, lateness: str,
    symbol: str = "symbol", parts: int = 1,
) -> DataFrame:
    """One continuous stream of the active version's rows, with the column ``version`` added.

    ``versions``: the sources, of one schema. ``control``: a stream of (symbol, time, version); from
    that time on, and at that time, the version counts for the symbol. Of switches at one time the
    highest version counts. Before a symbol's first switch no version is active and nothing comes out.

    Time is event time: whatever the order of arrival, as long as rows and switches come within
    ``lateness``, every row of the active version comes out once. Where two versions carry the
    same rows around a switch, none is lost and none comes twice. Rows without a symbol or time are
    left out. ``parts`` deals the rows of a symbol to so many parts by their ``ids``, for symbols that
    one task cannot hold; each part has SHARES keys, and each key gets every switch. Rows travel in
    Arrow packs: a Python worker holds those of one key, not those of its task. Start the query with
    ``start_relay``.
    """
    first = next(iter(versions.values()))
    columns = first.columns
    clash = set(columns) & {*INSIDE, "version"}
    if clash:
        raise ValueError(f"columns with names used inside: {sorted(clash)}")
    keys = parts * SHARES
    part = F.pmod(F.xxhash64(*ids), F.lit(keys)).cast("int")
    known = F.col(symbol).isNotNull() & F.col(time).isNotNull()
    ts = F.col(time).cast("timestamp")
    kind = T.StructType().add("key", first.schema[symbol].dataType).add("part", "integer").add("ts", "timestamp")
    kind = kind.add("us", "long").add("version", "integer").add("rows", "binary")
    none = min(0, *versions) - 1  # a switch to null is one to a version that no source has
    packs = control.where(known).select(
        F.col(symbol).cast(kind["key"].dataType).alias("key"), F.explode(F.sequence(F.lit(0), F.lit(keys - 1))).alias("part"),
        ts.alias("ts"), micros(time).alias("us"), F.coalesce(F.col("version").cast("int"), F.lit(none)).alias("version"),
        F.lit(None).cast("binary").alias("rows"),
    )
    for v, df in sorted(versions.items()):
        inside = (F.col(symbol), part, ts, micros(time), F.lit(v).cast("int"))
        keyed = df.select(*columns).where(known).select(*columns, *[c.alias(n) for c, n in zip(inside, INSIDE)])
        packs = packs.unionByName(keyed.mapInArrow(lambda batches: deal(batches, columns), kind))
    active = packs.withWatermark("ts", lateness).groupBy("key", "part").transformWithStateInPandas(
        statefulProcessor=Relay(ids), outputStructType="rows binary", outputMode="Append", timeMode="EventTime",
    )
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in first.schema] + [T.StructField("version", T.IntegerType())])
    return active.mapInArrow(emitted, out)


def start_relay(spark: SparkSession, start) -> StreamingQuery:
    """Start a query over a relay: ``start()`` returns it. Its state needs the RocksDB store, which
    a query takes from the session as it starts; other queries keep theirs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
