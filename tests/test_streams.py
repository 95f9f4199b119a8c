import datetime as dt
import json
import math
from datetime import timedelta
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from registry.base import bars10, table, ticks
from tickframe.session import scratch_path
from tickframe.sinks.files import children
from tickframe.streaming import messages as msg
from tickframe.streaming.feeds import (
    LatestTable, as_text, current_values, drain, feed_health, file_sink, message_stream, record_feeds,
    routed_sink, stitch, streaming_bars, symbol_filter, table_stream,
)
from tickframe.streaming.recorder import Recorder, unrouted
from tickframe.streaming.relay import EMITTED, PROVIDER, Relay, deal, emitted, relay, start_relay
from tickframe.streaming.universe import universe_changes

M10 = timedelta(minutes=10)


@pytest.fixture(scope="module")
def day_files(spark, sf):
    """Ticks in five files, oldest first."""
    path = scratch_path(spark, "ticks")
    t = ticks(spark, sf)
    for i in range(5):
        t.where(f"(day(date) - 1) DIV 6 = {i}").coalesce(1).write.mode("append").parquet(path)
    return path, t


def test_append_bars_equal_batch_bars(spark, sf, day_files):
    path, t = day_files
    s = table_stream(spark, path, t.schema, files_per_trigger=1)
    out = scratch_path(spark, "out")
    drain(file_sink(streaming_bars(s, M10, "1 hour"), out, out + "-c", every=None))
    got = spark.read.parquet(out)
    end = t.agg(F.max("time") - F.expr("INTERVAL 1 HOUR")).first()[0]
    want = bars10(spark, sf).where(F.col("time") <= F.lit(end))
    cols = ["symbol", "date", "time", "open", "high", "low", "close", "trade_count", "last_event_time"]
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty()
    assert got.count() == want.count() > 0


def test_latest_table_over_batches(spark, sf, day_files):
    path, t = day_files
    s = table_stream(spark, path, t.schema, files_per_trigger=1).select("symbol", "time", "price")
    out = scratch_path(spark, "latest")
    latest = LatestTable(spark, out, ["symbol"], "time")
    drain(latest.start(current_values(s, ["symbol"], "time"), out + "-c", every=None))
    want = current_values(t.select("symbol", "time", "price"), ["symbol"], "time")
    assert latest.read().exceptAll(want).isEmpty() and latest.read().count() == 5
    latest.merge(want, 4)  # a repeated batch rewrites its own version
    assert latest.read().exceptAll(want).isEmpty() and latest.read().count() == 5


def test_a_batch_rewrites_only_the_buckets_it_touches(spark):
    schema = "k long, time long, v string"
    rows = lambda ks, t, v: spark.createDataFrame([(k, t, v) for k in ks], schema)
    path = scratch_path(spark, "buckets")
    latest = LatestTable(spark, path, ["k"], "time", buckets=32)
    with pytest.raises(FileNotFoundError):
        latest.read()
    first = latest.merge(rows(range(200), 5, "a"), 0)
    before = latest.manifest()["folders"]
    assert len(first) == 32 == len(before)
    old = latest.read()
    touched = latest.merge(rows([3, 7], 6, "b"), 1)
    after = latest.manifest()["folders"]
    assert 1 <= len(touched) <= 2 and {b for b in after if after[b] != before[b]} == set(map(str, touched))
    assert old.where("v = 'b'").count() == 0  # who reads the version before still can
    assert latest.merge(rows([3, 7], 9, "again"), 1) == []  # a batch that was committed is not taken twice
    latest.merge(rows([3], 2, "late"), 2)
    latest.merge(rows([7, 900, None], 6, "tie"), 3)
    assert latest.merge(rows([], 0, ""), 4) == []
    got = {r["k"]: r["v"] for r in latest.read().collect()}
    assert got == {k: "a" for k in range(200)} | {3: "b", 7: "tie", 900: "tie", None: "tie"}
    again = LatestTable(spark, path, ["k"], "time", buckets=8)  # the number of buckets stays that of the table
    again.merge(rows(range(5), 10, "c"), 5)
    assert {r["k"]: r["v"] for r in again.read().collect()} == got | dict.fromkeys(range(5), "c")
    versions = [n for n in children(spark, path) if n.startswith("version=")]
    assert len(versions) <= len(set(after.values())) + 4


def relay_rows(symbol, minutes):
    return [(symbol, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), f"{symbol}-{m}", float(m)) for m in minutes]


@pytest.mark.parametrize("parts", [1, 3])
def test_relay_switches_in_mid_stream(spark, parts):
    """Versions that overlap, a switch that arrives after rows it governs, copies and late rows."""
    schema = "symbol string, time timestamp_ntz, id string, value double"
    batches = [
        {1: relay_rows("a", range(0, 40)) + relay_rows("b", range(0, 40)), 2: relay_rows("a", range(30, 55)), "c": [("a", 0, 1), ("b", 0, 1)]},
        {1: relay_rows("a", range(40, 70)) + relay_rows("b", range(40, 70)) + relay_rows("a", [39, 41]), 2: relay_rows("a", range(55, 70)), "c": [("a", 50, 2)]},
        {1: relay_rows("b", range(70, 100)) + relay_rows("a", [1, 2]), 2: relay_rows("a", range(70, 100)) + relay_rows("a", [69]), "c": [("a", 80, 1), ("a", 80, 2), ("x", 900, 1)]},
    ]
    root = scratch_path(spark, "relay")
    for k, batch in enumerate(batches):
        for v in (1, 2):
            spark.createDataFrame(batch[v], schema).coalesce(1).write.parquet(f"{root}/v{v}/part{k}")
        switches = [(s, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), v) for s, m, v in batch["c"]]
        spark.createDataFrame(switches, "symbol string, time timestamp_ntz, version int").coalesce(1).write.parquet(f"{root}/c/part{k}")
    feeds = {}
    for name in ("v1", "v2", "c"):
        kind = spark.read.parquet(f"{root}/{name}/part0").schema
        feeds[name] = spark.readStream.schema(kind).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
    s = relay({1: feeds["v1"], 2: feeds["v2"]}, feeds["c"], ["id"], "time", "30 minutes", parts=parts)
    out = scratch_path(spark, "relayed")
    drain(start_relay(spark, lambda: file_sink(s, out, out + "-c", every=None)))
    got = sorted((r["id"], r["version"]) for r in spark.read.parquet(out).collect())
    want = [(f"a-{m}", 1 if m < 50 else 2) for m in range(100)] + [(f"b-{m}", 1) for m in range(100)]
    assert got == sorted(want)
    assert spark.conf.get(PROVIDER).endswith("HDFSBackedStateStoreProvider")
    with pytest.raises(ValueError):
        relay({1: feeds["v1"].withColumn("version", F.lit(1))}, feeds["c"], ["id"], "time", "1 hour")


class Listed(list):
    """The list state of one key."""

    get, appendList = list.__iter__, list.extend

    def put(self, values):
        self[:] = values


def test_relay_sets_its_rows_free_in_packs():
    """All rows of a timer at once were one list of rows in the worker; now no frame holds more than a pack."""
    n, day = 3 * EMITTED, 86_400_000_000
    us = [(k * 7919) % n * 1000 for k in range(n)] + [day + 5]
    rows = pa.table({
        "id": pa.array(range(2**60, 2**60 + n + 1)), "__key": ["a"] * (n + 1), "__part": pa.array([0] * (n + 1), pa.int32()),
        "__ts": pa.array(us, pa.timestamp("us", "UTC")), "__us": us, "__version": pa.array([1] * (n + 1), pa.int32()),
    })
    states, timers = {}, []
    handle = SimpleNamespace(getListState=lambda name, _: states.setdefault(name, Listed()), registerTimer=timers.append)
    at = lambda mark: SimpleNamespace(getCurrentWatermarkInMs=lambda: mark // 1000)
    r = Relay(["id"])
    r.init(handle)
    frames = [b.to_pandas() for b in deal(iter(rows.to_batches(7000)), ["id"])]
    assert frames and all(len(f) == 1 for f in frames)
    control = frames[0].assign(us=0, rows=None)
    assert list(r.handleInputRows(("a", 0), iter([*frames, *frames, control]), at(0))) == [] and timers == [1]
    got = list(r.handleExpiredTimer(("a", 0), at(day), None))
    assert [len(f) for f in got] == [1] * 3
    out = pa.Table.from_batches(emitted(pa.RecordBatch.from_pandas(f) for f in got))
    assert max(b.num_rows for b in out.to_batches()) <= EMITTED
    first = dict(zip(us, range(2**60, 2**60 + n + 1)))
    assert out["id"].to_pylist() == [first[k * 1000] for k in range(n)] and out["version"].type == pa.int32()
    assert {p[0] for p in states["packs"]} == {day + 5} and timers[-1] == day // 1000 + 1  # the later row waits on
    assert list(r.handleExpiredTimer(("a", 0), at(day), None)) == []
    late = frames[0].assign(us=7)
    assert list(r.handleInputRows(("a", 0), iter([late]), at(2 * day))) == []
    assert [len(f) for f in r.handleExpiredTimer(("a", 0), at(2 * day), None)] == [1] and not states["packs"]


def test_relay_keeps_values_as_they_are(spark):
    """Nulls, NaN, long numbers, early times and nested values; a switch to no version."""
    schema = "symbol string, time timestamp_ntz, id long, value double, seen timestamp_ntz, part array<int>, us struct<a:string,b:long>"
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [
        ("a", at(0), 2**62 + 1, 1.5, dt.datetime(1600, 1, 1, 0, 0, 0, 1), [1, None], ("x", 2**61 + 1)), ("a", at(1), None, None, None, None, None),
        ("a", at(2), 7, float("nan"), at(2), [], (None, None)), ("a", at(3), 8, 2.0, at(3), [3], None), (None, at(1), 9, 1.0, at(1), [], None),
    ]
    root = scratch_path(spark, "kept")
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/v")
    switches = [("a", at(0), 1), ("a", at(3), None), ("a", at(4), 1), ("x", at(900), 1)]
    spark.createDataFrame(switches, "symbol string, time timestamp_ntz, version int").coalesce(1).write.parquet(f"{root}/c")
    feeds = [table_stream(spark, f"{root}/{n}", spark.read.parquet(f"{root}/{n}").schema) for n in "vc"]
    out = scratch_path(spark, "relayed")
    s = relay({1: feeds[0]}, feeds[1], ["id"], "time", "30 minutes")
    assert s.schema == spark.createDataFrame([], f"{schema}, version int").schema
    drain(start_relay(spark, lambda: file_sink(s, out, out + "-c", every=None)))
    got = sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=lambda r: r[1])
    assert [r[:3] for r in got] == [r[:3] for r in rows[:3]] and [r[4:] for r in got] == [(*r[4:], 1) for r in rows[:3]]
    assert got[0][3] == 1.5 and got[1][3] is None and math.isnan(got[2][3])


def test_stitch_takes_active_versions_once(spark, sf, day_files):
    path, t = day_files
    src = lambda: table_stream(spark, path, t.schema).select("symbol", "time", "trade_id")
    active = spark.createDataFrame([("click", 1), ("view", 2)], "symbol string, version int")
    for act, n in ((None, t.count()), (active, t.where("symbol IN ('click', 'view')").count())):
        out = scratch_path(spark, "stitch")
        s = stitch({1: src(), 2: src()}, ["symbol", "trade_id"], "time", "1 hour", act)
        drain(file_sink(s, out, out + "-c", every=None))
        assert spark.read.parquet(out).count() == n


def test_text_stream_to_typed_and_routed_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    lines = [
        json.dumps({"channel": "trades", "data": [
            {"coin": "BTC", "side": "B", "px": "10", "sz": "1", "time": 1704067200000, "tid": 1},
            {"coin": "ETH", "side": "A", "px": "5", "sz": "2", "time": 1704067200000, "tid": 2}]}),
        json.dumps({"channel": "trades", "data": []}),
        json.dumps({"channel": "pong"}), json.dumps({"channel": "other", "data": {}}), "{broken",
    ]
    (src / "a.txt").write_text("\n".join(lines))
    t = msg.trades(message_stream(spark, path=str(src))).withColumn("payload", F.lit("trades"))
    out = str(tmp_path / "out")
    drain(routed_sink(t, out, out + "-c", every=None))
    got = spark.read.parquet(out)
    assert {(r["payload"], r["symbol"], r["is_buy"]) for r in got.collect()} == {
        ("trades", "BTC", True), ("trades", "ETH", False)}
    qs = record_feeds({"trades": msg.trades(message_stream(spark, path=str(src)))}, str(tmp_path / "rec"), every=None)
    drain(qs["trades"])
    assert spark.read.parquet(str(tmp_path / "rec" / "trades")).count() == 2
    h = {r["channel"]: (r["n_messages"], r["n_trades"]) for r in feed_health(spark.read.text(str(src))).collect()}
    assert h == {"trades": (2, 2), "pong": (1, 0), "other": (1, 0), "unreadable": (1, 0)}
    assert msg.quarantine(spark.read.text(str(src))).count() == 1
    txt = as_text(symbol_filter(got, F.col("symbol") == "BTC")).first()[0]
    assert json.loads(txt)["symbol"] == "BTC"


def test_message_edges(spark):
    def df(*objs):
        return spark.createDataFrame([(json.dumps(o),) for o in objs], "value string")

    one = {"px": "1", "sz": "2", "n": 3}
    q = msg.best_quotes(df(
        {"channel": "bbo", "data": {"coin": "A", "time": 1, "bbo": [one, None]}},
        {"channel": "bbo", "data": {"coin": "B", "time": 1, "bbo": [one, one]}},
        {"channel": "bbo", "data": {"coin": "C", "time": 1, "bbo": [one, {"px": "bad", "sz": "1", "n": 1}]}}))
    good, bad = msg.complete(q, "bid_price", "ask_price")
    assert [r["symbol"] for r in good.collect()] == ["B"] and bad.count() == 2
    assert msg.books(df({"channel": "l2Book", "data": {"coin": "A", "time": 1, "levels": [[one]]}})).count() == 0
    spot = msg.spot_universe(df({"universe": [
        {"name": "PURR/USDC", "tokens": [1, 0], "index": 0, "isCanonical": True},
        {"name": "@9", "tokens": [7, 0], "index": 9}],
        "tokens": [{"name": "USDC", "index": 0}, {"name": "PU/RR", "index": 1}]}))
    assert [(r["symbol"], r["exchange_symbol"]) for r in spot.collect()] == [("PURR-USDC", "PURR/USDC"), (None, "@9")]
    perp = msg.perp_universe(df({"universe": [
        {"name": "BTC", "szDecimals": 5, "maxLeverage": 50}, {"name": "OLD", "isDelisted": True}]}))
    assert [r["symbol"] for r in perp.collect()] == ["BTC_PERP"]


def test_recorder_routes_once_and_takes_no_batch_twice(spark):
    trade = lambda s, n: json.dumps({"channel": "trades", "data": [
        {"coin": s, "side": "B", "px": "1", "sz": "1", "time": 1704067200000, "tid": k} for k in range(n)]})
    quote = json.dumps({"channel": "bbo", "data": {"coin": "007", "time": 1, "bbo": [{"px": "1", "sz": "2", "n": 3}, None]}})
    lines = [trade("A", 2), trade("007", 1), quote, json.dumps({"channel": "pong"}), "{broken", json.dumps({"channel": "new", "data": 1})]
    batch = spark.createDataFrame([(x,) for x in lines], "value string")
    parsers = {"trade": ("trades", msg.trades), "quote": ("bbo", msg.best_quotes)}
    r = Recorder(spark, scratch_path(spark, "recorder"), parsers)
    with pytest.raises(FileNotFoundError):
        r.read("trade")
    r.record(batch, 0)
    r.record(batch, 0)  # repeated after its commit
    assert sorted((x["symbol"], x["trade_id"]) for x in r.read("trade").collect()) == [("007", 0), ("A", 0), ("A", 1)]
    assert [x["symbol"] for x in r.read("quote").collect()] == ["007"]

    def broken(df):
        raise OSError("disk")

    with pytest.raises(OSError):  # dies in mid-batch: what it wrote is not read, and is written again
        Recorder(spark, r.path, parsers | {"quote": ("bbo", broken)}).record(batch, 1)
    assert r.read("trade").count() == 3
    r.record(batch.limit(0), 1)
    r.record(batch, 2)
    assert r.read("trade").count() == 6 and r.read("trade", after=0).count() == 3
    got = {x["channel"]: (x["n_messages"], x["n_trades"], x["is_control"]) for x in r.health().collect()}
    assert got == {"trades": (4, 6, False), "bbo": (2, 0, False), "pong": (2, 0, True), "new": (2, 0, False), "unreadable": (2, 0, False)}
    assert unrouted(batch, parsers).count() == 3


def test_universe_changes_follow_the_time_of_snapshots(spark):
    day = lambda k: dt.datetime(2024, 1, k)
    root = scratch_path(spark, "snapshots")
    batches = [
        [("x", day(1), ["a", "b", None]), ("x", day(4), ["b", "d"]), ("y", day(2), [])],
        [("x", day(3), ["b", "c"]), ("x", day(3), ["a"]), ("y", day(5), ["q"]), (None, day(3), ["n"]), ("x", None, ["n"])],
        [("x", day(9), None), ("y", day(9), ["q"]), ("x", day(8), ["d", "b"])],
        [("end", day(30), ["z"]), ("y", day(1), ["late"])],
    ]
    schema = "source string, time timestamp, symbols array<string>"
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/part{k}")
    s = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(root)
    out = scratch_path(spark, "changed")
    drain(start_relay(spark, lambda: file_sink(universe_changes(s, "3 days", parts=3), out, out + "-c", every=None)))
    got = sorted((r["source"], r["time"].day, r["symbol"], r["change"]) for r in spark.read.parquet(out).collect())
    assert got == sorted([
        ("x", 1, "a", "added"), ("x", 1, "b", "added"), ("x", 3, "c", "added"), ("x", 4, "a", "removed"), ("x", 4, "c", "removed"),
        ("x", 4, "d", "added"), ("x", 9, "b", "removed"), ("x", 9, "d", "removed"), ("y", 5, "q", "added"),
    ])
