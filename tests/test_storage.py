import datetime as dt
import json
import zipfile
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from registry import QUERIES
from registry.base import SCALE, bars10, table, ticks
from tickframe.operators.bars import time_bars
from tickframe.operators.curves import CurveStore, curve_ticks, dependence_curve
from tickframe.operators.ranks import seeded_sample
from tickframe.operators.tables import (
    Ranges, as_columns, columns_matching, missing_pairs, strip_suffix, universe_changes, with_suffix,
)
from tickframe.plans.dataset import DateTable, bar_table, day_batches
from tickframe.plans.ingest import Ingest, ensure_ready, update_summary
from tickframe.plans.research import from_day, research_dates, research_table, span_of
from tickframe.session import scratch_path
from tickframe.sinks.compaction import audit_files, compact, drop_files, file_parts
from tickframe.sinks.files import children, exists, remove
from tickframe.sinks.tables import cached_result, write_partitioned
from tickframe.sources.books import read_book_archive
from tickframe.sources.layout import LAYOUTS
from tickframe.sources.listing import keys_to_universe, one_pair, pairs_in_folders
from tickframe.sources.trades import normalise_futures, normalise_spot

D = dt.date


@pytest.fixture()
def days(spark, sf):
    return ticks(spark, sf).where("day(date) <= 6")


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_overwrite_replaces_only_its_partitions(spark, days):
    path = scratch_path(spark, "t")
    write_partitioned(days, path)
    write_partitioned(days.where("day(date) = 2").withColumn("price", F.lit(0.0)), path)
    t = spark.read.parquet(path)
    assert t.count() == days.count()
    assert t.where("day(date) = 2").agg(F.max("price")).first()[0] == 0.0
    assert t.where("day(date) <> 2").agg(F.min("price")).first()[0] > 0.0


def test_compute_is_incremental_and_equals_one_pass(spark, days):
    path = scratch_path(spark, "bars")
    calls = []
    t = bar_table(spark, days, days.select("symbol", "date"), path, dt.timedelta(minutes=10), scale=SCALE)
    inner = t._compute
    t._compute = lambda d: calls.append(list(d)) or inner(d)
    assert t.compute([D(2024, 1, 1), D(2024, 1, 2)]) == [D(2024, 1, 1), D(2024, 1, 2)]
    t.compute(days_per_batch=3)
    assert [len(c) for c in calls] == [2, 3, 1]
    assert t.compute() == [] and t.num_validated() == t.num_partitions() == 6
    want = bars10(spark, "/root/testdata/sf0.001").where("day(date) <= 6")
    assert same(t[None].select(want.columns), want)
    assert t[D(2024, 1, 3)].select("date").distinct().count() == 1
    with pytest.raises(ValueError):
        t[[D(2025, 1, 1)]]


def test_failed_batches_are_collected_and_raised(spark, days):
    def compute(dates):
        if D(2024, 1, 3) in dates:
            raise OSError("disk")
        return days.where(F.col("date").isin(dates))

    t = DateTable(spark, scratch_path(spark, "f"), days.select("symbol", "date"), compute)
    with pytest.raises(RuntimeError, match="2024, 1, 3"):
        t.compute(days_per_batch=2)
    assert D(2024, 1, 3) not in t.validated() and D(2024, 1, 5) in t.validated()
    assert t.invalid() == [D(2024, 1, 3), D(2024, 1, 4)]
    with pytest.raises(ValueError):
        t.validate()
    t.clear_validation()
    assert t.num_validated() == 0
    assert t.invalid(recompute=True) == [D(2024, 1, 3), D(2024, 1, 4)]


def test_only_confirmed_dates_are_valid(spark, days):
    """A date that computes to nothing is not valid, nor is one whose recomputation fails."""
    state = {"fail": False, "checked": []}

    def compute(dates):
        if state["fail"]:
            raise OSError("disk")
        return days.where(F.col("date").isin(dates) & (F.col("date") != F.lit(D(2024, 1, 2))))

    def check(table):
        seen = table.groupBy("date").agg((F.count(F.lit(1)) > 0).alias("ok"))
        state["checked"].append({r["date"] for r in seen.collect()})
        return seen

    t = DateTable(spark, scratch_path(spark, "v"), days.select("symbol", "date"), compute, check)
    t.compute()
    assert D(2024, 1, 2) not in t.validated() and t.num_validated() == 5
    state["checked"].clear()
    assert t.invalid() == [D(2024, 1, 2)] and state["checked"] == [set()]  # only the unknown date is read
    state["fail"] = True
    with pytest.raises(RuntimeError):
        t.compute([D(2024, 1, 3)], recompute=True)
    assert D(2024, 1, 3) not in t.validated() and t.num_validated() == 4


def test_a_recomputed_date_that_is_empty_loses_its_rows(spark, days):
    """Readers see whole batches; a date that computes to nothing is gone and not valid."""
    state = {"gone": [], "price": 1.0, "fail": False}

    def compute(dates):
        rows = days.where(F.col("date").isin(dates) & ~F.col("date").isin(state["gone"]))
        price = F.raise_error(F.lit("lost")).cast("double") if state["fail"] else F.lit(state["price"])
        return rows.withColumn("price", price)

    first = [D(2024, 1, i) for i in range(1, 4)]
    few = lambda t: t.groupBy("date").agg((F.count(F.lit(1)) > 1).alias("ok"))
    post = lambda t: t.withColumn("twice", F.col("price") * 2)
    t = DateTable(spark, scratch_path(spark, "shrinks"), days.select("symbol", "date"), compute, few, post)
    with pytest.raises(FileNotFoundError):
        t.read()
    t.compute(first)
    before = t.read()
    state.update(gone=first[:2], price=2.0)
    assert t.compute(first, recompute=True) == [first[2]]
    assert {(r["date"], r["price"], r["twice"]) for r in t.read().select("date", "price", "twice").distinct().collect()} == {(first[2], 2.0, 4.0)}
    assert t.validated() == [first[2]] and t.invalid(dates=first) == first[:2]
    assert before.agg(F.max("price")).first()[0] == 1.0  # who reads the table as it was still can
    state.update(gone=first, price=3.0)
    assert t.compute(first, recompute=True) == [] and t.read().isEmpty() and t.read().columns[-1] == "twice"
    state.update(gone=[], fail=True)
    with pytest.raises(RuntimeError, match="2024, 1, 1"):
        t.compute(first, recompute=True)
    assert t.read().isEmpty() and t.validated() == []
    state.update(fail=False)
    t.compute()
    want = t.read().count()
    assert t.commits.vacuum() > 0 and t.read().count() == want == days.count() and t.num_validated() == 6


def test_dates_that_look_ahead_are_computed_again(spark, days):
    """A date is open until its sources have come as far as it looks."""
    path, calls = scratch_path(spark, "ahead"), []

    def table_at(upto):
        seen = days.where(F.col("date") <= F.lit(upto))
        later = seen.groupBy(F.date_sub("date", 1).alias("date")).agg(F.count(F.lit(1)).alias("next"))

        def compute(dates):
            calls.append(list(dates))
            return seen.where(F.col("date").isin(dates)).join(later, "date", "left")

        return DateTable(spark, path, seen.select("symbol", "date"), compute, ahead=1, last=lambda: upto)

    D_ = lambda *k: [D(2024, 1, i) for i in k]
    table_at(D(2024, 1, 3)).compute()
    t = table_at(D(2024, 1, 3))
    assert t.reopened() == [] and t.compute() == [] and t.validated() == D_(1, 2, 3)
    t = table_at(D(2024, 1, 5))
    assert t.reopened() == D_(3) and t.compute() == D_(3, 4, 5) and t.reopened() == []
    assert calls == [D_(1, 2, 3), D_(3, 4, 5)]
    assert {r["date"] for r in t.read().where("next IS NULL").select("date").distinct().collect()} == set(D_(5))


def test_research_by_date_prunes_and_equals_one_pass(spark, days):
    bars = time_bars(days, dt.timedelta(hours=1), scale=SCALE)
    marks = {"back": (dt.timedelta(hours=-30), dt.timedelta(hours=30)), "ahead": (dt.timedelta(0), dt.timedelta(hours=30))}
    assert span_of(marks) == (2, 2)
    meta = bars.select("symbol", "date", F.col("time"), F.col("volume").alias("known")).where("day(date) <= 2")
    index = bars.select("symbol", "date", "time", "close")
    options = dict(marks=marks, tolerance=dt.timedelta(hours=3))
    path = scratch_path(spark, "research")
    for upto in (3, 6):
        some = [df.where(F.day("date") <= upto) for df in (index, bars, meta)]
        t = research_dates(spark, path, *some, **options)
        t.compute(days_per_batch=2)
    want = research_table(index, bars, meta.drop("date"), **options)
    assert same(t[None].select(want.columns), want) and t.reopened() == []
    last = from_day(bars, D(2024, 1, 3), "last_event_time")
    assert last.where("day(date) < 3").groupBy("symbol").count().where("count > 1").isEmpty() and last.where("day(date) >= 3").count() == bars.where("day(date) >= 3").count()
    assert from_day(bars, D(2024, 1, 3), "last_event_time", dt.timedelta(days=1)).where("day(date) = 1").isEmpty()


def test_inventory_from_folders_opens_no_file_and_skips_complete_dates(spark, days):
    path = scratch_path(spark, "folders")
    names = F.when(F.col("symbol") == "view", F.lit("A/B+1 %")).when(F.col("symbol") != "click", F.col("symbol"))
    t = days.withColumn("symbol", names)
    write_partitioned(t, path, ["date", "symbol"])
    want = {(r["symbol"], r["date"]) for r in t.select("symbol", "date").distinct().collect()}
    pairs = lambda *a: {(r["symbol"], r["date"]) for r in pairs_in_folders(spark, path, *a).collect()}
    assert pairs() == want and {None, "A/B+1 %"} <= {s for s, _ in want}
    complete = [D(2024, 1, k) for k in (1, 2, 3)]
    cached = t.select("symbol", "date").distinct().where("day(date) <= 3")
    for d in complete:  # not looked into
        remove(spark, f"{path}/date={d}")
    files = [f for d in children(spark, path) if d.startswith("date=") for f in children(spark, f"{path}/{d}")]
    assert pairs(cached, complete) == want and len(files) > 0
    assert pairs(cached, []) == {p for p in want if p[1] not in complete}
    for d in range(4, 7):
        remove(spark, f"{path}/date=2024-01-0{d}")
    assert pairs(cached, complete) == {p for p in want if p[1] in complete} and pairs() == set()


def test_tick_labels_by_a_callback(spark):
    df = spark.createDataFrame([(float(k), 1.0) for k in range(11)], "x double, w double")
    curve = dependence_curve(df, "x", ["w"], "w")
    got = curve_ticks(df, curve, "x", 3, format_fn=lambda c: F.format_string("<%.1f>", c)).orderBy("tick").collect()
    assert [(r["prob"], r["label"]) for r in got] == [(0.0, "<0.0>"), (0.5, "<5.0>"), (1.0, "<10.0>")]


def test_commits_of_two_writers_both_count(spark, days):
    path = scratch_path(spark, "writers")
    write_partitioned(days.where("day(date) = 6"), path)  # left there by another writer
    one, two = (DateTable(spark, path, days.select("symbol", "date"), lambda d: days.where(F.col("date").isin(d))) for _ in range(2))
    assert one.read().count() == days.where("day(date) = 6").count() and one.invalid(dates=[D(2024, 1, 6)]) == []
    calls = []

    def late(m):  # another commit comes in between reading and publishing
        if not calls:
            calls.append(two.compute([D(2024, 1, 2)]))
        return replace(m, valid=m.valid | {D(2024, 1, 5)})

    one.commits.commit(late)
    one.compute([D(2024, 1, 1)])
    assert one.validated() == [D(2024, 1, i) for i in (1, 2, 5, 6)] == two.validated()
    assert two.read().select("date").distinct().count() == 3
    two.unmark([D(2024, 1, 5)])
    two.compute()
    assert one.read().select(days.columns).exceptAll(days).isEmpty() and one.read().count() == days.count()
    assert one.compute([D(2024, 1, 6)], recompute=True) == [D(2024, 1, 6)] and one.read().count() == days.count()


def test_a_damaged_archive_leaves_no_rows(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    rows = "".join(f"{i},1.5,2.0,3.0,{1735603200000 + i},True,True\n" for i in range(450_000))
    for name in ("AAA", "BBB"):
        with zipfile.ZipFile(raw / f"{name}-trades-2024-12-31.zip", "w", zipfile.ZIP_STORED) as z:
            z.writestr(f"{name}-trades-2024-12-31.csv", rows)
    data = bytearray((raw / "BBB-trades-2024-12-31.zip").read_bytes())
    data[-2000] ^= 1  # the last chunk; only the checksum can tell
    (raw / "BBB-trades-2024-12-31.zip").write_bytes(bytes(data))
    uni = spark.createDataFrame([(n, D(2024, 12, 31)) for n in ("AAA", "BBB")], "symbol string, date date")
    job = Ingest(spark, str(raw), str(tmp_path / "hive"))
    assert {r["symbol"]: r["status"] for r in job.update(uni).collect()} == {"AAA": "success", "BBB": "failed"}
    assert {r["symbol"]: r["count"] for r in spark.read.parquet(job.hive).groupBy("symbol").count().collect()} == {"AAA": 450_000}


def test_universe_needs_its_columns(spark, days):
    with pytest.raises(ValueError):
        DateTable(spark, "/tmp/x", days.select("symbol"))
    assert day_batches([D(2024, 1, i) for i in range(1, 6)], 2)[-1] == [D(2024, 1, 5)]


def test_result_cache_versions(spark):
    root, calls = scratch_path(spark, "cache"), []

    def make(v):
        @cached_result(spark, root, v, "nums")
        def nums(n):
            calls.append(n)
            return spark.range(n)

        return nums

    assert make(1)(3).count() == make(1)(9).count() == 3  # arguments are not part of the key
    assert make(2)(5).count() == 5 and calls == [3, 5]
    assert children(spark, root) == ["nums_v2"]
    with pytest.raises(TypeError):
        cached_result(spark, root, 1, "bad")(lambda: 5)()


def test_ingest_zip_archives(spark, tmp_path):
    raw, hive = tmp_path / "raw", str(tmp_path / "hive")
    raw.mkdir()
    line = "{i},1.5,2.0,3.0,{t},{m},True\n"
    for sym, day, n in [("AAA", "2024-12-31", 3), ("AAA", "2025-01-01", 2), ("BBB", "2024-12-31", 4)]:
        us = int(pd.Timestamp(day, tz="UTC").timestamp() * 1e6)
        stamp = us if day >= "2025" else us // 1000
        with zipfile.ZipFile(raw / f"{sym}-trades-{day}.zip", "w") as z:
            rows = "".join(line.format(i=i, t=stamp + i, m=i % 2 == 0) for i in range(n))
            z.writestr(f"{sym}-trades-{day}.csv", rows)
    (raw / "CCC-trades-2024-12-31.zip").write_bytes(b"broken")
    uni = spark.createDataFrame(
        [("AAA", D(2024, 12, 31)), ("AAA", D(2025, 1, 1)), ("CCC", D(2024, 12, 31)), ("DDD", D(2024, 12, 31))],
        "symbol string, date date",
    )
    job = Ingest(spark, str(raw), hive)
    first = update_summary(job.update(uni)).first().asDict()
    assert first == {"total": 4, "success": 2, "skipped": 0, "failed": 2}
    t = spark.read.parquet(hive)
    assert t.count() == 5 and t.where("symbol = 'BBB'").isEmpty()
    assert {str(r[0])[:10] for r in t.select("time").collect()} == {"2024-12-31", "2025-01-01"}
    assert t.where("is_buyer_maker").count() == 3
    again = update_summary(job.update(uni.unionByName(
        spark.createDataFrame([("BBB", D(2024, 12, 31))], uni.schema)))).first().asDict()
    assert again == {"total": 5, "success": 1, "skipped": 2, "failed": 2}
    with pytest.raises(RuntimeError):
        ensure_ready(job, uni)
    ensure_ready(job, uni.where("symbol = 'AAA'"))
    assert one_pair(t, uni, "AAA", D(2025, 1, 1)).count() == 2
    with pytest.raises(KeyError):
        one_pair(t, uni, "ZZZ", D(2025, 1, 1))


def test_stamp_rules(frame):
    base = "price double, quantity double, quote_quantity double, time bigint"
    ms, us = 1_735_689_599_999, 1_735_689_600_000_000
    d = frame([(1.0, 1.0, 1.0, ms), (1.0, 1.0, 1.0, us), (1.0, 1.0, 1.0, ms + 1)], base)
    got = [str(r[0]) for r in normalise_spot(d).select("time").collect()]
    assert got == ["2024-12-31 23:59:59.999000", "2025-01-01 00:00:00", "2025-01-01 00:00:00"]
    f = frame([(7, 1.0, 2.0, 2.0, ms)], "id bigint, price double, qty double, quote_qty double, time bigint")
    assert normalise_futures(f).columns == ["trade_id", "price", "quantity", "quote_quantity", "time"]


def test_compaction_leaves_the_newest_file(spark, tmp_path):
    src, dst = tmp_path / "live" / "trades", str(tmp_path / "hive")
    src.mkdir(parents=True)

    def small(sym, stamp, n, start):
        times = pd.to_datetime(start) + pd.to_timedelta(range(n), unit="s")
        pd.DataFrame({"time": times.astype("datetime64[us]"), "price": 1.0}).to_parquet(
            src / f"{sym}_{stamp}.pq", index=False)

    small("A_B", "25-01-15 10-30-00", 3, "2025-01-14 23:59:59")
    small("A_B", "25-01-15 10-30-30", 2, "2025-01-15 10:30:00")
    small("C", "25-01-15 10-30-00", 5, "2025-01-15 10:00:00")
    other = src.parent / "bbo"
    other.mkdir()
    pd.DataFrame({"time": pd.to_datetime(["2025-01-15 11:30:00"]).astype("datetime64[us]"), "bid": 2.0}).to_parquet(
        other / "A_B_25-01-15 11-30-00.pq", index=False)  # newer, but of another kind
    compact(spark, str(tmp_path / "live"), dst)
    merged = compact(spark, str(tmp_path / "live"), dst)  # a repeated run changes nothing
    dst = f"{dst}/trades"
    t = spark.read.parquet(dst)
    assert {(r["symbol"], str(r["date"])): r["count"] for r in t.groupBy("symbol", "date").count().collect()} == {
        ("A_B", "2025-01-14"): 1, ("A_B", "2025-01-15"): 2}
    assert drop_files(spark, merged) == 1 and len(list(src.glob("*.pq"))) == 2
    small("A_B", "25-01-15 10-31-00", 1, "2025-01-15 11:00:00")
    compact(spark, str(tmp_path / "live"), str(tmp_path / "hive"))
    assert spark.read.parquet(dst).groupBy("date").count().orderBy("date").collect()[1]["count"] == 4


def test_file_names(frame):
    d = frame(
        [("/x/bbo/BTC_PERP_25-01-15 10:30:45.pq",), ("file:/x/bbo/BTC_25-01-15%2010:30:45.pq",), ("/x/bbo/readme.txt",)],
        "p string",
    )
    got = [tuple(r[0]) for r in d.select(file_parts("p")).collect()]
    t = dt.datetime(2025, 1, 15, 10, 30, 45)
    assert got == [("bbo", "BTC_PERP", t), ("bbo", "BTC", t), (None, None, None)]


def test_audit_lists_bad_files(spark, tmp_path):
    good, bad = tmp_path / "symbol=A" / "date=2024-01-01", tmp_path / "bad.parquet"
    good.mkdir(parents=True)
    pd.DataFrame({"x": [1, 2]}).to_parquet(good / "data.parquet")
    bad.write_bytes(b"PAR1nope")
    files = spark.createDataFrame([(f"file://{good}/data.parquet",), (f"file://{bad}",)], "path string")
    got = {r["path"].rsplit("/", 1)[1]: r for r in audit_files(files).collect()}
    assert got["data.parquet"]["ok"] and got["data.parquet"]["n_rows"] == 2
    assert (got["data.parquet"]["symbol"], got["data.parquet"]["date"]) == ("A", "2024-01-01")
    assert not got["bad.parquet"]["ok"] and got["bad.parquet"]["error"] and bad.exists()


def test_book_archive(spark, tmp_path):
    lvl = lambda px, sz: {"px": str(px), "sz": str(sz), "n": 1}
    rec = lambda **k: json.dumps({
        "time": "2024-01-01T00:00:01.5", "ver_num": k.get("ver", 1),
        "raw": {"channel": k.get("channel", "l2Book"), "data": {
            "coin": k.get("coin", "BTC"), "time": 1704067200000,
            "levels": k.get("levels", [[lvl(10, 1), lvl(9, 2)], [lvl(11, 4)]])}}})
    lines = [rec(), rec(ver=2), rec(coin="ETH"), rec(channel="x"), rec(levels=[[]]), "not json", ""]
    (tmp_path / "BTC.txt").write_text("\n".join(lines))
    good, bad = read_book_archive(spark, str(tmp_path / "BTC.txt"))
    rows = [(r["is_bid"], r["depth"], r["price"], r["csize"]) for r in good.collect()]
    assert sorted(rows) == [(False, 0, 11.0, 4.0), (True, 0, 10.0, 1.0), (True, 1, 9.0, 3.0)]
    assert bad.count() == 5 and {r["symbol"] for r in bad.collect()} == {"BTC"}


def test_book_archive_parses_each_line_once(spark, tmp_path):
    """Not once per condition, and the running sizes not a second time for the filter before their explosion."""
    (tmp_path / "BTC.txt").write_text("{}")
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in read_book_archive(spark, str(tmp_path))]
    assert [p.count("from_json(") for p in plans] == [1, 1] and plans[0].count("aggregate(transform(") == 1


def test_book_archive_splits_symbols(spark, sf):
    """A symbol's lines are not one task's and one file's."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        files = QUERIES["book_archive"](spark, sf).inputFiles()
    finally:
        spark.conf.unset(name)
    symbols = [f.rsplit("/", 1)[1].split(".")[0] for f in files]
    assert len(set(symbols)) == 5 and min(symbols.count(x) for x in symbols) > 1


def test_curve_store(spark, sf):
    d = table(spark, sf, "orders").select("o_totalprice", "o_custkey", "o_orderkey", "o_orderdate")
    path = scratch_path(spark, "store")
    args = (d, path, ["o_custkey"], ["o_totalprice", "o_orderdate"], F.col("o_orderkey").alias("w"))
    s = CurveStore.create(*args)
    with pytest.raises(FileExistsError):
        CurveStore.create(*args)
    s.set_range("o_totalprice", 100000.0, None)
    s.set_range("o_custkey", None, 5)
    s.drop_range("o_custkey")
    s.set_view(n_ticks=3)
    again = CurveStore(spark, path)
    assert again.ranges.bounds == {"o_totalprice": (100000.0, None)}
    curves = again.curves()
    assert again.filtered().count() == d.where("o_totalprice >= 100000").count()
    assert curves["o_totalprice"][0].count() == again.filtered().count()
    labels = [r["label"] for r in curves["o_orderdate"][1].orderBy("tick").collect()]
    assert len(labels) == 3 and all(len(x) == 19 for x in labels)
    s.delete()
    assert not exists(spark, path)
    with pytest.raises(ValueError, match="more than once"):
        CurveStore.create(d, path, ["o_custkey"], ["o_custkey"], "o_orderkey")
    assert not exists(spark, path)


def test_small_table_helpers(spark, sf, frame):
    d = frame([(1, 2), (3, 4)], "a_0 int, b int")
    assert strip_suffix(d, "_0").columns == ["a", "b"]
    assert with_suffix(d, ["b"], "_q").columns == ["a_0", "b_q"]
    assert columns_matching(d, "^a") == ["a_0"]
    assert len(as_columns([F.col("b"), "a_0"])) == len(as_columns("b")) + 1
    r = Ranges({"b": (None, 3), "a_0": (1, None)})
    assert r.apply(d).count() == 1 and Ranges.from_frame(r.frame(d)).bounds == r.bounds
    u = frame([("x",), ("y",)], "symbol string")
    v = frame([("y",), ("z",)], "symbol string")
    assert {tuple(c) for c in universe_changes(u, v).collect()} == {("x", "removed"), ("z", "added")}
    assert missing_pairs(u, v, ["symbol"]).collect()[0][0] == "x"
    keys = frame([("a/BTC-trades-2019-09-08.zip",), ("a/BTC-trades-2019-09-08.zip.CHECKSUM",), ("a/BTC-trades-2019-99-08.zip",)], "key string")
    assert [tuple(r) for r in keys_to_universe(keys).collect()] == [("BTC", D(2019, 9, 8))]
    e = table(spark, sf, "events")
    assert same(seeded_sample(e, 300, 5, ["event_id"]), seeded_sample(e.repartition(7), 300, 5, ["event_id"]))
    assert seeded_sample(e, 300, 5, ["event_id"]).count() == 300 and seeded_sample(e, 10**6, 5, ["event_id"]).count() == e.count()
    assert LAYOUTS["spot_trades"].path("/r", "grid", "USDT", "PT5S") == "/r/grids/spot/last_trade/PT5S/peg_symbol=USDT"
