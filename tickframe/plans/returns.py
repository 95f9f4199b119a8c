"""Returns over marks: price at a start and an end time, both looked up as of that time."""

from __future__ import annotations

import math
from datetime import date, timedelta
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickframe.functions.times import as_col, from_micros, micros, to_us
from tickframe.operators.asof import asof_join
from tickframe.operators.splits import Splits, null_safe
from tickframe.operators.tables import known_symbols

def _ntz(us: str) -> str:
    return f"CAST(timestamp_micros({us}) AS TIMESTAMP_NTZ)"


# A mark is (start, duration). The start is an offset from the query's time column, or any
# timestamp Column over the query.
Mark = tuple[timedelta | Column, timedelta]


class Returns:
    """Returns against one backend table of prices.

    ``fair`` and ``tick_time`` are the backend's price and causal time; ``splits`` are the hot
    symbol bounds of the backend, measured once with ``asof_splits``.
    """

    def __init__(
        self,
        backend: DataFrame,
        fair: str | Column = "vwap_price",
        tick_time: str | Column = "last_event_time",
        unique: bool = True,
        splits: Splits | None = None,
    ):
        self.has_date = "date" in backend.columns
        self.ticks = backend.select(
            "symbol",
            *(["date"] if self.has_date else []),
            micros(tick_time).alias("tick_us"),
            as_col(fair).cast("double").alias("fair"),
        )
        self.unique = unique
        self.splits = splits

    def universe_symbols(self) -> DataFrame:
        return self.ticks.select("symbol").distinct()

    def query(
        self, query: DataFrame, start: timedelta | Column = timedelta(0),
        duration: timedelta = timedelta(minutes=10), **options,
    ) -> DataFrame:
        """One mark; the appended columns carry no suffix."""
        out = self.query_batch(query, {"0": (start, duration)}, **options)
        return out.withColumnsRenamed(
            {c: c[:-2] for c in out.columns if c.endswith("_0") and c not in query.columns}
        )

    def query_batch(
        self,
        query: DataFrame,
        marks: dict[str, Mark],
        time: str = "time",
        tolerance: timedelta = timedelta(seconds=30),
        append_query_tick_times: bool = False,
        append_lag: bool = True,
        append_start_end_fairs: bool = False,
        dates: tuple[date, date] | str | None = None,
        strict_date_pruning: bool = False,
        row_key: Sequence[str] | None = None,
    ) -> DataFrame:
        """Append ``return_{mark}`` and the asked-for details for every mark.

        All marks share one as-of pass. Offsets that coincide are looked up once, and only
        (key, time) travels through the join: the query's own columns are joined back at the
        end. ``row_key`` names columns that identify a query row; without it the distinct
        lookup points are used as the key.

        ``dates`` limits the backend: a (first, last) pair of query dates, or "query" to
        measure them. Ticks up to one tolerance older are kept, unless ``strict_date_pruning``.
        """
        if not marks:
            raise ValueError("marks must hold at least one mark")
        offset_marks = {n: m for n, m in marks.items() if isinstance(m[0], timedelta)}
        column_marks = {n: m for n, m in marks.items() if n not in offset_marks}

        q = query
        ids: list[str] = list(row_key) if row_key else ["symbol"]
        extra: dict[str, Column] = {}
        if offset_marks:
            extra["__t"] = micros(time)
        for i, (start, _) in enumerate(column_marks.values()):
            extra[f"__s{i}"] = micros(start)
        q = q.withColumns(extra)
        if not row_key:
            ids += list(extra)

        # distinct lookup points: (base column, offset in microseconds)
        points: list[tuple[str, int]] = []

        def point(base: str, off: int) -> int:
            if (base, off) not in points:
                points.append((base, off))
            return points.index((base, off))

        ends: dict[str, tuple[int, int]] = {}
        col_no = {n: i for i, n in enumerate(column_marks)}
        for n, (start, dur) in marks.items():
            base, off = (
                ("__t", to_us(start)) if n in offset_marks else (f"__s{col_no[n]}", 0)
            )
            ends[n] = (point(base, off), point(base, off + to_us(dur)))

        base_cols = list(dict.fromkeys([*ids, "symbol", *extra]))
        base = q.select(*base_cols)
        if not row_key:
            base = base.distinct()
        if append_query_tick_times:
            base = known_symbols(base, self.universe_symbols())
        exploded = base.select(
            *ids,
            *([] if "symbol" in ids else ["symbol"]),
            F.posexplode(
                F.array(*[F.col(b) + F.lit(o).cast("long") for b, o in points])
            ).alias("__i", "__q"),
        ).where(F.col("symbol").isNotNull() & F.col("__q").isNotNull())

        ticks = self._pruned(q, points, dates, tolerance, strict_date_pruning)
        m = asof_join(
            exploded, ticks.select("symbol", "tick_us", "fair"), "__q", "tick_us",
            ["symbol"], tolerance=tolerance, values=["fair"],
            tie=() if self.unique else None, time_as="__tu", splits=self.splits,
        )
        # SQL text: one round trip to the JVM per expression, where dozens of marks add up
        wanted = {"__f": "fair", "__u": "__tu", **({"__q": "__q"} if append_query_tick_times else {})}
        aggs = [
            F.expr(f"max(CASE WHEN __i = {i} THEN {c} END)").alias(f"{p}{i}")
            for i in range(len(points))
            for p, c in wanted.items()
        ]
        wide = m.groupBy(*[F.col(c).alias(f"__id{k}") for k, c in enumerate(ids)]).agg(*aggs)
        # joined on the whole key, so a hot symbol's rows spread over all tasks again
        j = q.join(
            wide, null_safe(q, wide, [(c, f"__id{k}") for k, c in enumerate(ids)]), "left"
        )
        new: list[tuple[str, str]] = []
        for n in marks:
            s, e = ends[n]
            if append_query_tick_times:
                new += [
                    (f"start_query_time_{n}", _ntz(f"__q{s}")),
                    (f"end_query_time_{n}", _ntz(f"__q{e}")),
                    (f"start_tick_time_{n}", _ntz(f"__u{s}")),
                    (f"end_tick_time_{n}", _ntz(f"__u{e}")),
                ]
            if append_lag:
                lags = [f"{points[i][0]} + {points[i][1]}L - __u{i}" for i in (s, e)]
                new.append((f"max_tick_to_query_lag_{n}", f"greatest({', '.join(lags)})"))
            if append_start_end_fairs:
                new += [(f"start_fair_{n}", f"__f{s}"), (f"end_fair_{n}", f"__f{e}")]
            new.append((f"return_{n}", f"try_divide(__f{e} - __f{s}, __f{s})"))
        out = [F.col(f"`{c}`") for c in query.columns]
        out += [F.expr(text).alias(name) for name, text in new]
        return j.select(*out)

    def _pruned(self, q, points, dates, tolerance, strict) -> DataFrame:
        """The backend restricted by its date partition column."""
        if dates is None or not self.has_date:
            return self.ticks
        bases = list(dict.fromkeys(b for b, _ in points))
        span = {
            b: (min(o for c, o in points if c == b), max(o for c, o in points if c == b))
            for b in bases
        }
        # A start column may lie anywhere, so its span is measured also when dates are given.
        if dates == "query" or any(b != "__t" for b in bases):
            one = q.agg(
                F.least(*[F.min(b) + F.lit(span[b][0]) for b in bases], F.lit(None).cast("long")).alias("lo"),
                F.greatest(*[F.max(b) + F.lit(span[b][1]) for b in bases], F.lit(None).cast("long")).alias("hi"),
            ).select(from_micros("lo").cast("date"), from_micros("hi").cast("date")).first()
            lo, hi = one
            if lo is None:
                return self.ticks.limit(0)
        else:
            hi = dates[1] + timedelta(
                days=math.ceil(max(s[1] for s in span.values()) / 86_400_000_000)
            )
            lo = dates[0] + timedelta(
                days=math.floor(min(s[0] for s in span.values()) / 86_400_000_000)
            )
        if not strict:
            lo = lo - timedelta(days=math.ceil(tolerance / timedelta(days=1)))
        return self.ticks.where(F.col("date").between(F.lit(lo), F.lit(hi)))
