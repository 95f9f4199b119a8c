"""Personal data: proposed spans, boosted trees that judge them, calibrated selection.

Four kinds are found by pattern and check alone (the base spans). Generators with a higher recall
propose more, overlapping spans: numbers with any separators, also parts of longer ones, and
written-out addresses. Trees trained on the base spans, on variants of them and on the look-alikes
of the corpus score format and context; what passes its kind's threshold, calibrated on all texts,
and does not overlap a better span is added. Every step is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tickframe.llm.number_runs import NumberRun
from tickframe.llm.rows import gathered, id_and_text, map_rows, map_texts, stored
from tickframe.llm.trees import BoostedTrees, fit_trees
from tickframe.llm.workers import tidy

KINDS = ("email", "ip", "card", "phone")
SAMPLE_TEXTS = 4_000  # texts the trees are fitted on, at most
SAMPLE_SPANS = 40_000  # and proposed spans in them
#: Texts that are sampled: those with three digits or @, and those of each kind.
SAMPLED = (
    "contains(row_text, '@') OR row_text RLIKE '[0-9]{3}'", "contains(row_text, '@')",
    "row_text RLIKE '[0-9][.][0-9]+[.][0-9]+[.][0-9]'", "row_text RLIKE '[0-9](?:[ -]?[0-9]){13}'",
    "row_text RLIKE '[+][0-9][ ().0-9-]+[0-9]'",
)
MAY_HOLD = r"[0123456789@(\[{]"  # every text with a span has one; single characters are matched faster than ranges
PRECISION = 0.995
LEAST_THRESHOLD = 0.9
BINS = 4096  # of the scores that thresholds are calibrated on
SCORED_SPANS = 20_000  # at once
JUDGED_BYTES = 2 << 20  # of texts at once
LONG_RUN = 200  # characters of a run of numbers whose windows are worked out as arrays
CONTEXT = 24  # characters before a span that are looked at

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can begin inside a run of digits only where the one before ended, which is never inside.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
NUMERIC = re.compile(r"[0-9][0-9 ()+.\-/]*")  # what all patterns of numbers are made of, but for one sign before it
ANY_DIGIT = re.compile(r"[0-9]")

WRITTEN_AT = re.compile(r"[\[({](?:at|AT|@)[\])}] ?")
WRITTEN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[({](?:dot|DOT|\.)[\])}] ?)[A-Za-z0-9-]{1,63}){1,8}")
NUMBER = re.compile(r"[+(]?[0-9](?:[ ().\-/]{0,3}[0-9])+")
CUES = {
    "email": re.compile(r"(?i)(?:mail|contact|write|correo|adresse)\W*$"),
    "ip": re.compile(r"(?i)(?:\bip\b|host|server|addr\w*)\W*$"),
    "card": re.compile(r"(?i)(?:card|visa|credit|karte|tarjeta|carte)\W*$"),
    "phone": re.compile(r"(?i)(?:phone|tel|call|fax|mobil\w*|cell|handy)\W*$"),
}
DATE = re.compile(r"(?:1[89]|20)[0-9]{2}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2(?:1[89]|20)[0-9]{2}")
ORDINAL = re.compile(r"(?i)(?:version|section|v|no|nr|page|vol|chapter|\$|€|#)\W*$")


def digits_of(s: str) -> str:
    return "".join(ANY_DIGIT.findall(s))


def numeric_parts(text: str) -> list[tuple[int, int]]:
    """Where the matches of all patterns of numbers lie: one pass finds these parts, the patterns search only them."""
    return [(a - (text[a - 1 : a] in ("+", "(")), b) for a, b in (m.span() for m in NUMERIC.finditer(text))]


def matches(pattern: re.Pattern, text: str, parts: list[tuple[int, int]]) -> Iterator[re.Match]:
    return (m for part in parts for m in pattern.finditer(text, *part))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches: the run of local characters before each @, then a dotted domain."""
    over, at = 0, text.find("@")
    while at >= 0:
        left = text[over:at]
        begin = over + len(left.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
        over = found.end() if found else at + 1
        at = text.find("@", over)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans that pattern and check alone accept, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    parts = numeric_parts(text)
    if parts:
        for m in matches(IP, text, parts):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in matches(CARD, text, parts):
            d = digits_of(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in matches(PHONE, text, parts):
            if 10 <= len(digits_of(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def windows(text: str, start: int, end: int):
    """(start, end, digits) of all consecutive groups of a number that hold up to 19 digits, so at most 19 a group."""
    groups = [m.span() for m in DIGITS.finditer(text, start, end)]
    for i, (a, _) in enumerate(groups):
        begin = start if not i else a - (text[a - 1] == "(")
        n = 0
        for x, b in groups[i : i + 19]:
            n += b - x
            if n > 19:
                break
            yield begin, b, n


def proposed(text: str, longest: int | None = None) -> list[tuple[int, int, int]]:
    """More spans that may be personal data, overlapping ones too; with ``longest``, without those
    of longer runs of numbers."""
    out = set()
    for m in WRITTEN_AT.finditer(text):
        over = m.start() - (text[m.start() - 1 : m.start()] == " ")
        left = text[max(0, over - 64) : over]
        begin = over - len(left) + len(left.rstrip(LOCAL))
        domain = WRITTEN_DOMAIN.match(text, m.end())
        if begin < over and domain:
            out.add((begin, 0, domain.end()))
    for m in matches(NUMBER, text, numeric_parts(text)):
        if longest is not None and m.end() - m.start() > longest:
            continue
        for a, b, n in windows(text, *m.span()):
            if 4 <= n <= 12 and text.count(".", a, b) == 3:
                out.add((a, 1, b))
            if 13 <= n <= 19:
                out.add((a, 2, b))
            if 7 <= n <= 15:
                out.add((a, 3, b))
    return sorted(out)


def neighbour(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalnum() else 2 if c in ".,;:!?)" else 3


def span_features(text: str, start: int, kind: int, end: int) -> list[float]:
    s = text[start:end]
    groups = [len(g) for g in re.findall(r"[0-9]+", s)] or [0]
    d = digits_of(s)
    before = text[max(0, start - 24) : start]
    parts = s.split(".")
    return [
        kind, len(s), len(d), sum(map(str.isalpha, s)), s.count(" "), s.count("-"), s.count("."),
        s.count("("), s.count("/"), len(groups), groups[0], groups[-1], max(groups), len(set(d)),
        s.startswith("+"), s.startswith("("), bool(d) and luhn(d),
        len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
        s.count(")") == s.count("("), neighbour(text[start - 1 : start]), neighbour(text[end : end + 1]),
        bool(CUES[KINDS[kind]].search(before)), bool(ORDINAL.search(before)), "@" in s or "at" in s.lower(),
    ]


def surely_wrong(text: str, start: int, kind: int, end: int) -> bool:
    """Whether a check, a date's form or the word before tells that a proposal is something else."""
    s = text[start:end]
    if kind == 1:
        return any(len(p.lstrip("0")) > 3 or int(p or 0) > 255 for p in re.sub("[^0-9.]", "", s).split("."))
    if kind == 2 and not luhn(digits_of(s)):
        return True
    return kind in (2, 3) and bool(DATE.fullmatch(s) or ORDINAL.search(text[max(0, start - 24) : start]))


def variants_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[list[float], int]]:
    """(features, 1 for personal data) of base spans and of variants of them."""
    out = []
    for a, kind, b in base:
        out.append((span_features(text, a, kind, b), 1))
        before, s, after = text[max(0, a - 24) : a], text[a:b], text[b : b + 1]
        if kind == 0:
            local, _, domain = s.partition("@")
            variants = [(f"{local}{at}{domain}", 1) for at in (" [at] ", "(at)")]
        elif kind == 1:
            variants = [(s.replace(".", "-"), 0), (re.sub(r"^[0-9]+", "999", s), 0)]
        elif kind == 2:
            d = digits_of(s)
            wrong = d[:-1] + str((int(d[-1]) + 5) % 10)
            parts = lambda x, by: by.join(x[i : i + 4] for i in range(0, len(x), 4))
            variants = [(parts(d, "."), 1), (parts(d, "/"), 1), (wrong, 0), (parts(wrong, " "), 0)]
        else:
            bare = re.sub(r"^\+[0-9]+[ .-]*", "", s)
            variants = [(bare, 1 if re.search(r"[ ().-]", bare) else 0), (digits_of(s), 0)]
        for v, good in variants:
            if len(digits_of(v)) >= 7 or kind == 0:
                out.append((span_features(before + v + after, len(before), kind, len(before) + len(v)), good))
    return out


Spans = tuple[np.ndarray, np.ndarray, np.ndarray]


def proposals(text: str, base: list[tuple[int, int, int]]) -> Iterator[Spans]:
    """((start, kind, end), features, whether surely wrong) of all proposals that no base span
    overlaps, in blocks: what is held at once does not grow with the text."""
    short = _clear_of(proposed(text, LONG_RUN), base)
    for k in range(0, len(short), SCORED_SPANS):
        part = short[k : k + SCORED_SPANS]
        yield (
            np.array(part), np.array([span_features(text, *x) for x in part], float),
            np.array([surely_wrong(text, *x) for x in part], bool),
        )
    starts = np.array([a for a, _, _ in base])
    reach = np.maximum.accumulate([-1, *(b for _, _, b in base)])
    for m in matches(NUMBER, text, [x for x in numeric_parts(text) if x[1] - x[0] > LONG_RUN]):
        if m.end() - m.start() > LONG_RUN:
            for spans, f in NumberRun(text, *m.span()).windows():
                keep = np.flatnonzero(reach[np.searchsorted(starts, spans[:, 2], side="left")] <= spans[:, 0])
                if len(keep):
                    yield _table_features(text, m.start(), spans[keep], {k: v[keep] for k, v in f.items()})


def _table_features(text: str, start: int, spans: np.ndarray, f: dict[str, np.ndarray]) -> Spans:
    """Of windows of a run of numbers that begins at ``start``: the same as for single spans."""
    kind, zero = int(spans[0, 1]), np.zeros(len(spans))
    cue, ordinal = np.zeros(len(spans), bool), np.zeros(len(spans), bool)
    for k in np.flatnonzero(spans[:, 0] < start + CONTEXT):  # further on, only numbers stand before
        before = text[max(0, spans[k, 0] - CONTEXT) : spans[k, 0]]
        cue[k], ordinal[k] = bool(CUES[KINDS[kind]].search(before)), bool(ORDINAL.search(before))
    around = [np.array([neighbour(text[at : at + 1] if at >= 0 else "") for at in places.tolist()])[back]
              for places, back in (np.unique(x, return_inverse=True) for x in (spans[:, 0] - 1, spans[:, 2]))]
    x = np.stack([
        zero + kind, f["size"], f["digits"], zero, f[" "], f["-"], f["."], f["("], f["/"], f["groups"], f["first"], f["last"],
        f["longest"], f["different"], f["plus"], f["opens"], f["luhn"], f["address"], f[")"] == f["("], *around, cue, ordinal, zero,
    ], axis=1).astype(float)
    wrong = ordinal & (kind in (2, 3))
    if kind == 2:
        wrong = wrong | ~f["luhn"]
    ask = np.flatnonzero(~wrong & ((kind == 1) | (kind == 3) & (f["groups"] == 3) & (f["size"] <= 10)))
    for k in ask:
        wrong[k] = surely_wrong(text, *spans[k].tolist())
    return spans, x, wrong


def known_blocks(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, 1 for personal data) of base spans and variants of them, in blocks."""
    for k in range(0, len(base), SCORED_SPANS):
        found = variants_of(text, base[k : k + SCORED_SPANS])
        yield np.array([v for v, _ in found], float), np.array([y for _, y in found])


def training_blocks(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, 1 for personal data) of base spans, variants of them and look-alikes, in blocks.

    Proposals of the corpus whose truth is unknown are left out: they may be what is to be added.
    """
    base = base_spans(text)
    yield from known_blocks(text, base)
    for _, x, wrong in proposals(text, base):
        if wrong.any():
            yield x[wrong], np.zeros(int(wrong.sum()), np.int64)


def training_spans(text: str) -> list[tuple[list[float], int]]:
    """The same, one by one."""
    return [(list(v), int(k)) for x, y in training_blocks(text) for v, k in zip(x.tolist(), y)]


def distinct_scores(trees: BoostedTrees, x: np.ndarray) -> np.ndarray:
    """Scores of rows, each different row scored once: a digit table has few."""
    rows, back = np.unique(x @ SALT[: x.shape[1]], return_index=True, return_inverse=True)[1:]
    return trees.score(x[rows])[back.reshape(-1)]


SALT = np.random.default_rng(0).uniform(1, 2, 64)  # tells different rows apart


@dataclass
class SpanModel:
    trees: BoostedTrees
    thresholds: tuple

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Proposed spans that pass, best first, none overlapping another or a base span. What a check
        rules out is not scored."""
        ranked = []
        for spans, x, wrong in proposals(text, base):
            spans, x = spans[~wrong], x[~wrong]
            if len(x):
                p = distinct_scores(self.trees, x)
                good = np.flatnonzero(p >= np.array(self.thresholds)[spans[:, 1]])
                ranked += zip((-p[good]).tolist(), map(tuple, spans[good].tolist()))
        return chosen_spans(ranked)


def chosen_spans(ranked: list[tuple[float, tuple[int, int, int]]]) -> list[tuple[int, int, int]]:
    """Of (negative score, span) the best spans, none overlapping another."""
    ranked.sort(key=lambda r: (r[0], r[1][0] - r[1][2], r[1]))  # of equal ones the longest
    chosen: list[tuple[int, int, int]] = []
    taken: dict[int, tuple] = {}
    for _, s in ranked:
        cells = range(s[0] >> 6, (s[2] >> 6) + 1)
        if all(not (x[0] < s[2] and s[0] < x[2]) for c in cells for x in taken.get(c, ())):
            chosen.append(s)
            for c in cells:
                taken[c] = (*taken.get(c, ()), s)
    return chosen


def _clear_of(new: list, base: list) -> list:
    """Spans of ``new`` that no span of ``base`` overlaps; one pass over both in order."""
    if not base or not new:
        return new
    starts = np.array([a for a, _, _ in base])
    reach = np.maximum.accumulate([b for _, _, b in base])
    k = np.searchsorted(starts, [b for _, _, b in new], side="left")
    return [s for s, i in zip(new, k.tolist()) if i == 0 or reach[i - 1] <= s[0]]


def held_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A written table of all rows: ``row_id``, ``row_text`` (empty where it holds no span) and whether
    the text is among those of each of SAMPLED. What follows reads this table, not ``docs``."""
    texts = id_and_text(docs, id_col, text_col)
    texts = texts.select("row_id", F.when(F.col("row_text").rlike(MAY_HOLD), F.col("row_text")).otherwise("").alias("row_text"))
    return stored(texts.select("*", *[F.expr(p).alias(f"sampled_{k}") for k, p in enumerate(SAMPLED)]), "held")


def fit_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SpanModel:
    """Trees of ``fit_span_trees`` and thresholds calibrated on all texts.

    Each kind gets the lowest threshold (LEAST_THRESHOLD at least) at which PRECISION of the accepted
    training spans of all texts are right. A kind without accepted spans in any text is not added.
    """
    texts = held_texts(docs, id_col, text_col)
    trees = fit_span_trees(texts)
    return SpanModel(trees, calibrated(texts, trees))


def fit_span_trees(texts: DataFrame) -> BoostedTrees:
    """Trees are fitted on at most SAMPLE_TEXTS of the ``held_texts``, so many of each kind and of those
    with digits or @, chosen by a hash of the identifier: a rare kind has its share."""
    texts = texts.where("row_id IS NOT NULL")
    chosen = reduce(DataFrame.union, [
        texts.where(f"sampled_{k}").select("row_id").orderBy(F.xxhash64("row_id"), "row_id").limit(SAMPLE_TEXTS // len(SAMPLED))
        for k in range(len(SAMPLED))
    ]).distinct()
    rows = texts.select("row_id", "row_text").join(F.broadcast(chosen), "row_id", "left_semi")

    def run(batches):
        for b in batches:
            for t in b.column(1).to_pylist():
                for x, y in training_blocks(t):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(y.astype(np.int32))], names=["x", "y"]
                    )

    spans = rows.mapInArrow(tidy(run), "x array<double>, y int").orderBy(F.xxhash64("x"), "x", "y").limit(SAMPLE_SPANS).toPandas()
    x = np.array([list(map(float, v)) for v in spans["x"]], float).reshape(len(spans), len(span_features("0", 0, 1, 1)))
    y = spans["y"].to_numpy(float)
    return fit_trees(x, y)


def calibrated(pairs: DataFrame, trees: BoostedTrees) -> tuple:
    """The threshold of each kind, from counts of (kind, score bin, right) over all texts."""

    def run(batches):
        counts = np.zeros((len(KINDS), BINS, 2), np.int64)

        def add(held):
            if held:
                x, y = (np.concatenate(v) for v in zip(*held))
                at = np.minimum((distinct_scores(trees, x) * BINS).astype(np.int64), BINS - 1)
                np.add.at(counts, (x[:, 0].astype(np.int64), at, y), 1)

        held, size = [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                for x, y in training_blocks(t):
                    if len(x):
                        held.append((x, y))
                        size += len(x)
                    if size >= SCORED_SPANS:
                        add(held)
                        held, size = [], 0
        add(held)
        used = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*used, counts[used])], names=["kind", "bin", "right", "n"])

    return thresholds_of(pairs.where("row_text <> ''").select("row_text").mapInArrow(tidy(run), "kind long, bin long, right long, n long"))


def thresholds_of(found: DataFrame) -> tuple:
    """The threshold of each kind from rows (kind, bin, right, n)."""
    counts = np.zeros((len(KINDS), BINS, 2), np.int64)
    for r in found.groupBy("kind", "bin", "right").agg(F.sum("n").alias("n")).collect():  # at most two a kind and bin
        counts[r["kind"], r["bin"], r["right"]] = r["n"]
    least = int(np.ceil(LEAST_THRESHOLD * BINS))
    thresholds = []
    for kind in counts:
        right, of = (np.cumsum(v[::-1])[::-1] for v in (kind[:, 1], kind.sum(axis=1)))
        good = least + np.flatnonzero((of > 0)[least:] & (right >= PRECISION * of)[least:])
        thresholds.append(float(good[0] / BINS) if len(good) else 2.0)
    return tuple(thresholds)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def all_spans(text: str, model: SpanModel) -> tuple[list, list]:
    """(base spans, all spans) of one text, by start, kind and end."""
    base = base_spans(text)
    added = model.added(text, base) if ANY_DIGIT.search(text) or WRITTEN_AT.search(text) else []
    return base, sorted({*base, *added})


def span_columns(found: list[tuple[list, list]]) -> list:
    """The result columns of texts with these base spans and all spans."""
    counts = np.zeros((len(KINDS), len(found)), np.int64)
    digests = []
    for i, (base, _) in enumerate(found):
        for _, k, _ in base:
            counts[k, i] += 1
        digests.append(hashlib.sha256(written(base).encode()).hexdigest())
    return [*counts, pa.array(digests, pa.string()), pa.array([written(spans) for _, spans in found], pa.string())]


SPAN_FIELDS = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
SPAN_FIELDS += [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]


def private_spans(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the number of base spans of each kind, ``base_sha256`` and
    ``spans`` (``kind:start:end`` in code points, comma-joined).

    Null and empty texts have none: zero counts, the digest of the empty text, empty ``spans``.
    """

    def start():
        return lambda texts: span_columns([all_spans(t, model) for t in texts])

    return map_texts(docs, id_col, text_col, SPAN_FIELDS, start)


def fitted_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``private_spans`` of the model that ``fit_private`` makes of the same ``docs``.

    The texts are worked through once for the thresholds and the spans: what may pass is written with
    its score, per document, and chosen from that table once the thresholds are known.
    """
    texts = held_texts(docs, id_col, text_col)
    trees = fit_span_trees(texts)
    judged = stored(judged_texts(texts, trees), "judged")
    thresholds = np.array(thresholds_of(judged.selectExpr("inline(learned)")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for base, (*spans, score) in zip(_struct_lists(b.column("base")), _struct_lists(b.column("more"))):
                base, added = list(zip(*(v.tolist() for v in base))), []
                if len(score):
                    good = score >= thresholds[spans[1]]
                    added = chosen_spans(list(zip((-score[good]).tolist(), zip(*(v[good].tolist() for v in spans)))))
                found.append((base, sorted({*base, *added})))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), *(c if isinstance(c, pa.Array) else pa.array(c) for c in span_columns(found))], names=schema.names
            )

    table = judged.select("row_id", "base", "more")
    schema = T.StructType([table.schema["row_id"], *SPAN_FIELDS])
    return table.mapInArrow(tidy(run), schema).withColumnRenamed("row_id", id_col)


def _struct_lists(column: pa.ListArray) -> Iterator[list[np.ndarray]]:
    """The fields of each row's list of structs."""
    fields = [f.to_numpy(zero_copy_only=False) for f in column.flatten().flatten()]
    none, at = [f[:0] for f in fields], 0
    for n in column.value_lengths().to_pylist():
        yield [f[at : at + n] for f in fields] if n else none
        at += n


def _list_column(of: np.ndarray, rows: int, fields: dict[str, np.ndarray]) -> pa.ListArray:
    """A list of structs for each of ``rows`` rows; ``of``, in ascending order, holds the row of each."""
    structs = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], names=list(fields))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(rows + 1)), pa.int32()), structs)


JUDGED = (
    "base array<struct<start:bigint,kind:bigint,end:bigint>>, "
    "more array<struct<start:bigint,kind:bigint,end:bigint,score:double>>, "
    "learned array<struct<kind:bigint,bin:bigint,right:bigint,n:bigint>>"
)


def judged_texts(pairs: DataFrame, trees: BoostedTrees) -> DataFrame:
    """One row per text: its ``row_id``, base spans, proposals that may pass and what its training
    spans tell about thresholds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, 1, JUDGED_BYTES):
            texts, rows = b.column(1).to_pylist(), b.num_rows
            bases = [base_spans(t) for t in texts]
            more, learned = [], []
            blocks = (x for k, t in enumerate(texts) if t for x in _judged_blocks(k, t, bases[k]))
            for place, kind, p in _scored(blocks, trees):
                of, start, end, right = place.T
                good = np.flatnonzero((right < 0) & (p >= LEAST_THRESHOLD))
                more.append([v[good] for v in (of, start, kind, end, p)])
                known = np.flatnonzero(right >= 0)
                shape = (rows, len(KINDS), BINS, 2)
                at = np.ravel_multi_index([v[known] for v in (of, kind, np.minimum((p * BINS).astype(np.int64), BINS - 1), right)], shape)
                each, n = np.unique(at, return_counts=True)
                learned.append([*np.unravel_index(each, shape), n])
            base = np.array([s for spans in bases for s in spans], np.int64).reshape(-1, 3)
            columns = [_list_column(np.repeat(np.arange(rows), [len(x) for x in bases]), rows, dict(zip(("start", "kind", "end"), base.T)))]
            for parts, names in ((more, ("start", "kind", "end", "score")), (learned, ("kind", "bin", "right", "n"))):
                kinds = [np.int64, *(float if n == "score" else np.int64 for n in names)]
                of, *fields = (np.concatenate([np.zeros(0, k), *(x[i] for x in parts)], dtype=k) for i, k in enumerate(kinds))
                columns.append(_list_column(of, rows, dict(zip(names, fields))))
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["row_id", "base", "more", "learned"])

    pairs = pairs.select("row_id", "row_text")
    return pairs.mapInArrow(tidy(run), T.StructType([pairs.schema["row_id"], *T.StructType.fromDDL(JUDGED)]))


def _judged_blocks(of: int, text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """((row, start, end, 1 for personal data, 0 for none, -1 for unknown), features) of all that a text proposes and teaches."""
    for x, y in known_blocks(text, base):
        zero = np.zeros(len(x), np.int64)
        yield np.stack([zero + of, zero, zero, y], axis=1), x
    for spans, x, wrong in proposals(text, base):
        yield np.stack([np.full(len(x), of), spans[:, 0], spans[:, 2], np.where(wrong, 0, -1)], axis=1), x


def _scored(blocks: Iterator, trees: BoostedTrees) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, kinds, scores) of the blocks, about SCORED_SPANS at once."""

    def scored():
        place, x = (np.concatenate(v) for v in zip(*held))
        return place, x[:, 0].astype(np.int64), distinct_scores(trees, x)

    held, size = [], 0
    for block in blocks:
        if len(block[0]):
            held.append(block)
            size += len(block[0])
        if size >= SCORED_SPANS:
            yield scored()
            held, size = [], 0
    if held:
        yield scored()


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping ones, replaced by its first kind."""
    out, over = [], 0
    for a, k, b in spans:
        if a >= over:
            out += [text[over:a], f"<{KINDS[k].upper()}>"]
        over = max(over, b)
    return "".join([*out, text[over:]])


def redact(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """``docs`` with every column and row, the text redacted; null texts stay null, no rows give none."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = [None if t is None else redacted(t, all_spans(t, model)[1]) for t in b.column(at).to_pylist()]
            columns = list(b.columns)
            columns[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return map_rows(docs, run)
