"""A word n-gram model in compressed, memory-mapped levels, trained and used on whole tables.

Level one lists the words (as 64-bit hashes, in order, so a word's number is its rank) with their
counts. Level two is the children of each word: Elias-Fano pointers from a word to its range, the
following words in that range made monotone by adding the last value of the range before, also
Elias-Fano coded, and their smoothed probabilities as 16-bit steps. A word pair is found by a
successor search relative to its context; its place is its number. Level three is the same for the
children of each pair. Probabilities interpolate discounted frequencies of triples with those of
pairs, and these with add-one word frequencies. What is seen less than ``least_count`` times gives
its mass to the level below; with 1 nothing is dropped.

Levels are cut into shards by the mass of the contexts. A context with a large share of all tokens
gets shards of its own, by ranges of the following word. Counting tasks send sorted runs, already
summed, to the shards; a shard is merged, coded and written to the shared folder by one task and
mapped by all. The driver holds one entry per shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickframe.llm.elias_fano import EliasFano, encode
from tickframe.llm.rows import gathered, id_and_text, map_texts
from tickframe.llm.shared_files import read_arrays, write_arrays
from tickframe.llm.spans import text_batches, word_hashes
from tickframe.llm.workers import tidy
from tickframe.session import scratch_path

SHARD_CHARS = 32_000_000  # text per shard
LEAST_SHARDS, MOST_SHARDS = 16, 1 << 20
HOT_PARTS = 4  # a context with more than 1 / (HOT_PARTS * shards) of all tokens is split off
RUN_ENTRIES = 1 << 20
LEAST_COUNT = 1  # pairs and triples seen less often leave their mass to the level below
ORDER = 3
DISCOUNT = 0.75
STEP = 1 / 7000  # of the logarithm of a stored probability
PROBABILITIES = 10.0 ** (-STEP * np.arange(1 << 16))  # by code
END = np.uint64(0xE0D0E0D0E0D0E0D1)  # stands for the end of a text among the word hashes
BATCH_CHARS = 16 << 20  # of text that are looked up together: every shard is asked once for them
HASHED_CHARS = 1 << 18  # at once: their arrays fit a processor's cache


def token_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens (the words, then one end) of all texts, and tokens per text."""
    parts = [word_hashes(part) for _, part in text_batches(texts, HASHED_CHARS)] or [word_hashes([])]
    words, counts = (np.concatenate(x) for x in zip(*parts))
    tokens = np.full(len(words) + len(texts), END, np.uint64)
    ends = np.cumsum(counts + 1) - 1
    is_word = np.ones(len(tokens), bool)
    is_word[ends] = False
    tokens[is_word] = words
    return tokens, counts + 1


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def planes(x: np.ndarray) -> bytes:
    """All first bytes of 64-bit numbers, then all second ones: those of small numbers compress well."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).reshape(-1)


class Run:
    """Counts of keys, kept sorted and summed, handed out as one piece per shard."""

    def __init__(self, shard_starts: np.ndarray):
        self.starts, self.parts, self.size = shard_starts, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray):
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > 2 * RUN_ENTRIES:
            self._merge()

    def _merge(self):
        if len(self.parts) > 1:  # a single one is sorted and summed
            self.parts = [summed(*(np.concatenate(x) for x in zip(*self.parts)))]
        self.size = len(self.parts[0][0])

    def full(self) -> bool:
        return len(self.parts) == 1 and self.size > RUN_ENTRIES

    def pieces(self):
        if not self.parts:
            return
        self._merge()
        [(keys, counts)], self.parts, self.size = self.parts, [], 0
        cut = np.append(np.searchsorted(keys, self.starts), len(keys))
        used = np.flatnonzero(cut[1:] > cut[:-1])
        yield pa.RecordBatch.from_arrays([
            pa.array(used.astype(np.int32)),
            pa.array([planes(np.diff(keys[cut[s] : cut[s + 1]], prepend=keys.dtype.type(0))) for s in used], pa.binary()),
            pa.array([planes(counts[cut[s] : cut[s + 1]].astype(np.int64)) for s in used], pa.binary()),
        ], names=["shard", "keys", "counts"])


PIECE = "shard int, keys binary, counts binary"


def merged_pieces(table: pa.Table, kind) -> tuple[int, np.ndarray, np.ndarray]:
    keys = np.concatenate([np.cumsum(from_planes(x, kind), dtype=kind) for x in table.column("keys").to_pylist()])
    counts = np.concatenate([from_planes(x, np.int64) for x in table.column("counts").to_pylist()])
    return table.column("shard")[0].as_py(), *summed(keys, counts)


@dataclass
class Words:
    """Level one: shard s holds the hashes from ``starts[s]`` on; word numbers begin at bases[s]."""

    folder: str
    starts: np.ndarray
    bases: np.ndarray  # one more than shards
    tokens: int = 0
    hot: list = field(default_factory=list)  # (word number, count) of the frequent contexts

    @property
    def width(self) -> int:
        """Keys are context * width + word; the last word stands for all unknown ones."""
        return int(self.bases[-1]) + 1

    def file(self, shard: int) -> dict:
        return read_arrays(f"{self.folder}/words-{shard}")

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count) of sorted distinct hashes."""
        numbers, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cut = np.append(np.searchsorted(hashes, self.starts), len(hashes))
        for s in np.flatnonzero(cut[1:] > cut[:-1]):
            size = int(self.bases[s + 1] - self.bases[s])
            if size:
                f, part = self.file(int(s)), slice(cut[s], cut[s + 1])
                at = np.minimum(np.searchsorted(f["hashes"], hashes[part]), size - 1)
                hit = f["hashes"][at] == hashes[part]
                numbers[part] = np.where(hit, at + self.bases[s], -1)
                counts[part] = np.where(hit, f["counts"][at], 0)
        return numbers, counts

    def count_of(self, numbers: np.ndarray) -> np.ndarray:
        """Counts of word numbers in ascending order."""
        out = np.zeros(len(numbers), np.int64)
        cut = np.searchsorted(numbers, self.bases)
        for s in np.flatnonzero(cut[1:] > cut[:-1]):
            part = slice(cut[s], cut[s + 1])
            out[part] = self.file(int(s))["counts"][numbers[part] - self.bases[s]]
        return out

    def numbered(self, texts: list):
        """(numbers, counts, tokens per text) of all tokens of the texts."""
        hashes, lengths = token_hashes(texts)
        distinct, index = np.unique(hashes, return_inverse=True)
        numbers, counts = self.find(distinct)
        index = index.reshape(-1)
        return numbers[index], counts[index], lengths


def contexts(numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The token before each token; before a text's first one, the end of another."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    if len(numbers):
        before[0] = numbers[-1]  # an end, as the last token of every text is
    return before


def fit_words(texts: DataFrame, folder: str, shards: int) -> Words:
    starts = (np.arange(shards, dtype=np.uint64) * np.uint64((1 << 64) // shards))

    def count(batches):
        run = Run(starts)
        for b in gathered(batches, 0, BATCH_CHARS):
            for _, part in text_batches(b.column(0).to_pylist(), BATCH_CHARS):
                run.add(*np.unique(token_hashes(part)[0], return_counts=True))
                if run.full():
                    yield from run.pieces()
        yield from run.pieces()

    def build(table: pa.Table) -> pa.Table:
        shard, keys, counts = merged_pieces(table, np.uint64)
        write_arrays(f"{folder}/words-{shard}", {"hashes": keys, "counts": counts})
        total = int(counts.sum())
        top = np.flatnonzero(counts > total / (2 * HOT_PARTS))  # at most 2 * HOT_PARTS of a shard
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "size": pa.array([len(keys)], pa.int64()), "total": pa.array([total], pa.int64()),
            "top": pa.array([top.tolist()], pa.list_(pa.int64())), "count": pa.array([counts[top].tolist()], pa.list_(pa.int64())),
        })

    built = texts.mapInArrow(tidy(count), PIECE).groupBy("shard").applyInArrow(
        build, "shard int, size long, total long, top array<long>, count array<long>"
    ).collect()  # one row per shard
    sizes = np.zeros(shards, np.int64)
    for r in built:
        sizes[r["shard"]] = r["size"]
    words = Words(folder, starts, np.concatenate(([0], np.cumsum(sizes))), sum(r["total"] for r in built))
    limit = words.tokens / (HOT_PARTS * shards)
    words.hot = sorted(
        (int(words.bases[r["shard"]]) + k, n) for r in built for k, n in zip(r["top"], r["count"]) if n > limit
    )
    return words


@dataclass
class Level:
    """Level two or three: shard s holds the keys (context * width + word) from ``starts[s]`` on;
    numbers of its entries begin at bases[s]."""

    folder: str
    name: str
    width: int
    starts: np.ndarray
    bases: np.ndarray  # one more than shards
    left: dict = field(default_factory=dict)  # mass that split contexts leave to the level below
    hot: list = field(default_factory=list)  # (number, count) of the frequent entries

    def file(self, shard: int) -> LevelShard:
        return LevelShard(read_arrays(f"{self.folder}/{self.name}-{shard}"))

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(discounted probability or 0, mass left by the context, number or -1) of sorted distinct keys."""
        found, left, numbers = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), -1, np.int64)
        cut = np.append(np.searchsorted(keys, self.starts), len(keys))
        for s in np.flatnonzero(cut[1:] > cut[:-1]):
            part = slice(cut[s], cut[s + 1])
            context = keys[part] // self.width
            found[part], left[part], place = self.file(int(s)).look_up(context, keys[part] - context * self.width)
            numbers[part] = np.where(place >= 0, place + self.bases[s], -1)
        for c, mass in self.left.items():
            a, b = np.searchsorted(keys, [c * self.width, (c + 1) * self.width])
            left[a:b] = mass
        return found, left, numbers

    def look_up_all(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for contexts and words in any order."""
        distinct, index = np.unique(context * self.width + word, return_inverse=True)
        index = index.reshape(-1)
        return tuple(x[index] for x in self.look_up(distinct))


class LevelShard:
    def __init__(self, arrays: dict):
        self.first, self.contexts = (int(x) for x in arrays["span"])
        self.codes, self.left = arrays["codes"], arrays["left"]
        self.pointers, self.words = EliasFano(arrays, "pointer_"), EliasFano(arrays, "word_")

    def look_up(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(discounted probability or 0, mass left by the context, place or -1)."""
        context = context - self.first
        found, left, at_place = np.zeros(len(word)), np.ones(len(word)), np.full(len(word), -1, np.int64)
        if not self.words.n:
            return found, left, at_place
        new = np.ones(len(word), bool)
        new[1:] = context[1:] != context[:-1]
        at = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        own = context[at]
        known = (own >= 0) & (own < self.contexts)
        own = np.where(known, own, 0)
        begin, end = self.pointers.access_both(own)
        end = np.where(known, end, begin)
        base = np.where(begin > 0, self.words.access(np.maximum(begin - 1, 0)), 0)
        left = np.where(known, self.left[own] / 65535.0, 1.0)[which]
        rows = np.flatnonzero((end > begin)[which])
        k = which[rows]
        target = base[k] + word[rows] + 1
        place, same = self.words.find(target)
        same &= place < end[k]
        found[rows[same]] = PROBABILITIES[self.codes[place[same]]]
        at_place[rows[same]] = place[same]
        return found, left, at_place


def coded_level(keys: np.ndarray, width: int, probabilities: np.ndarray, first: int, contexts_: int, hot: bool) -> dict:
    """The arrays of one shard; ``keys`` sorted."""
    context, word = keys // width - first, keys % width + 1
    pointers = np.searchsorted(context, np.arange(contexts_ + 1))
    # Within a range a value is the word, from 1 on, plus the last value of the ranges before.
    used = np.flatnonzero(np.diff(pointers) > 0)
    lasts = word[pointers[used + 1] - 1] if len(used) else np.zeros(0, np.int64)
    before = np.concatenate(([0], np.cumsum(lasts)[:-1])) if len(used) else lasts
    values = word + np.repeat(before, np.diff(pointers)[used])
    mass = np.bincount(context, probabilities, contexts_) if len(keys) else np.zeros(contexts_)
    left = np.ones(contexts_) if hot else 1 - mass
    return {
        "span": np.array([first, contexts_], np.int64),
        "codes": np.round(np.minimum(-np.log10(probabilities) / STEP, 65535)).astype(np.uint16),
        "left": np.round(np.clip(left, 1 / 65535, 1) * 65535).astype(np.uint16),
        **encode(pointers, "pointer_"), **encode(values, "word_"),
    }


def level_starts(words: Words, below: Words | Level) -> np.ndarray:
    """Shard borders of a level: those of the level below, and splits of the frequent contexts."""
    total, width = int(below.bases[-1]), words.width
    share = max(1, words.tokens // max(1, len(words.starts)))
    starts = {int(b) * width for b in below.bases[:-1]}
    for c, n in below.hot:
        parts = -(-n // share)
        starts |= {c * width + k * width // parts for k in range(parts)} | {(c + 1) * width}
    return np.array(sorted(s for s in starts if s < max(total, 1) * width), np.int64)


def fit_level(texts: DataFrame, words: Words, below: Words | Level, least: int) -> Level:
    """Level two over the words, or level three over the pairs of level two."""
    starts, width = level_starts(words, below), words.width
    hot = dict(below.hot)
    folder, total = words.folder, int(below.bases[-1])
    name = "pairs" if below is words else "triples"
    borders = np.append(starts, np.int64(total * width))
    limit = words.tokens / (HOT_PARTS * len(words.starts))

    def keys_of(part: list) -> np.ndarray:
        numbers, counts, lengths = words.numbered(part)
        before = contexts(numbers, lengths)
        if below is not words:
            pair = below.look_up_all(before, numbers)[2]
            rows = with_pair(pair, lengths)
            return pair[rows - 1] * width + numbers[rows]
        often = counts >= least
        keep = often.copy()
        keep[1:] &= often[:-1]
        keep[:1] &= often[-1:]
        return before[keep] * width + numbers[keep]

    def count(batches):
        run = Run(starts)
        for b in gathered(batches, 0, BATCH_CHARS):
            for _, part in text_batches(b.column(0).to_pylist(), BATCH_CHARS):
                run.add(*np.unique(keys_of(part), return_counts=True))
                if run.full():
                    yield from run.pieces()
        yield from run.pieces()

    def build(table: pa.Table) -> pa.Table:
        shard, keys, counts = merged_pieces(table, np.int64)
        distinct, index = np.unique(keys // width, return_inverse=True)
        index = index.reshape(-1)
        if below is words:
            seen = words.count_of(distinct)
        else:  # each pair but those that end a text is followed as often as it is seen
            seen = np.bincount(index, counts, len(distinct))
            seen = np.array([hot.get(c, n) for c, n in zip(distinct.tolist(), seen.tolist())])
        p = (counts - DISCOUNT) / seen[index]
        keep = counts >= least
        keys, counts, p = keys[keep], counts[keep], p[keep]
        first = int(starts[shard] // width)
        over = int((borders[shard + 1] - 1) // width) + 1
        own = first in hot and over == first + 1
        write_arrays(f"{folder}/{name}-{shard}", coded_level(keys, width, p, first, over - first, own))
        top = np.flatnonzero(counts > limit)
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "size": pa.array([len(keys)], pa.int64()),
            "context": pa.array([first if own else -1], pa.int64()), "mass": pa.array([float(p.sum())]),
            "top": pa.array([top.tolist()], pa.list_(pa.int64())), "count": pa.array([counts[top].tolist()], pa.list_(pa.int64())),
        })

    built = texts.mapInArrow(tidy(count), PIECE).groupBy("shard").applyInArrow(
        build, "shard int, size long, context long, mass double, top array<long>, count array<long>"
    ).collect()  # one row per shard
    empty = set(range(len(starts))) - {r["shard"] for r in built}
    for shard in empty:
        first, over = int(starts[shard] // width), int((borders[shard + 1] - 1) // width) + 1
        write_arrays(f"{folder}/{name}-{shard}", coded_level(np.zeros(0, np.int64), width, np.zeros(0), first, max(over - first, 0), False))
    left: dict[int, float] = {}
    sizes = np.zeros(len(starts), np.int64)
    for r in built:
        sizes[r["shard"]] = r["size"]
        if r["context"] >= 0:
            left[r["context"]] = left.get(r["context"], 1.0) - r["mass"]
    bases = np.concatenate(([0], np.cumsum(sizes)))
    return Level(
        folder, name, width, starts, bases, {c: max(m, 1 / 65535) for c, m in left.items()},
        sorted((int(bases[r["shard"]]) + k, n) for r in built for k, n in zip(r["top"], r["count"])),
    )


def with_pair(pair: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the tokens, but for the first of each text, before which a numbered pair ends."""
    follows = np.ones(len(pair), bool)
    follows[np.cumsum(lengths) - lengths] = False
    follows[1:] &= pair[:-1] >= 0
    return np.flatnonzero(follows)


@dataclass
class LanguageModel:
    words: Words
    pairs: Level
    triples: Level | None = None

    def score(self, texts: list) -> list[np.ndarray]:
        """Tokens, known tokens, base score and score of every text."""
        numbers, counts, lengths = self.words.numbered(texts)
        of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        add = lambda x: np.bincount(of, x, len(texts))
        size = self.words.tokens + int(self.words.bases[-1]) + 1
        single = (counts + 1) / size
        out = [lengths, add(counts > 0).astype(np.int64), add(np.log10(single))]
        del counts  # arrays of all tokens are large
        before = contexts(numbers, lengths)
        p, pair = single.copy(), np.full(len(numbers), -1, np.int64)
        # A word the model does not know still takes what its context leaves to the level below.
        word = np.where(numbers >= 0, numbers, self.pairs.width - 1)
        rows = np.flatnonzero(before >= 0)
        if len(rows):
            found, left, pair[rows] = self.pairs.look_up_all(before[rows], word[rows])
            p[rows] = found + left * single[rows]
        del before, single
        rows = with_pair(pair, lengths)
        if self.triples and len(rows):
            found, left, _ = self.triples.look_up_all(pair[rows - 1], word[rows])
            p[rows] = found + left * p[rows]
        return [*out, add(np.log10(p))]


def fit_language_model(
    docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    least_count: int = LEAST_COUNT, order: int = ORDER,
) -> LanguageModel:
    """Train on the texts of all rows that ``learn`` admits (null text: empty).

    Pairs and, at ``order`` 3, triples seen at least ``least_count`` times are kept.

    The model is a folder of files in the shared scratch folder. Without rows it has no words and
    gives every token the probability of an unknown one.
    """
    usable = docs if learn is None else docs.where(learn)
    texts = id_and_text(usable, id_col, text_col).select("row_text")
    chars = texts.agg(F.sum(F.length("row_text"))).first()[0] or 0
    shards = min(max(LEAST_SHARDS, -(-chars // SHARD_CHARS)), MOST_SHARDS)
    words = fit_words(texts, scratch_path(docs.sparkSession, "ngrams"), shards)
    pairs = fit_level(texts, words, words, least_count)
    return LanguageModel(words, pairs, fit_level(texts, words, pairs, least_count) if order > 2 else None)


def model_scores(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Null, empty and wordless texts have one token, the end. Repeated rows give repeated results;
    other columns are not read.
    """

    def start():
        def compute(texts: list):
            parts = [model.score(part) for _, part in text_batches(texts, BATCH_CHARS)]
            return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2

        return compute

    fields = [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known")]
    fields += [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    scored = map_texts(docs, id_col, text_col, fields, start, gather=BATCH_CHARS)
    return scored.withColumn("train_tokens", F.lit(model.words.tokens).cast("long"))
