"""Spelling variants: words one edit apart, found by Gram matrices of blocks of letter counts.

One inserted, deleted or replaced letter moves a word's letter counts by a squared distance of at
most two, and changes at most two letters. Letters are dealt to GROUPS groups of like frequency,
so two near words agree in the counts of all but two groups. A word is therefore listed under the
counts of each choice of GROUPS - 2 groups, and near words meet under at least one of them.

Under each key words are ordered by length and cut into blocks. The product of two blocks' letter
counts gives all squared distances between them at once; pairs at most two apart, in blocks of
adjacent lengths, are verified on their letters. Many small keys share a block, and a key with
very many words is cut into tiles that meet pairwise in tasks of their own. A pair that meets under
several keys is given out under the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.rows import stored
from tickframe.llm.spans import mix

LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint32)
GROUPS = 4
CHOICES = list(combinations(range(GROUPS), GROUPS - 2))
BLOCK = 256
TILE = 4096  # words of one key that meet in one task
EXACT_LENGTH = 2000  # squared letter counts of shorter words are exact in 32-bit floats


class Words:
    """A list of words of the fixed letters as arrays: code points end to end, and letter counts."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        index = np.searchsorted(LETTERS, self.points)
        cells = np.repeat(np.arange(len(words)), self.lengths) * len(LETTERS) + index
        kind = np.float32 if not len(words) or self.lengths.max() < EXACT_LENGTH else np.float64
        self.counts = np.bincount(cells, minlength=len(words) * len(LETTERS)).reshape(len(words), -1).astype(kind)
        self.norms = (self.counts**2).sum(axis=1)

    def at(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.points[self.starts[rows] + places]


def one_edit(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b (rows; a no longer than b) differ by exactly one edit.

    Code points that agree from the front, and then from the back, must leave one.
    """
    short, long = words.lengths[a], words.lengths[b]
    front, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for ends, side in ((False, front), (True, back)):
        live = np.arange(len(a))
        k = 0
        while len(live):
            live = live[side[live] + (front[live] if ends else 0) < short[live]]
            x = short[live] - 1 - k if ends else np.full(len(live), k)
            y = long[live] - 1 - k if ends else x
            live = live[words.at(a[live], x) == words.at(b[live], y)]
            side[live] += 1
            k += 1
    return (long - short <= 1) & (front + back == long - 1)


def letter_groups(vocabulary: DataFrame) -> np.ndarray:
    """The group of each letter, dealt in turn from the most frequent on."""

    def count(batches):
        total = np.zeros(len(LETTERS), np.int64)
        for b in batches:
            points = np.frombuffer("".join(b.column(0).to_pylist()).encode("utf-32-le"), np.uint32)
            total += np.bincount(np.searchsorted(LETTERS, points), minlength=len(LETTERS))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(LETTERS), dtype=np.int32)), pa.array(total)], names=["letter", "n"])

    found = np.zeros(len(LETTERS), np.int64)
    for r in vocabulary.select("word").mapInArrow(count, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        found[r["letter"]] = r["n"]  # one row per letter of the alphabet
    groups = np.empty(len(LETTERS), np.int64)
    groups[np.argsort(-found, kind="stable")] = np.arange(len(LETTERS)) % GROUPS
    return groups


def group_hashes(counts: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """For each word and group a 64-bit hash of the counts of the group's letters."""
    weights = mix(np.arange(1, len(LETTERS) + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        terms = counts.astype(np.uint64) * weights
        return np.stack([mix(terms[:, groups == g].sum(axis=1, dtype=np.uint64)) for g in range(GROUPS)], axis=1)


def choice_keys(hashes: np.ndarray) -> np.ndarray:
    """The key of each word (row) under each choice of groups (column)."""
    keys = []
    for c, chosen in enumerate(CHOICES):
        key = np.full(len(hashes), c + 1, np.uint64)
        for g in chosen:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[:, g])
        keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def listed(vocabulary: DataFrame, groups: np.ndarray) -> DataFrame:
    """(key, choice, length, word, n): every word under each of its keys."""

    def run(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            made = Words(words)
            keys = choice_keys(group_hashes(made.counts, groups))
            rows = np.repeat(np.arange(len(words)), len(CHOICES))
            take = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.reshape(-1)), pa.array(np.tile(np.arange(len(CHOICES), dtype=np.int32), len(words))),
                pa.array(made.lengths[rows]), take.column(0), take.column(1),
            ], names=["key", "choice", "length", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "key long, choice int, length long, word string, n long")


def block_pairs(words: Words, keys: np.ndarray, one: slice, two: slice) -> tuple[np.ndarray, np.ndarray]:
    """Rows a < b of two blocks with one key, lengths at most one apart, squared distance at most two."""
    product = words.counts[one] @ words.counts[two].T
    far = words.norms[one][:, None] + words.norms[two][None, :] - 2 * product
    near = (far <= 2) & (keys[one][:, None] == keys[two][None, :])
    a, b = np.nonzero(near)
    a, b = a + one.start, b + two.start
    keep = (a < b) & (np.abs(words.lengths[a] - words.lengths[b]) <= 1)
    return a[keep], b[keep]


def sorted_pairs(words: Words, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Close rows of words sorted by key and length, block against block."""
    n = len(keys)
    for i in range(0, n, BLOCK):
        one = slice(i, min(i + BLOCK, n))
        last_key, last_length = keys[one.stop - 1], words.lengths[one.stop - 1]
        for j in range(i, n, BLOCK):
            if j > i and (keys[j] != last_key or words.lengths[j] > last_length + 1):
                break
            yield block_pairs(words, keys, one, slice(j, min(j + BLOCK, n)))


def confirmed(words: Words, groups: np.ndarray, choice: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are one edit apart and meet here under their first common key."""
    swap = words.lengths[a] > words.lengths[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    good = one_edit(words, a, b)
    a, b = a[good], b[good]
    same = np.stack([(words.counts[a][:, groups == g] == words.counts[b][:, groups == g]).all(axis=1) for g in range(GROUPS)], axis=1)
    met = np.stack([same[:, list(c)].all(axis=1) for c in CHOICES], axis=1)
    first = met.argmax(axis=1) == choice[a]
    return a[first], b[first]


PAIRS = "word string, n long, near string, near_n long"


def pair_rows(words: list[str], n: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Both directions of the pairs."""
    a = np.concatenate([np.concatenate(p) for p in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([np.concatenate(p[::-1]) for p in found]) if found else a
    text = pa.array(words, pa.string())
    return pa.RecordBatch.from_arrays([text.take(pa.array(a)), pa.array(n[a]), text.take(pa.array(b)), pa.array(n[b])], names=["word", "n", "near", "near_n"])


def near_in_runs(rows: DataFrame, groups: np.ndarray) -> DataFrame:
    """Near words among rows dealt by key and sorted; a key's rows stay together, at most TILE of them."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0

        def work(table: pa.RecordBatch) -> pa.RecordBatch:
            words = table.column(3).to_pylist()
            made, keys, choice = Words(words), table.column(0).to_numpy(), table.column(1).to_numpy()
            found = [confirmed(made, groups, choice, *p) for p in sorted_pairs(made, keys)]
            return pair_rows(words, table.column(4).to_numpy(), found)

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size > 2 * TILE:
                table = pa.Table.from_batches(held).combine_chunks()
                keys = table.column("key").to_numpy()
                # The last key may go on in the next batch.
                whole = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
                if whole:
                    yield work(table.slice(0, whole).combine_chunks().to_batches()[0])
                held = table.slice(whole).to_batches()
                size = len(keys) - whole
        if size:
            yield work(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    dealt = rows.select("key", "choice", "length", "word", "n").repartition("key").sortWithinPartitions("key", "length", "word")
    return dealt.mapInArrow(run, PAIRS)


def near_in_tiles(rows: DataFrame, groups: np.ndarray) -> DataFrame:
    """Near words under keys (with ``cut`` tiles each) that are too long for one task."""
    tile = F.pmod(F.xxhash64("word"), F.col("cut")).cast("int")
    both = F.transform(F.sequence(F.lit(0), F.col("cut") - 1), lambda k: F.struct(F.least("tile", k).alias("i"), F.greatest("tile", k).alias("j")))
    dealt = rows.withColumn("tile", tile).withColumn("t", F.explode(both)).select("key", "choice", "length", "word", "n", "tile", "t.i", "t.j")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tile", "ascending"), ("length", "ascending")])
        words, tile = table.column("word").to_pylist(), table.column("tile").to_numpy()
        made, keys, choice = Words(words), table.column("key").to_numpy(), table.column("choice").to_numpy()
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        found = []
        if i == j:
            found = [confirmed(made, groups, choice, *p) for p in sorted_pairs(made, keys)]
        else:
            border, n = int(np.searchsorted(tile, j)), len(words)
            for a in range(0, border, BLOCK):
                one = slice(a, min(a + BLOCK, border))
                for b in range(border, n, BLOCK):
                    two = slice(b, min(b + BLOCK, n))
                    if made.lengths[two.stop - 1] >= made.lengths[one.start] - 1 and made.lengths[two.start] <= made.lengths[one.stop - 1] + 1:
                        found.append(confirmed(made, groups, choice, *block_pairs(made, keys, one, two)))
        return pa.Table.from_batches([pair_rows(words, table.column("n").to_numpy(), found)])

    return dealt.groupBy("key", "i", "j").applyInArrow(run, PAIRS)


def near_words(vocabulary: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n, near, near_n): all pairs of different words one edit apart, in both directions.

    ``vocabulary``: distinct words of the fixed letters and their counts (word, n).
    """
    groups = letter_groups(vocabulary)
    rows = listed(vocabulary, groups)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile)
    long = stored(sizes.select("key", F.ceil(F.col("size") / tile).cast("int").alias("cut")), "long")
    if long.isEmpty():
        return near_in_runs(rows, groups)
    short = rows.join(long, "key", "left_anti")
    return near_in_runs(short, groups).union(near_in_tiles(rows.join(long, "key"), groups))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of (word, form): the end of its chain of forms.

    Forms rise in count by a factor, so chains are short; each round doubles the steps taken.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(reached.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ), "roots")
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def spelling_variants(vocabulary: DataFrame, times: int = 10, tile: int = TILE) -> DataFrame:
    """One row per word: ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    The form is the near word with the largest count, the first in code-point order of equal ones, if
    that count is at least ``times`` the word's own; else null. The root is where the forms lead,
    the word itself without one.
    """
    vocabulary = stored(vocabulary.select("word", "n"), "vocabulary")
    near = near_words(vocabulary, tile).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best")
    )
    whole = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.m") >= times * F.col("n"), F.col("best")).alias("best"),
    )
    whole = stored(whole.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.m")).alias("form_n")), "forms")
    ends = roots(whole.where(F.col("form").isNotNull()))
    return whole.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
