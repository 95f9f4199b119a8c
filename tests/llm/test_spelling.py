"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tickframe.llm.rows import prepare_texts
from tickframe.llm.spelling import Words, one_edit, spelling_variants
from tickframe.llm.word_counts import word_counts

DOCS = "doc_id long, text string, word string, n long, row_id long, row_text string"
ASCII = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows, least=7, every=31):
    out = Counter()
    for key, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                out[run] += 1
    return out


def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if apart_by_one(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def variants(spark, counts, **sizes):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(df, **sizes).collect()}


def random_counts(seed, letters, n):
    rng = random.Random(seed)
    out = {}
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 10)))
        for _ in range(3):  # words near it
            out[w] = 2 * 10 ** rng.randrange(5)
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + rng.choice(letters) + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w])
    return {w: n for w, n in out.items() if len(w) >= 7}


@pytest.mark.parametrize("seed, letters, n", [(1, "abcdefghijklmnopqrstuvwxyzéß×", 500), (2, "abcd", 600), (3, "ab", 150), (4, "é", 1)])
@pytest.mark.parametrize("tile", [4096, 16])
def test_variants_equal_brute_force(spark, seed, letters, n, tile):
    """A tile of 16 words cuts the common keys of few letters into many tiles."""
    counts = random_counts(seed, letters, n)
    assert variants(spark, counts, tile=tile) == brute_variants(counts)


def test_chains_and_ties(spark):
    counts = {"aaaaaaa": 200_000, "aaaaaab": 20_000, "aaaaabb": 2000, "aaaabbb": 200, "aaabbbb": 20, "aabbbbb": 2, "aaaaaac": 20_000,
              "xyzxyzx": 5, "listens": 9, "silents": 9, "aaaaaaaa": 20_000, "b" * 3000: 3, "b" * 3001: 30, "b" * 1500 + "c" + "b" * 1499: 2}
    got = variants(spark, counts)
    assert got == brute_variants(counts)
    assert got["aabbbbb"][1] == "aaaaaaa" and got["listens"][3] == 0
    assert got["aaaaabb"][0] == "aaaaaab" and got["xyzxyzx"] == (None, "xyzxyzx", 5, 0, None)


def test_one_edit_against_definition():
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(150)]
    words = sorted(set(words))
    a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    keep = np.array([len(words[x]) <= len(words[y]) and x != y for x, y in zip(a, b)])
    a, b = a[keep], b[keep]
    assert one_edit(Words(words), a, b).tolist() == [apart_by_one(words[x], words[y]) for x, y in zip(a, b)]


def test_counts_equal_plain_python(spark):
    prepare_texts(spark)
    rng = random.Random(7)
    pool = ["Straßenname", "naïveté", "ÀÉÎÕÜßÿ", "conversation", "ABCDEFGH", "abcdefgh", "short", "x×÷xxxxx", "Żółćabcdefg", "l" * 5000]
    rows = [(i if i else None, " -\n1".join(rng.choice(pool) for _ in range(rng.randrange(8))), None, None, None, None) for i in range(400)]
    rows += [(900, None, "w", 1, 2, "t"), (901, "", "w", 1, 2, "t"), rows[1], rows[1], (902, "conversation_conversation", None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    assert {r.word: r.n for r in word_counts(df, 7).collect()} == brute_counts(rows)
    assert {r.word: r.n for r in word_counts(df, 7, every=None).collect()} == brute_counts(rows, every=None)
    none = df.where("doc_id < 0")
    assert word_counts(none, 7).count() == 0 and spelling_variants(word_counts(none, 7)).count() == 0
