"""Fitted operators: brute-force counts, held-out accuracy, defined results for odd rows."""

import hashlib
import math
import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickframe.llm.elias_fano import EliasFano, encode
from tickframe.llm.language import fit_language, languages
from tickframe.llm import language_model, private_data
from tickframe.llm.language_model import fit_language_model, model_scores
from tickframe.llm.private_data import (
    KINDS, all_spans, base_spans, fit_private, luhn, private_spans, redact, redacted, written,
)
from tickframe.llm.quality import fit_additive, fit_quality, keep_good, quality_scores
from tickframe.llm.rows import held_out, may_learn, prepare_texts
from tickframe.llm.spans import text_batches

DOCS = "doc_id long, text string, lang string, label int, row_id long, score string"


@pytest.fixture(scope="module")
def tables(spark, sf):
    prepare_texts(spark)
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, 1, 2, "s") for i, t in rows], DOCS)


ODD = [(1, None), (2, ""), (3, " \n"), (4, "1234 5678"), (None, "und so weiter"), (6, "wort " * 30_000), (6, "wort")]


# quality --------------------------------------------------------------------------------------

def test_additive_model_learns_tables_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # no single feature tells
    p = fit_additive(x, y).score(x)
    assert ((p > 0.5) == y).mean() > 0.9 and 0 <= p.min() <= p.max() <= 1
    assert fit_additive(np.zeros((0, 3)), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    model = fit_quality(docs, labels, may_learn("doc_id", 5, 0))
    got = quality_scores(docs, model).withColumn("held_out", held_out("doc_id", 5, 0)).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
    odd = docs_of(spark, ODD)
    rows = quality_scores(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert keep_good(odd, model).columns == odd.columns
    assert quality_scores(docs_of(spark, []), model).count() == 0


def test_quality_without_labels(spark, tables):
    docs, labels = tables
    model = fit_quality(docs, labels.where("quality > 1"))
    assert {r.score for r in quality_scores(docs, model).collect()} == {0.5}


# language -------------------------------------------------------------------------------------

def test_language_on_held_out_rows(spark, tables):
    docs, _ = tables
    net = fit_language(docs, may_learn("doc_id", 5, 0))
    got = languages(docs, net).join(docs.select("doc_id", "lang"), "doc_id").withColumn("h", held_out("doc_id", 5, 0)).collect()
    assert np.mean([r.lang_pred == r.lang for r in got if r.h]) > 0.9
    rows = {(r.doc_id, r.lang_pred) for r in languages(docs_of(spark, ODD), net).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und")} <= rows and (None, "und") not in rows
    assert languages(docs_of(spark, []), net).count() == 0


def test_language_without_labels(spark, tables):
    net = fit_language(docs_of(spark, ODD))
    assert {(r.lang_pred, r.score) for r in languages(docs_of(spark, ODD), net).collect()} == {("und", 0.0)}


# n-grams --------------------------------------------------------------------------------------

@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 5), (900, 40), (900, 10**6), (2000, 10**12), (64, 65)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    coded = EliasFano(encode(values, "x"), "x")
    assert (coded.access(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, top + 3, 500)])
    assert (coded.successor(asked) == np.searchsorted(values, asked)).all()


def tokens_of(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute_scores(rows, train):
    words, pairs = Counter(), Counter()
    for i, t in train:
        x = tokens_of(t)
        words.update(x)
        pairs.update(zip([None] + x, x))
    n, v = sum(words.values()), len(words)
    pairs = {k: c for k, c in pairs.items() if c >= 2}
    left = defaultdict(lambda: 1.0)
    for (a, _), c in pairs.items():
        left[a] -= (c - 0.75) / words[a]
    out = []
    for _, t in rows:
        x = tokens_of(t)
        single = [(words[w] + 1) / (n + v + 1) for w in x]
        p = [((pairs[a, w] - 0.75) / words[a] if (a, w) in pairs else 0) + left[a] * s for a, w, s in zip([None] + x, x, single)]
        out.append((len(x), sum(words[w] > 0 for w in x), n, sum(map(math.log10, single)), sum(map(math.log10, p))))
    return out


@pytest.mark.parametrize("shards", [2, 16])
def test_language_model_equals_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(language_model, "LEAST_SHARDS", shards)
    rng = random.Random(shards)
    texts = [" ".join(rng.choice(["the", "The", "of", "a\tb", "rare%d" % rng.randrange(300)]) for _ in range(rng.randrange(40))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1000, None), (1001, " "), (1002, "unseen words only"), (1003, "the " * 20_000)]
    docs = docs_of(spark, rows)
    learn = may_learn("doc_id", 7, 2)
    keep = {r[0] for r in docs.where(learn).select("doc_id").collect()}
    got = {r.doc_id: r for r in model_scores(docs, fit_language_model(docs, learn, least_count=2, order=2)).collect()}
    for (i, _), (n, known, total, base, score) in zip(rows, brute_scores(rows, [r for r in rows if r[0] in keep])):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, abs=1e-3 + 2e-4 * n)


def test_language_model_without_training_rows(spark):
    docs = docs_of(spark, [(1, "a b"), (2, None)])
    got = sorted(map(tuple, model_scores(docs, fit_language_model(docs.where("doc_id < 0"))).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score").collect()))
    assert got == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]


def test_shards_are_asked_once_for_many_texts(spark, monkeypatch):
    """Every look-up in a shard has a fixed cost, and their number grows with (texts times shards)."""
    asked = Counter()
    of = language_model.Level.file
    monkeypatch.setattr(language_model.Level, "file", lambda self, k: asked.update([(self.name, k)]) or of(self, k))
    texts = ["the of the rare%d of a " % k * 200 for k in range(1500)]  # 6 million characters
    model = fit_language_model(docs_of(spark, list(enumerate(texts[:300]))))
    rows = [model.score(part) for _, part in text_batches(texts, language_model.BATCH_CHARS)]
    assert {name for name, _ in asked} == {"pairs", "triples"} and set(asked.values()) == {1}
    got = [np.concatenate(x) for x in zip(*rows)]
    alone = [np.concatenate(x) for x in zip(*(model.score([t]) for t in texts[::100]))]
    assert all(x[::100].tolist() == pytest.approx(y.tolist()) for x, y in zip(got, alone))


def test_the_text_gives_the_number_of_shards(spark, monkeypatch):
    monkeypatch.setattr(language_model, "LEAST_SHARDS", 2)
    monkeypatch.setattr(language_model, "SHARD_CHARS", 100)
    rows = [(k, "word%d and so on " % k) for k in range(10)]  # of 16 characters
    assert len(fit_language_model(docs_of(spark, rows * 3)).words.starts) == 5  # not the next power of two


def test_tokens_do_not_depend_on_what_is_hashed_together(monkeypatch):
    texts = ["", "The end", "a" * 50, " ", "the\tEnd a", "x"]
    whole = language_model.token_hashes(texts)
    monkeypatch.setattr(language_model, "HASHED_CHARS", 8, raising=False)
    assert [x.tolist() for x in language_model.token_hashes(texts)] == [x.tolist() for x in whole]
    assert [len(x) for x in language_model.token_hashes([])] == [0, 0]


# personal data --------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return sorted(out + [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m[0])) <= 15])


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for k in range(20_000):
        letters = ["ab@.-+% ", "0123456789 -.", "+0123(). -4", "a1@.b-@"][k % 4]
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert base_spans(t) == brute_spans(t)
    t = "é 4111 1111 1111 1111 a@b.co 1.2.3.4 +1 (499) 555-6503"
    assert written(base_spans(t)) == "card:2:21,email:22:28,ip:29:36,phone:37:54"


def test_long_texts_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1 " * 100_000, "1." * 100_000, "+" + " " * 300_000):
        base_spans(t)


def test_windows_of_long_runs_equal_single_spans():
    """Proposals, features and checks of digit tables, worked out as arrays, span by span."""
    rng = random.Random(1)
    for k in range(40):
        letters = ["0123456789 ", "0123456789 .-/()", "01. ", "12/-.9 ", "+1() 23"][k % 5]
        t = rng.choice(["", "call tel ", "version ", "card: ", "ip #"]) + "".join(rng.choice(letters) for _ in range(rng.randrange(150, 700)))
        t += rng.choice(["", " end", ".", "é"])
        base = base_spans(t)
        got = {tuple(s): (x, w) for part in private_data.proposals(t, base) for s, x, w in zip(*(v.tolist() for v in part))}
        want = private_data._clear_of(private_data.proposed(t), base)
        assert set(got) == set(want)
        for s in want:
            assert got[s] == ([float(v) for v in private_data.span_features(t, *s)], bool(private_data.surely_wrong(t, *s)))


def test_added_spans_equal_brute_force(tables):
    """Every proposal scored by itself, then taken greedily: by score, length and place."""
    model = fit_private(tables[0])
    texts = ["call (499) 555-6503 or 4111.1111.1111.1111 now", "1 2 3 " * 60 + "499 555 6503 " * 9, "x (at) y.com 12", "card 4111/1111/1111/1111, tel 499 555 65 03"]
    for t in texts:
        base = base_spans(t)
        ranked = []
        for s in private_data._clear_of(private_data.proposed(t), base):
            q = model.trees.score(np.array([private_data.span_features(t, *s)], float))[0]
            if not private_data.surely_wrong(t, *s) and q >= model.thresholds[s[1]]:
                ranked.append((-q, s[0] - s[2], s))
        chosen = []
        for _, _, s in sorted(ranked):
            if all(s[2] <= c[0] or c[2] <= s[0] for c in chosen):
                chosen.append(s)
        assert all_spans(t, model) == (base, sorted({*base, *chosen}))


def test_digit_tables_take_bounded_time_and_memory(tables):
    model = fit_private(tables[0])
    rng = random.Random(2)
    t = "".join(rng.choice("0123456789") + " " for _ in range(500_000))  # 1 MB
    began = time.process_time()
    assert sum(len(x) for x, _ in private_data.training_blocks(t)) > 1_000_000
    all_spans(t, model)
    assert time.process_time() - began < 60  # 280 s when windows were worked out one by one
    tracemalloc.start()
    sum(len(x) for x, _ in private_data.training_blocks(t[:20_000]))
    all_spans(t[:20_000], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_private_spans_keep_the_base_and_add(spark, tables):
    docs, _ = tables
    model = fit_private(docs)
    got = {r.doc_id: r for r in private_spans(docs, model).collect()}
    for r in docs.collect():
        base = brute_spans(r.text or "")
        g = got[r.doc_id]
        assert [g[f"n_{k}"] for k in KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert g.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert set(written(base).split(",")) <= set(g.spans.split(",")) or not base
    for r in private_spans(docs_of(spark, ODD), model).collect():
        assert r.n_email == 0 and (r.spans == "" or r.doc_id == 4)
    assert private_spans(docs_of(spark, []), model).count() == 0


def test_patterns_search_only_numeric_parts():
    rng = random.Random(8)
    patterns = [private_data.IP, private_data.CARD, private_data.PHONE, private_data.NUMBER]
    for k in range(20_000):
        letters = ["0123456789 .-/()+", "01a. +(", "+1() 23-x@", "12/-.9 é("][k % 4]
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        parts = private_data.numeric_parts(t)
        for p in patterns:
            assert [m.span() for m in private_data.matches(p, t, parts)] == [m.span() for m in p.finditer(t)]


def test_texts_left_out_hold_nothing():
    rng = random.Random(9)
    for k in range(20_000):
        letters = ["ab(at)[AT]. ", "a@.b ", "12 .", "ab {at} .c"][k % 4]
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        if not re.search(private_data.MAY_HOLD, t):
            assert not base_spans(t) and not private_data.proposed(t)
    assert private_data.proposed("joe [at] example [dot] com") and re.search(private_data.MAY_HOLD, "joe [at] example [dot] com")


def test_the_texts_are_read_once(spark, tables):
    """Sampling, training, thresholds and spans; before, each pattern and step read all texts again."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = tables[0].select("doc_id", "text").mapInArrow(counted, "doc_id long, text string")
    rows = tables[0].count()
    fit_private(docs)
    assert read.value == rows
    private_data.fitted_spans(docs).collect()
    assert read.value == 2 * rows


def test_spans_of_one_reading_equal_those_of_the_model(spark, tables):
    rng = random.Random(4)
    odd = [*ODD, (8, "1 2 3 " * 90 + "4111 1111 1111 1111"), (9, "joe (at) x.com or joe [at] x [dot] org"), (9, "call (499) 555-6503, 4111.1111.1111.1111")]
    odd += [(100 + k, "".join(rng.choice("0123456789 .-/()+@a") for _ in range(rng.randrange(600)))) for k in range(60)]
    docs = tables[0].select("doc_id", "text").union(docs_of(spark, odd).select("doc_id", "text"))
    got = private_data.fitted_spans(docs)
    want = private_spans(docs, fit_private(docs))
    assert got.schema == want.schema
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    added = [r for r in got.collect() if r.spans.count(":") // 2 > r.n_email + r.n_ip + r.n_card + r.n_phone]
    assert added  # some are found beyond the base spans
    nothing = private_data.fitted_spans(docs_of(spark, []))
    assert nothing.collect() == [] and nothing.columns == want.columns


def test_no_texts_with_data_add_nothing(spark):
    model = fit_private(docs_of(spark, [(1, "plain words"), (2, None)]))
    assert all_spans("(499) 555-6503", model) == ([], [])


def test_redaction(spark, tables):
    assert redacted("x a@b.co y", [(2, 0, 8)]) == "x <EMAIL> y"
    assert redacted("0123456789", [(1, 2, 5), (3, 3, 7)]) == "0<CARD>789"
    docs = docs_of(spark, [(1, "ip 10.0.0.1."), (2, None)])
    got = redact(docs, fit_private(tables[0]))
    assert got.columns == docs.columns
    assert [(r.doc_id, r.text) for r in got.orderBy("doc_id").collect()] == [(1, "ip <IP>."), (2, None)]
