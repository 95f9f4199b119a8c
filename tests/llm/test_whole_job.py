"""Results that need the whole input: nothing seen once, rare, long or late may be left out."""

import math
import random
from collections import Counter, defaultdict

import pytest

from tickframe.llm import language_model, private_data
from tickframe.llm.language_model import fit_language_model, model_scores
from tickframe.llm.private_data import fit_private, proposed, training_spans
from tickframe.llm.rows import may_learn


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# n-grams --------------------------------------------------------------------------------------

def whole_scores(rows, train):
    """(score, tokens) by plain counts of all words, pairs and triples."""
    tokens = lambda t: [*(t or "").split(), None]
    counts = [Counter(), Counter(), Counter()]
    for _, t in train:
        x = tokens(t)
        counts[0].update((w,) for w in x)
        counts[1].update(zip([None, *x], x))
        counts[2].update(zip([None, *x], x, x[1:]))
    total, kinds = sum(counts[0].values()), len(counts[0])
    types = [defaultdict(int), defaultdict(int)]
    for k in (0, 1):
        for g in counts[k + 1]:
            types[k][g[:-1]] += 1

    def p(g):
        if len(g) == 1:
            return (counts[0][g] + 1) / (total + kinds + 1)
        seen, of = counts[len(g) - 2][g[:-1]], types[len(g) - 2][g[:-1]]
        return max(counts[len(g) - 1][g] - 0.75, 0) / seen + 0.75 * of / seen * p(g[1:]) if of else p(g[1:])

    out = []
    for _, t in rows:
        x = [None, *tokens(t)]
        out.append((sum(math.log10(p(tuple(x[max(0, i - 2) : i + 1]))) for i in range(1, len(x))), len(x) - 1))
    return out


@pytest.mark.parametrize("shards", [2, 16])
def test_language_model_keeps_all_pairs_and_triples(spark, monkeypatch, shards):
    monkeypatch.setattr(language_model, "LEAST_SHARDS", shards)
    rng = random.Random(shards)
    word = lambda: rng.choice(["the", "of", "a", "rare%d" % rng.randrange(300)])
    rows = [(i, " ".join(word() for _ in range(rng.randrange(40)))) for i in range(300)]
    rows += [(1000, None), (1001, "unseen words only the of"), (1002, "the " * 20_000)]
    docs = docs_of(spark, rows)
    learn = may_learn("doc_id", 7, 2)
    keep = {r[0] for r in docs.where(learn).select("doc_id").collect()}
    model = fit_language_model(docs, learn, least_count=1, order=3)
    got = {r.doc_id: r for r in model_scores(docs, model).collect()}
    for (i, _), (score, n) in zip(rows, whole_scores(rows, [r for r in rows if r[0] in keep])):
        assert got[i].score == pytest.approx(score, abs=1e-3 + 2e-4 * n)


# personal data --------------------------------------------------------------------------------

def test_a_rare_kind_has_a_threshold(spark, monkeypatch):
    monkeypatch.setattr(private_data, "SAMPLE_TEXTS", 200)
    rng = random.Random(1)
    number = lambda: "+1 (%d) 555-%d" % (rng.randrange(200, 999), rng.randrange(1000, 9999))
    rows = [(i, f"call {number()} now, a{i}@b.co, version {i} 2024-01-15") for i in range(4000)]
    rows += [(5000 + i, f"host 192.168.{100 + i}.7 is up") for i in range(15)]
    assert fit_private(docs_of(spark, rows)).thresholds[1] <= 1


def test_thresholds_come_from_all_texts(spark):
    trees = private_data.BoostedTrees(3.0)  # every span gets the same score
    rows = [(i, "a%d@b.co" % i) for i in range(6000)]
    pairs = lambda r: docs_of(spark, r).toDF("row_id", "row_text")
    assert private_data.calibrated(pairs(rows), trees)[0] <= 1
    assert private_data.calibrated(pairs(rows), trees)[1:] == (2.0, 2.0, 2.0)
    late = [(7000 + i, "192.168.100.%d" % i) for i in range(3)]  # one right to two wrong
    assert private_data.calibrated(pairs(rows + late), trees)[1] == 2.0


def test_proposals_of_unknown_truth_are_no_negatives():
    assert training_spans("call 499 555 6503 now") == []
    wrong = [(x[0], y) for x, y in training_spans("card 4111 1111 1111 1112, on 2024-01-15")]
    assert (2, 0) in wrong and (3, 0) in wrong and all(y == 0 for _, y in wrong)


def test_every_window_of_groups_is_proposed():
    found = lambda t: {t[a:b] for a, _, b in proposed(t)}
    assert {"555 123 4567", "555 123 4567 2024", "123 4567"} <= found("555 123 4567 2024")
    filler = "12 34 " * 100
    assert {"(499) 555-6503", "4111/1111/1111/1111"} <= found(f"{filler}(499) 555-6503 {filler}4111/1111/1111/1111 {filler}")
    t = "1 " * 100_000
    assert len(proposed(t)) <= 2 * 19 * 100_000
