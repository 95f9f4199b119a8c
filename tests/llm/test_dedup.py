"""Duplicate operators against brute force, with hot groups, odd rows and empty tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import embedding_dedup, exact_dedup, text_dedup
from tickframe.llm.components import components
from tickframe.llm.embedding_dedup import near_vectors
from tickframe.llm.exact_dedup import digest_groups, drop_exact_duplicates, exact_duplicates
from tickframe.llm.rows import prepare_texts
from tickframe.llm.text_dedup import drop_near_duplicates, near_duplicates, shingle_sets

DOCS = "doc_id long, text string, lang string, row_id long, row_text string, n long, key string"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare_texts(spark)


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, 7, "x", 1, "k") for i, t in rows], DOCS)


def closure(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


# exact ----------------------------------------------------------------------------------------

def test_exact_groups_nulls_ties_and_repeats(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (6, "A"), (None, "c"), (7, "c")]
    rows += [(100 + i, "hot " * 5000) for i in range(300)]
    got = exact_duplicates(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        want.setdefault(t or "", []).append(i)
    for r, (i, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(rows, key=lambda r: (r[0] is None, r[0]))):
        group = want[t or ""]
        top = max(x for x in group if x is not None)
        assert (r.keep_id, r.group_size, r.kept) == (top, len(group), i == top)
        assert r.text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_exact_smallest_and_empty_table(spark):
    got = exact_duplicates(docs_of(spark, [(9, "a"), (4, "a"), (None, "a")]), keep="smallest").collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(9, 4), (4, 4), (None, 4)}
    assert exact_duplicates(docs_of(spark, [])).count() == 0


def test_more_rounds_give_the_same_groups(spark, monkeypatch):
    rows = [(i, hashlib.sha256(str(i % 700).encode()).digest()) for i in range(4000)]
    df = spark.createDataFrame(rows, "row_id long, digest binary").repartition(9)
    few = {tuple(r) for r in digest_groups(df, True, 4000).collect()}
    monkeypatch.setattr(exact_dedup, "BUCKET_ROWS", 10)
    many = {tuple(r) for r in digest_groups(df, True, 4000).collect()}
    assert few == many and len(few) == 700 and sum(r[2] for r in few) == 4000


def test_exact_stage_keeps_one_row_of_each_text(spark):
    rows = [(1, "a"), (2, "a"), (3, "b"), (3, "b"), (4, None), (5, "")]
    got = drop_exact_duplicates(docs_of(spark, rows))
    assert got.columns == docs_of(spark, []).columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(2, "a"), (3, "b"), (5, "")]


# near texts -----------------------------------------------------------------------------------

def words_of(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute_sets(texts, width):
    out = []
    for t in texts:
        w = words_of(t)
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
    return out


def brute_near(rows, width, percent):
    sets = brute_sets([t for _, t in rows], width)
    links = [
        (rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return sets, closure([i for i, _ in rows], links)


def varied(base, rng, changes):
    w = list(base)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.random():.6f}"
    return " ".join(w)


def test_shingles_equal_brute_force():
    texts = ["", None, " \n", "One", "one two", "ONE two\tTHREE", "a b c a b c", "ä Ä ä", "a" * 5000, "b\x0bc\x1cd e"]
    sets = shingle_sets(texts, 3)
    assert [len(s) for s in sets] == [len(s) for s in brute_sets(texts, 3)]
    again = shingle_sets(["one TWO three"], 3)
    assert (again[0] == sets[5]).all()


def corpus(seed, copies):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [varied(base, rng, rng.randrange(7)) for _ in range(copies)]
    texts += [passage + " " + " ".join(f"q{rng.random():.6f}" for _ in range(rng.randrange(5, 60))) for _ in range(80)]
    for n in (4, 20, 70, 75, 200, 900):
        one = [f"r{rng.random():.4f}" for _ in range(n)]
        texts += [varied(one, rng, k * n // 60) for k in range(5)]
    texts += ["same words here now", "same words here now", "Same words HERE now", "x", "x", "", None, " ", "y z", "y z"]
    rng.shuffle(texts)
    return list(enumerate(texts, 10))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_texts_equal_brute_force(spark, width, percent):
    rows = corpus(width, 150)
    sets, component = brute_near(rows, width, percent)
    got = {r.doc_id: r for r in near_duplicates(docs_of(spark, rows), width, percent).collect()}
    assert len(got) == len(rows)
    for (i, _), s in zip(rows, sets):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), component[i], component[i] == i)


def test_long_lists_are_compared_exactly(spark, monkeypatch):
    monkeypatch.setattr(text_dedup, "LIST_PAIRS", 3)
    monkeypatch.setattr(text_dedup, "TILE_ROWS", 8)
    monkeypatch.setattr(text_dedup, "TILE_COLUMNS", 16)
    rows = corpus(11, 90)
    _, component = brute_near(rows, 3, 85)
    got = near_duplicates(docs_of(spark, rows), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == component


def test_near_texts_odd_rows(spark):
    assert near_duplicates(docs_of(spark, [])).count() == 0
    rows = [(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "only me here"), (3, None)]
    got = sorted(near_duplicates(docs_of(spark, rows)).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [
        (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True), (None, None, True),
    ]
    left = drop_near_duplicates(docs_of(spark, [(5, "a b c d e f"), (6, "a b c d e f"), (7, None)]))
    assert sorted(r.doc_id for r in left.collect()) == [5, 7]


CLASHING = "doc_id long, text string, _id long, _hit int, _sha string, _digest binary, place_file string, place_row long, `doc.id` int"


@pytest.mark.parametrize("drop", [drop_near_duplicates, drop_exact_duplicates])
def test_dropping_with_clashing_names_and_stored_rows(spark, tmp_path, drop):
    texts = ["a b c d e f", "a b c d e f", "g h i j k l", None, None, "a b c d e f"]
    df = spark.createDataFrame([(i, t, 1, 2, "s", b"d", "f", 3, 4) for i, t in enumerate(texts)], CLASHING)
    df.repartition(3).write.parquet(str(tmp_path / "docs"))
    for docs in (df, spark.read.parquet(str(tmp_path / "docs"))):
        got = drop(docs)
        assert got.columns == df.columns
        kept = {r.doc_id for r in got.collect()}
        assert kept == ({0, 2, 3, 4} if drop is drop_near_duplicates else {2, 4, 5})
        assert drop(docs.where("doc_id < 0")).count() == 0
    with pytest.raises(TypeError, match="whole number"):
        drop(df.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_rows_that_share_an_identifier_are_judged_one_by_one(spark):
    x, y, z = "a b c d e f", "g h i j k l", "a b c d e f g"
    rows = [(5, x), (6, x), (6, y), (6, y), (7, z), (5, None), (None, x)]
    left = drop_near_duplicates(docs_of(spark, rows), width=5, percent=50).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, x), (5, ""), (5, x), (6, y), (6, y)]
    got = near_duplicates(docs_of(spark, [(1, x), (1, y), (2, z), (3, y)]), 5, 50).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]
    exact = drop_exact_duplicates(docs_of(spark, [(5, x), (6, x), (5, y), (5, y)])).collect()
    assert sorted((r.doc_id, r.text) for r in exact) == [(5, y), (6, x)]


# vectors --------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, rep long, size int, key string"


def brute_vectors(rows, cosine):
    links = []
    ok = []
    for i, v, label in rows:
        x = None if v is None or None in v or not v else np.array(v, np.float32).astype(float)
        ok.append(None if label is None or x is None or not np.isfinite(x).all() or not x.any() else x)
    for a in range(len(rows)):
        for b in range(a):
            x, y = ok[a], ok[b]
            if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links.append((a, b))
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return count, closure([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])


@pytest.mark.parametrize("homes", [1024, 6])
def test_vectors_equal_brute_force(spark, monkeypatch, homes):
    monkeypatch.setattr(embedding_dedup, "CELL_HOMES", homes)
    rng = np.random.default_rng(homes)
    made = []
    for label in (1, 2, None):
        centre = rng.normal(size=20)
        made += [((centre + rng.normal(size=20) * s).tolist(), label) for s in rng.uniform(0.05, 0.3, 40)]
        made += [(rng.normal(size=20).tolist(), label) for _ in range(20)]
        made += [(centre.tolist(), label)] * 5 + [((centre * 3).tolist(), label)]
    made += [(v, 1) for v in (None, [], [0.0] * 20, [1.0] * 19 + [None], [1.0] * 19 + [float("nan")], [float("inf")] * 20, [1.0, 2.0])]
    rows = [(i, v, label) for i, (v, label) in enumerate(made)]
    count, component = brute_vectors(rows, 0.98)
    df = spark.createDataFrame([(i, v, lab, 1, 2, "k") for i, v, lab in rows], VECTORS)
    got = {r.vec_id: r for r in near_vectors(df, 0.98).collect()}
    for (i, _, _), n in zip(rows, count):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, component[i], component[i] == i)


def test_vectors_that_share_an_identifier(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    near_a, near_b = [1.0, 0.01, 0.0, 0.0], [0.01, 1.0, 0.0, 0.0]
    rows = [(1, a), (1, b), (2, near_a), (3, near_b), (4, [0.0, 0.0, 1.0, 0.0])]
    got = near_vectors(spark.createDataFrame([(i, v, 1, 1, 2, "k") for i, v in rows], VECTORS), 0.98).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4)]
    with pytest.raises(TypeError, match="whole number"):
        near_vectors(spark.createDataFrame([("x", a, 1, 1, 2, "k")], VECTORS.replace("vec_id long", "vec_id string")))


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


# components -----------------------------------------------------------------------------------

def test_components_of_paths_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(1000, k) for k in range(1001, 1300)] + [(70, 71), (71, 72), (72, 70), (80, 80)]
    rng = random.Random(1)
    links = [p if rng.random() < 0.5 else p[::-1] for p in links]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()))
    want = closure({x for p in links for x in p}, links)
    assert got == {k: v for k, v in want.items() if k != 80} or got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
