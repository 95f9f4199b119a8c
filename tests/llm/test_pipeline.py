"""The corpus pipeline, stage by stage, on the small tables."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tickframe.llm.private_data import base_spans
from tickframe.llm.rows import stored


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
            assert docs.select("doc_id").distinct().count() == docs.count() <= before
            before = docs.count()
    kept = {r.doc_id: r.text for r in seen["exact_dedup"].collect()}
    assert len(set(kept.values())) == len(kept)
    clean = seen["private_data"].collect()
    assert not any(base_spans(r.text or "") for r in clean) and all(r.n_chars == len(r.text) for r in clean)
    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}
    assert max(sum(r.length for r in packed if r.sequence_id == s) for s in {r.sequence_id for r in packed}) <= 1024


def test_rejected_documents_are_junk(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    left = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, sf).collect()}
    good = [i for i, q in labels.items() if q == 1]
    junk = [i for i, q in labels.items() if q == 0]
    assert sum(i in left for i in good) >= 0.97 * len(good) and sum(i in left for i in junk) <= 0.3 * len(junk)


def test_run_returns_the_packed_pieces(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


@pytest.mark.parametrize("n", range(1, 14))
def test_every_operator_has_one_query(n):
    assert len([q for q in queries() if q.startswith(f"op{n}_")]) == 1
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("rows", [
    [],
    [(None, None, None, None, None, None)] * 2 + [(1, "", "en", "s", 0, 1), (2, "a b c d e f", None, None, None, 2), (3, "a b c d e f", "en", "s", 11, 3)],
])
def test_stages_take_odd_rows(spark, sf, rows):
    """No rows; null in every column; repeated rows; an extra column with a name used inside."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row_id long")
    ids = {r[0] for r in rows}
    for name, stage in corpus_pipeline.STAGES:
        got = stored(stage(spark, docs, sf), name)
        assert {r.doc_id for r in got.select("doc_id").collect()} <= ids
        if name == "exact_dedup":
            # the two equal texts leave the larger id; null and empty texts are one group
            assert sorted(r.doc_id for r in got.collect()) == [i for i in (1, 3) if i in ids]
        if name != "packing":
            assert got.columns == docs.columns


def test_filtering_stages_take_any_column_names(spark, sf):
    names = "doc_id long, text string, lang string, source string, `n.chars` long, _metadata int, c0 int, place_row int"
    docs = spark.createDataFrame([(1, "mail a@b.co", "en", "s", 1, 2, 3, 4), (2, None, None, None, None, None, None, None)], names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stored(stage(spark, docs, sf), name)
        assert got.columns == docs.columns and {r.doc_id for r in got.collect()} <= {1, 2}
        if name == "private_data":
            assert {r.text for r in got.collect()} == {"mail <EMAIL>", None}
