"""Registered queries of the corpus operators and, where SQL can say them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession

from tickframe import prepare
from tickframe.llm import oracles
from tickframe.llm.bpe_coding import bpe_digests
from tickframe.llm.conversation_trie import prefix_trie, rebuilt, turn_lists
from tickframe.llm.embedding_dedup import near_vectors
from tickframe.llm.exact_dedup import exact_duplicates
from tickframe.llm.language import fit_language, languages
from tickframe.llm.language_model import fit_language_model, model_scores
from tickframe.llm.packing import pack_documents
from tickframe.llm.piece_coding import coding_digests
from tickframe.llm.private_data import fitted_spans
from tickframe.llm.quality import fit_quality, quality_scores
from tickframe.llm.rows import held_out, may_learn, prepare_texts
from tickframe.llm.spelling import spelling_variants
from tickframe.llm.text_dedup import near_duplicates
from tickframe.llm.token_counts import token_counts
from tickframe.llm.word_counts import word_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare_texts(prepare(spark)), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op9_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)""")
def op9_exact_dedup(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir))


@query("op5_piece_coding")
def op5_piece_coding(spark, sf_dir):
    return coding_digests(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query("op10_token_counts")
def op10_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), size=1024, end_id=2)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op1_quality")
def op1_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit_quality(docs, labels(spark, sf_dir), may_learn("doc_id", 5, 0))
    return quality_scores(docs, model, 0.3).withColumn("held_out", held_out("doc_id", 5, 0))


@query("op3_language")
def op3_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    net = fit_language(docs, may_learn("doc_id", 5, 0))
    return languages(docs, net).withColumn("held_out", held_out("doc_id", 5, 0))


@query("op8_private_data")
def op8_private_data(spark, sf_dir):
    return fitted_spans(documents(spark, sf_dir))


@query("op6_embedding_dedup")
def op6_embedding_dedup(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.98)


@query("op2_minhash_dedup")
def op2_minhash_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), width=3, percent=85)


@query("op7_lm_scoring")
def op7_lm_scoring(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit_language_model(docs, may_learn("doc_id", 7, 2))
    return model_scores(docs, model).withColumn("held_out", held_out("doc_id", 7, 2))


@query("op12_bpe_coding")
def op12_bpe_coding(spark, sf_dir):
    return bpe_digests(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query("op13_conversation_trie", oracles.CONVERSATION_TRIE)
def op13_conversation_trie(spark, sf_dir):
    return prefix_trie(rebuilt(turn_lists(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


@query("op11_spelling_variants", oracles.SPELLING_VARIANTS)
def op11_spelling_variants(spark, sf_dir):
    words = word_counts(documents(spark, sf_dir), least_length=7, every=31)
    return spelling_variants(words.where("n >= 2"), times=10)
