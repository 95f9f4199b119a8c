"""Documents to packed token sequences: quality, exact and near duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given. Its result is written
and read again before the next stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickframe import prepare
from tickframe.llm.exact_dedup import drop_exact_duplicates
from tickframe.llm.packing import pack_documents
from tickframe.llm.private_data import fit_private, redact
from tickframe.llm.quality import fit_quality, keep_good
from tickframe.llm.rows import may_learn, prepare_texts, stored
from tickframe.llm.text_dedup import drop_near_duplicates

ORACLE_SQL = None  # SQL has no word for fitted models and tokenizers


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored below 0.3. Null and empty texts are scored like others, repeated rows share
    their score, and an empty table stays empty; without labels every score is 0.5 and all stay."""
    prepare_texts(prepare(spark))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, fit_quality(docs, labels, may_learn("doc_id", 5, 0)), 0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null: empty) the row with the largest identifier stays, of rows given twice one. A
    null identifier never wins against a known one."""
    return drop_exact_duplicates(_ready(spark, docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the smallest identifier stays. Texts without
    words, and rows without an identifier, stay; rows given twice stay both."""
    return drop_near_duplicates(_ready(spark, docs), width=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes the name of its kind; null texts stay null, all rows stay.
    ``n_chars``, where there is one, is counted again."""
    clean = redact(_ready(spark, docs), fit_private(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of every document, repeated ones too; a null or empty text is its end id."""
    return pack_documents(_ready(spark, docs), vocabulary("byte_bpe_50k.json"), size=1024, end_id=2)


def _ready(spark: SparkSession, docs: DataFrame) -> DataFrame:
    prepare_texts(prepare(spark))
    return docs


STAGES = [
    ("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("private_data", private), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
