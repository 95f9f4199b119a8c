"""SentencePiece encoding and decoding through a table of distinct marked words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tickframe.llm.chunks import ChunkTable, marked_chunks
from tickframe.llm.piece_model import MARK, check_model, marked_texts, processor
from tickframe.llm.rows import map_texts
from tickframe.llm.spans import TextBatch, text_batches
from tickframe.llm.workers import worker_cache


@worker_cache(1)
def coding_table(path: str) -> ChunkTable:
    """Chunk -> (its ids, the ids as decimals, their decoded text with every marker a blank)."""
    check_model(path)
    sp = processor(path)
    mark = sp.piece_to_id(MARK)

    def work(chunks: list[str]) -> list[tuple]:
        coded = sp.encode([c[1:] for c in chunks], num_threads=1)  # the model adds the first marker
        coded = [ids if c != " " else [mark] for c, ids in zip(chunks, coded)]
        texts = sp.decode(coded, num_threads=1)
        return [
            (ids, " ".join(map(str, ids)).encode(), (" " + text).encode())
            for ids, text in zip(coded, texts)
        ]

    return ChunkTable(work)


def coded_texts(texts: list, table: ChunkTable):
    """For each text the coding-table entries of its chunks, in order."""
    for _, part in text_batches(texts):
        batch = TextBatch(marked_texts(part))
        if not len(batch.points):
            yield from ([] for _ in part)
            continue
        starts, ends = marked_chunks(batch)
        values, index = table.values(batch, starts, ends)
        bounds = np.searchsorted(starts, batch.bounds).tolist()
        index = index.tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield [values[k] for k in index[a:b]]


def encode_texts(docs: DataFrame, model_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``ids`` array<int>) per document: the library's encoding, then the end id.

    Null and empty texts give the end id alone.
    """

    def start():
        table = coding_table(model_path)
        return lambda texts: [pa.array(
            [[i for e in entries for i in e[0]] + [end_id] for entries in coded_texts(texts, table)],
            pa.list_(pa.int32()),
        )]

    return map_texts(docs, id_col, text_col, [T.StructField("ids", T.ArrayType(T.IntegerType()))], start)


def decode_ids(coded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ``text``) per row of ids, as the library decodes them; null ids give null."""

    def run(batches):
        sp = processor(model_path)
        for b in batches:
            texts = [None if ids is None else sp.decode(ids) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kept = coded.select(id_col, ids_col)
    schema = T.StructType([kept.schema[id_col], T.StructField("text", T.StringType())])
    return kept.mapInArrow(run, schema)


def coding_digests(docs: DataFrame, model_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``) per document, ids never leaving the task.

    The ids are those of ``encode_texts``; the digest is of their decimals joined by one blank,
    and of the UTF-8 bytes of the text decoded from them.
    """
    last = str(end_id).encode()

    def start():
        table = coding_table(model_path)

        def compute(texts: list):
            counts, ids, decoded = [], [], []
            for entries in coded_texts(texts, table):
                counts.append(sum([len(e[0]) for e in entries]) + 1)
                ids.append(hashlib.sha256(b" ".join([e[1] for e in entries] + [last])).hexdigest())
                decoded.append(hashlib.sha256(b"".join([e[2] for e in entries])[1:]).hexdigest())
            return [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

        return compute

    fields = [T.StructField("n_tokens", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256")]]
    return map_texts(docs, id_col, text_col, fields, start)
