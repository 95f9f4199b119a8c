"""Byte-level BPE encoding and decoding by the tokenization automaton."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tickframe.llm.byte_model import COVERED, byte_letters, pretokens, tokenizer
from tickframe.llm.chunks import ChunkTable
from tickframe.llm.merge_automaton import arc_labels, automaton, label_bytes
from tickframe.llm.rows import map_texts
from tickframe.llm.spans import TextBatch, text_batches
from tickframe.llm.workers import worker_cache


@worker_cache(1)
def word_table(path: str) -> ChunkTable:
    """Pre-split word -> (its numbers, its arc labels)."""
    encode = automaton(path).encode
    return ChunkTable(lambda words: [encode(w.encode()) for w in words])


@worker_cache(1)
def special_pieces(path: str) -> tuple[re.Pattern | None, dict[str, tuple[bytes, bytes]]]:
    """A pattern of the added tokens, and what each one becomes. Others than exact texts fail."""
    t, _ = tokenizer(path)
    letters, out = byte_letters(), {}
    for number, a in t.get_added_tokens_decoder().items():
        if a.single_word or a.lstrip or a.rstrip:
            raise ValueError("added tokens must be exact texts")
        out[a.content] = (np.array([number], "<u4").tobytes(), label_bytes(a.content, letters))
    longest = sorted(out, key=len, reverse=True)
    return (re.compile("|".join(map(re.escape, longest))) if out else None), out


def coded_texts(texts: list, path: str):
    """For each text its entries (numbers, labels), in order. None is the empty text."""
    pattern, special = special_pieces(path)
    table, split = word_table(path), tokenizer(path)[0].pre_tokenizer.pre_tokenize_str
    letters = byte_letters()

    def by_library(text: str) -> list:
        """Entries of a text with code points whose classes the table of pre-splits lacks."""
        parts = [bytes(letters[c] for c in p).decode() for p, _ in split(text)]
        batch = TextBatch(parts)
        values, index = table.values(batch, batch.bounds[:-1], batch.bounds[1:])
        return [values[k] for k in index.tolist()]

    def one(text: str) -> list:
        """Entries of a text that cannot go with its batch: cut at added tokens, then pre-split."""
        out, at = [], 0
        for m in pattern.finditer(text) if pattern else ():
            if m.start() > at:
                out += by_library(text[at : m.start()])
            out.append(special[m.group()])
            at = m.end()
        return out + (by_library(text[at:]) if at < len(text) else [])

    for _, part in text_batches(texts):
        batch = TextBatch(part)
        alone = [False] * len(part)
        if len(batch.points) and (batch.points.max() >= COVERED or pattern and pattern.search(batch.joined)):
            alone = [bool(not x.isascii() and max(x) >= chr(COVERED) or pattern and pattern.search(x)) for x in part]
            batch = TextBatch(["" if w else x for w, x in zip(alone, part)])
        rows = [[] for _ in part]
        if len(batch.points):
            starts, ends = pretokens(batch)
            values, index = table.values(batch, starts, ends)
            bounds = np.searchsorted(starts, batch.bounds).tolist()
            index = index.tolist()
            rows = [[values[k] for k in index[a:b]] for a, b in zip(bounds, bounds[1:])]
        for k, w in enumerate(alone):
            yield one(part[k]) if w else rows[k]


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``ids`` array<int>) per document, as the tokenizer encodes it without added ids.

    Null and empty texts give an empty list, repeated rows repeated results; other columns are not
    read. The text of an added token becomes that token.
    """

    def start():
        def compute(texts: list):
            ids = [np.frombuffer(b"".join([e[0] for e in entries]), "<u4") for entries in coded_texts(texts, tokenizer_path)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

        return compute

    return map_texts(docs, id_col, text_col, [T.StructField("ids", T.ArrayType(T.IntegerType()))], start)


def bpe_decode(coded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ``text``) per row of ids: the labels of their arcs, joined and read as UTF-8.

    Bytes that are no UTF-8 become replacement characters, ids that no token has give nothing, and
    null ids give null.
    """

    def run(batches):
        labels = arc_labels(tokenizer_path)
        for b in batches:
            texts = [
                None if ids is None else b"".join([labels.get(i, b"") for i in ids]).decode("utf-8", "replace")
                for ids in b.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kept = coded.select(id_col, ids_col)
    schema = T.StructType([kept.schema[id_col], T.StructField("text", T.StringType())])
    return kept.mapInArrow(run, schema)


def bpe_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``) per document, ids never leaving the task.

    The digests are of the ids as little-endian unsigned 32-bit numbers, and of the UTF-8 bytes of
    the text decoded from them. Null and empty texts have no tokens and two digests of nothing.
    """

    def start():
        def compute(texts: list):
            counts, ids, decoded = [], [], []
            for entries in coded_texts(texts, tokenizer_path):
                numbers = b"".join([e[0] for e in entries])
                text = b"".join([e[1] for e in entries]).decode("utf-8", "replace")
                counts.append(len(numbers) // 4)
                ids.append(hashlib.sha256(numbers).hexdigest())
                decoded.append(hashlib.sha256(text.encode()).hexdigest())
            return [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

        return compute

    fields = [T.StructField("n_tokens", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256")]]
    return map_texts(docs, id_col, text_col, fields, start)
