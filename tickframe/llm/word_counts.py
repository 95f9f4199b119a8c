"""Counts of the words of all texts, with a rule that misspells some of them."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickframe.llm.rows import id_and_text

HELD_WORDS = 200_000  # different words a task holds before it hands them on
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def word_counts(docs: DataFrame, least_length: int, every: int | None = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the maximal runs of Latin letters, A-Z lower-cased, of at least ``least_length``.

    With ``every``, a run whose h, the unsigned crc32 of ``<id>:<run>``, it divides loses its code
    point h modulo its length; the length that counts is that of the result. Null texts have no
    words, a null identifier is empty text, and repeated rows count again.
    """
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = Counter(runs.findall(text.translate(LOWER)))
                if every:
                    seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word in [w for w in found if not zlib.crc32(w.encode(), seed) % every]:
                        n, cut = found.pop(word), zlib.crc32(word.encode(), seed) % len(word)
                        if len(word) > least_length:
                            held[word[:cut] + word[cut + 1 :]] += n
                held.update(found)
                if len(held) > HELD_WORDS:
                    yield out()
        if held:
            yield out()

    ids = id_and_text(docs, id_col, text_col).select(F.col("row_id").cast("string").alias("row_id"), "row_text")
    return ids.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
