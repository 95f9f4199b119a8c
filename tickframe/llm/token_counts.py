"""Token counts by byte-pair merging with a heap and a linked list; no token is written out."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from tickframe.llm.chunks import ChunkTable, marked_chunks
from tickframe.llm.piece_model import MARK, check_model, marked_texts, piece_ranks
from tickframe.llm.rows import map_texts
from tickframe.llm.spans import TextBatch, text_batches
from tickframe.llm.workers import worker_cache


def merged_count(text: str, ranks: dict[str, int]) -> int:
    """Tokens left when the lowest-ranked adjacent pair (leftmost first) is merged until none is.

    ``after`` links a symbol's start to the next symbol's, ``before`` back to the previous one.
    A symbol's text is fixed by its start and end, so a popped pair is stale exactly when its
    first symbol is gone or the pair no longer ends where it did. A character that is no piece
    in the end counts as its UTF-8 bytes.
    """
    n = len(text)
    rank = ranks.get
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(text[i : i + 2])) is not None]
    heapify(heap)
    left = n
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if not j or j >= n or after[j] != end:
            continue
        after[i], after[j] = end, 0
        left -= 1
        if end < n:
            before[end] = i
            if (r := rank(text[i : after[end]])) is not None:
                heappush(heap, (r, i, after[end]))
        h = before[i]
        if h >= 0 and (r := rank(text[h:end])) is not None:
            heappush(heap, (r, h, end))
    if left > 1 or n == 1:
        left += sum(len(c.encode()) - 1 for i, c in enumerate(text) if after[i] == i + 1 and c not in ranks)
    return left


@worker_cache(1)
def count_table(path: str) -> ChunkTable:
    check_model(path)
    ranks = piece_ranks(path)
    return ChunkTable(lambda chunks: [merged_count(c.replace(" ", MARK), ranks) for c in chunks], 600_000)


def token_counts(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows give repeated results. Each
    different marked word is merged once per task and counted at every place.
    """

    def start():
        table = count_table(model_path)

        def compute(texts: list):
            counts = np.zeros(len(texts), np.int64)
            for at, part in text_batches(texts):
                batch = TextBatch(marked_texts(part))
                if len(batch.points):
                    starts, ends = marked_chunks(batch)
                    values, index = table.values(batch, starts, ends)
                    sums = np.bincount(batch.text_of(starts), np.array(values)[index], len(part))
                    counts[at : at + len(part)] = sums.astype(np.int64)
            return [np.array([len(t.encode()) if t else 0 for t in texts], np.int64), counts]

        return compute

    long = T.LongType()
    counted = map_texts(docs, id_col, text_col, [T.StructField("n_bytes", long), T.StructField("n_tokens", long)], start)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
