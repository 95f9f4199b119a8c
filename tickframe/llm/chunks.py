"""Tables of distinct chunks: what a chunk of text becomes is worked out once per task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tickframe.llm.spans import TextBatch

GENERATION = 200_000


class ChunkTable:
    """Chunk hash -> value, in two generations of at most GENERATION entries each.

    A full young generation becomes the old one; entries that are used again move up. Frequent
    chunks therefore stay, memory is bounded, and a forgotten chunk is simply worked out again.
    """

    def __init__(self, work: Callable[[list[str]], list], size: int = GENERATION):
        self.work, self.size = work, size
        self.young: dict[int, object] = {}
        self.old: dict[int, object] = {}

    def values(self, batch: TextBatch, starts: np.ndarray, ends: np.ndarray, points=None):
        """(values of the distinct chunks, index of each chunk's value)."""
        hashes = batch.hashes(starts, ends, points)
        distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
        young, old, text = self.young, self.old, batch.joined
        values, new = [None] * len(distinct), []
        for k, h in enumerate(distinct.tolist()):
            v = young.get(h)
            if v is None:
                v = old.get(h)
                if v is None:
                    new.append(k)
                    continue
                young[h] = v
            values[k] = v
        if new:
            at = first[new]
            spans = zip(starts[at].tolist(), ends[at].tolist())
            for k, v in zip(new, self.work([text[a:b] for a, b in spans])):
                values[k] = young[int(distinct[k])] = v
        if len(young) > self.size:
            self.old, self.young = young, {}
        return values, index.reshape(-1)


def marked_chunks(batch: TextBatch) -> tuple[np.ndarray, np.ndarray]:
    """Chunks that begin with a run of blanks: a boundary is a blank after a non-blank.

    Texts come with one blank put before each non-empty one.
    """
    blank = batch.points == 32
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins |= batch.first_of_text()
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(batch.points))
