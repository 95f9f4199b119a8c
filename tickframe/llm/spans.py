"""Vectorised work on batches of texts: code points, spans inside them, span hashes.

A batch is a list of Python strings laid end to end as one array of code points. Spans are
(start, end) positions in that array and never cross a text. Equal spans have equal 64-bit
hashes; different spans of one task collide with a probability below 1e-6 even for ten million
different spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BATCH_CHARS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, BATCH_CHARS + 1)
        for name, base in (("_powers", _BASE), ("_inverse_powers", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            globals()[name] = np.multiply.accumulate(table)
    return _powers[:n], _inverse_powers[:n]


def text_batches(texts: list, chars: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) runs of at most ``chars`` characters, or of one longer text.

    None counts as the empty text.
    """
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if held and size + len(t) > chars:
            yield at, held
            at, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield at, held


class TextBatch:
    """Code points of a list of texts; ``bounds`` holds the start of each text and the end."""

    def __init__(self, texts: list[str]):
        self.joined = "".join(texts)
        self.points = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        self.bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.bounds[1:])

    def first_of_text(self) -> np.ndarray:
        """A mask of the positions at which a text begins."""
        mask = np.zeros(len(self.points) + 1, bool)
        mask[self.bounds] = True
        return mask[:-1]

    def text_of(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, starts, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray, points: np.ndarray | None = None):
        points = self.points if points is None else points
        n = len(points)
        powers, inverse = _power_tables(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(points * powers[:n], out=sums[1:])  # modulo 2^64
        h = (sums[ends] - sums[starts]) * inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def is_word_point(points: np.ndarray) -> np.ndarray:
    """True outside blanks and the control characters 9 to 13."""
    return ~((points == 32) | ((points >= 9) & (points <= 13)))


def words(batch: TextBatch) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``."""
    inside = is_word_point(batch.points)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | batch.first_of_text()[1:]
    over = inside.copy()
    over[:-1] &= ~inside[1:] | batch.first_of_text()[1:]
    return np.flatnonzero(begins), np.flatnonzero(over) + 1


def lower_ascii(points: np.ndarray) -> np.ndarray:
    upper = (points >= 65) & (points <= 90)
    return points + upper * np.uint32(32)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and the number of words of each text."""
    batch = TextBatch(texts)
    starts, ends = words(batch)
    hashes = batch.hashes(starts, ends, lower_ascii(batch.points))
    counts = np.bincount(batch.text_of(starts), minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
    return hashes, counts
