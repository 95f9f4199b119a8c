"""Windows of long runs of numbers, as a digit table has them, with their features as arrays.

A run consists of digits and the separators blank ( ) . - / alone. All windows of consecutive groups
of up to 19 digits are made for a block of groups at a time, so memory does not grow with the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MOST_DIGITS = 19
BLOCK_GROUPS = 1024
SEPARATORS = " -.(/"


class NumberRun:
    """``text[start:end]``, a run, with what sums up over it."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start = text, start
        run = text[start:end]
        self.codes = codes = np.frombuffer(run.encode("ascii"), np.uint8)
        digit = (codes >= 48) & (codes <= 57)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], digit, [False]))))
        self.begins, self.ends = edge[::2], edge[1::2]
        sums = lambda mask: np.concatenate(([0], np.cumsum(mask)))
        self.digits = sums(digit)
        self.marks = {c: sums(codes == ord(c)) for c in SEPARATORS + ")"}
        self.each = [sums(codes == 48 + d) for d in range(10)]
        d = (codes[digit] - 48).astype(np.int64)
        doubled = 2 * d - 9 * (2 * d > 9)
        even = np.arange(len(d)) % 2 == 0
        # check sums of digits, those at even or at odd places taken as they are
        self.plain = (sums(np.where(even, d, doubled)), sums(np.where(even, doubled, d)))
        sizes = self.ends - self.begins
        value = np.zeros(len(sizes), np.int64)
        for k in range(4):  # of groups of up to four digits; longer ones are large
            has = sizes > k
            value = np.where(has, 10 * value + codes[np.minimum(self.begins + k, len(codes) - 1)] - 48, value)
        self.sizes, self.values = sizes, np.where(sizes > 4, 9999, value)

    def windows(self) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]:
        """((start, kind, end) of proposals, in the text; their features by name), in blocks."""
        groups = len(self.begins)
        for at in range(0, groups, BLOCK_GROUPS):
            i = np.arange(at, min(at + BLOCK_GROUPS, groups))[:, None]
            j = i + np.arange(MOST_DIGITS)[None, :]
            inside = j < groups
            j = np.minimum(j, groups - 1)
            opening = (i > 0) & (self.codes[np.maximum(self.begins[i] - 1, 0)] == ord("("))
            a = np.where(i == 0, 0, self.begins[i] - opening) + np.zeros_like(j)
            b = self.ends[j]
            n = self.digits[b] - self.digits[a]
            inside &= n <= MOST_DIGITS
            dots = self.marks["."][b] - self.marks["."][a]
            longest = np.maximum.accumulate(self.sizes[j], axis=1)
            highest = np.maximum.accumulate(self.values[j], axis=1)
            for kind, mask in (
                (1, (n >= 4) & (n <= 12) & (dots == 3)), (2, n >= 13), (3, (n >= 7) & (n <= 15)),
            ):
                r, c = np.nonzero(mask & inside)
                if len(r):
                    yield self._features(kind, r + at, j[r, c], a[r, c], b[r, c], longest[r, c], highest[r, c])

    def _features(self, kind, i, j, a, b, longest, highest):
        count = {c: s[b] - s[a] for c, s in self.marks.items()}
        n = self.digits[b] - self.digits[a]
        first, last = self.digits[a], self.digits[b] - 1
        even = last % 2 == 0
        check = np.where(even, *(s[last + 1] - s[first] for s in self.plain))
        groups = j - i + 1
        size = b - a
        four = (groups == 4) & (size == n + 3) & (count["."] == 3) & (longest <= 3) & (highest <= 255)
        spans = np.stack([a + self.start, np.full(len(a), kind), b + self.start], axis=1)
        return spans, {
            "size": size, "digits": n, **count, "groups": groups, "first": self.sizes[i], "last": self.sizes[j], "longest": longest,
            "different": sum((s[b] > s[a]).astype(np.int64) for s in self.each),
            "plus": self.codes[a] == ord("+"), "opens": self.codes[a] == ord("("), "luhn": check % 10 == 0, "address": four,
        }
