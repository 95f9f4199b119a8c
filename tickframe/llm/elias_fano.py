"""Elias-Fano coding of monotone sequences, with vectorised access and successor search."""

from __future__ import annotations

import numpy as np

_BITS = np.uint64(64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``values`` as consecutive fields of ``width`` bits in 64-bit words."""
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.int64) * width
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(out, word, values << bit)
        over = bit + np.uint64(width) > _BITS
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (_BITS - bit[over]))
    return out


def _unpack(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.uint64)
    at = index * width
    word, bit = at >> 6, (at & 63).astype(np.uint64)
    out = words[word] >> bit
    over = np.flatnonzero(bit > np.uint64(64 - width))
    out[over] |= words[word[over] + 1] << (_BITS - bit[over])
    out &= np.uint64((1 << width) - 1)
    return out


def encode(values: np.ndarray, prefix: str) -> dict[str, np.ndarray]:
    """Arrays (under names with ``prefix``) that hold a non-decreasing sequence of numbers."""
    values = values.astype(np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, (top // max(n, 1)).bit_length() - 1)
    ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    length = (top >> width) + n + 1
    bits = np.zeros((length // 64 + 1) * 64, np.uint8)
    bits[ones] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    counts = np.bitwise_count(words).astype(np.int64)
    rank = np.concatenate(([0], np.cumsum(counts)))
    return {
        f"{prefix}low": _pack(values & np.uint64((1 << width) - 1), width),
        f"{prefix}high": words, f"{prefix}ones": rank.astype(np.uint32),
        f"{prefix}zeros": (np.arange(len(rank)) * 64 - rank).astype(np.uint32),
        f"{prefix}shape": np.array([n, width, length], np.int64),
    }


_IN_BYTE = np.zeros(256 * 8, np.uint8)  # position of the k-th one of a byte, at byte + 256 * k
for _b in range(256):
    for _k, _i in enumerate(i for i in range(8) if _b >> i & 1):
        _IN_BYTE[_b + 256 * _k] = _i
_ONES, _HIGHS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_PAIRS, _FOURS, _EIGHTS = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)


def select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th (from 0) one of each 64-bit word, which has that many."""
    u = np.uint64
    sums = words - (words >> u(1) & _PAIRS)
    sums = (sums & _FOURS) + (sums >> u(2) & _FOURS)
    sums = ((sums + (sums >> u(4))) & _EIGHTS) * _ONES  # byte i: the ones up to byte i
    k = k.astype(u)
    place = np.bitwise_count(((k * _ONES | _HIGHS) - sums) & _HIGHS).astype(u) << u(3)  # of bytes with no more than k
    rest = k - (sums << u(8) >> place & u(255))
    return (place + _IN_BYTE[((words >> place & u(255)) + (rest << u(8))).astype(np.int64)]).astype(np.int64)


class EliasFano:
    """``ones`` and ``zeros`` count the bits before each 64-bit word, so one search finds a bit's word.

    All arrays stay where they are, mapped or not; nothing is derived from them in advance.
    """

    def __init__(self, arrays: dict[str, np.ndarray], prefix: str):
        self.low, self.high, self.ones, self.zeros = (arrays[prefix + k] for k in ("low", "high", "ones", "zeros"))
        self.n, self.width, self.length = (int(x) for x in arrays[prefix + "shape"])

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero bit."""
        directory = self.ones if ones else self.zeros
        word = np.searchsorted(directory, k.astype(directory.dtype), side="right") - 1
        data = self.high[word] if ones else ~self.high[word]
        return word * 64 + select_in_word(data, k - directory[word].astype(np.int64))

    def _select_both(self, k: np.ndarray, ones: bool) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the k-th bit and of the next one of its kind, mostly in the same word."""
        first = self._select(k, ones)
        word = first >> 6
        data = self.high[word] if ones else ~self.high[word]
        data = data >> (first & 63).astype(np.uint64) >> np.uint64(1)
        step = np.bitwise_count((data & (~data + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        second = first + 1 + step
        far = np.flatnonzero(data == 0)
        second[far] = self._select(k[far] + 1, ones)
        return first, second

    def access_both(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at positions whose next one is in range, and those at the next ones."""
        return tuple(self._value(p, i) for p, i in zip(self._select_both(index, True), (index, index + 1)))

    def _value(self, position: np.ndarray, index: np.ndarray) -> np.ndarray:
        high = (position - index).astype(np.uint64)
        return (high << np.uint64(self.width) | _unpack(self.low, self.width, index)).astype(np.int64)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at positions in range."""
        return self._value(self._select(index, True), index)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Position of the first value that is at least x; n where there is none."""
        return self.find(x)[0]

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first value that is at least x, n where there is none; whether it is x)."""
        out, same = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        if not self.n:
            return out, same
        bucket = x >> self.width
        last = self.length - self.n - 1  # of the buckets
        rows = np.flatnonzero(bucket <= last) if len(x) and bucket.max() > last else slice(None)
        bucket = bucket[rows]
        before, after = self._select_both(np.maximum(bucket - 1, 0), False)
        first = np.where(bucket > 0, before - bucket + 1, 0)
        end = np.where(bucket > 0, after - bucket, before)
        hit = np.zeros(len(first), bool)
        open_ = np.flatnonzero(first < end)
        low, top, sought = first[open_], end[open_], (x[rows] & ((1 << self.width) - 1))[open_]
        while len(open_):  # binary search in every bucket at once
            middle = (low + top) >> 1
            value = _unpack(self.low, self.width, middle).astype(np.int64)
            hit[open_[value == sought]] = True  # the place found is looked at before the search ends there
            less = value < sought
            low, top = np.where(less, middle + 1, low), np.where(less, top, middle)
            first[open_] = low
            more = np.flatnonzero(low < top)
            open_, low, top, sought = open_[more], low[more], top[more], sought[more]
        out[rows], same[rows] = first, hit
        return out, same
