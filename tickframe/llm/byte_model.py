"""Byte-level BPE through a table of distinct pre-tokens.

Pre-tokens are found for whole batches with array operations; the tokenizer then sees each
different pre-token once per task. Texts with code points the class table does not cover, or
with the text of an added token, go to the tokenizer whole.
"""

from __future__ import annotations

import json
from array import array
import unicodedata

import numpy as np

from tickframe.llm.chunks import ChunkTable
from tickframe.llm.spans import TextBatch, text_batches
from tickframe.llm.workers import worker_cache

COVERED = 0x250  # Latin letters and below, whose classes no Unicode version has changed
SPACE, LETTER, NUMBER, OTHER = range(4)


def _class_table() -> np.ndarray:
    table = np.full(COVERED, OTHER, np.uint8)
    for c in range(COVERED):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            table[c] = LETTER if kind == "L" else NUMBER
    table[[*range(9, 14), 32, 0x85, 0xA0]] = SPACE
    return table


CLASSES = _class_table()


@worker_cache(1)
def tokenizer(path: str):
    """The tokenizer and the texts of its added tokens; other layouts than plain byte-level fail."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    before = described["pre_tokenizer"]
    if described["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
        raise ValueError("only a plain byte-level tokenizer can be used")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t, [a["content"] for a in described["added_tokens"]]


def pretokens(batch: TextBatch) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of texts whose code points are all below COVERED.

    The rules are: a contraction; one optional blank and a run of letters, of numbers or of
    others; white space, whose last character is left to what follows it.
    """
    points, n = batch.points, len(batch.points)
    kind = CLASSES[points]
    first = batch.first_of_text()
    same = np.zeros(n, bool)
    same[1:] = (kind[1:] == kind[:-1]) & ~first[1:]
    begins = ~same
    space = kind == SPACE
    last = np.ones(n, bool)
    last[:-1] = begins[1:]
    ends_text = np.ones(n, bool)
    ends_text[:-1] = first[1:]
    # The last white-space character before a word stands apart, and a blank joins the word.
    tail = space & last & ~ends_text
    begins |= tail
    joins = np.flatnonzero(tail & (points == 32)) + 1
    begins[joins] = False
    # Contractions: a lone apostrophe that begins a pre-token, and certain letters after it.
    lone = np.flatnonzero((points == 39) & begins & last)
    lone = lone[lone + 1 < n]
    lone = lone[(kind[lone + 1] == LETTER) & ~first[lone + 1]]
    if len(lone):
        at = lambda k: np.where((lone + k < n) & ~_crosses(first, lone, k), points[np.minimum(lone + k, n - 1)], 0)
        one, two = at(1), at(2)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(lone), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        for chosen, length in ((short, 2), (long & ~short, 3)):
            begins[lone[chosen] + 1] = False
            after = lone[chosen] + length
            begins[after[after < n]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], n)


def _crosses(first: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    crossed = np.zeros(len(at), bool)
    for j in range(1, k + 1):
        crossed |= first[np.minimum(at + j, len(first) - 1)]
    return crossed


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def rank_encoder(path: str):
    """Ids of one pre-token by merging pairs in the order of their ids: three times as fast as
    the tokenizer. None where ids do not follow the order of the merges, or the library has no such call."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, letters = model["vocab"], byte_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab[a + b] for a, b in pairs]
    if ids != sorted(ids) or max(vocab[c] for c in letters) > min(ids):
        return None
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if all(c in letters for c in token) and (len(token) == 1 or i >= ids[0] and i <= ids[-1])}
    coder = tiktoken.Encoding("chunks", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    coder = getattr(coder, "_core_bpe", None)
    if not hasattr(coder, "encode_single_piece"):
        return None
    return lambda c: coder.encode_single_piece(c.encode())


@worker_cache(1)
def id_table(path: str) -> ChunkTable:
    """Pre-token -> its ids as little-endian unsigned 32-bit numbers."""
    merge = rank_encoder(path)
    if merge is None:
        t, _ = tokenizer(path)
        merge = lambda c: t.encode([c], is_pretokenized=True, add_special_tokens=False).ids
    return ChunkTable(lambda chunks: [array("I", merge(c)).tobytes() for c in chunks])


def encoded(texts: list, path: str) -> list[bytes]:
    """The ids of every text, without added ids, as little-endian unsigned 32-bit numbers."""
    t, special = tokenizer(path)
    table, out = id_table(path), []
    for _, part in text_batches(texts):
        batch = TextBatch(part)
        whole = [False] * len(part)
        if len(batch.points) and (batch.points.max() >= COVERED or any(s in batch.joined for s in special)):
            whole = [not x.isascii() and max(x) >= chr(COVERED) or any(s in x for s in special) for x in part]
            batch = TextBatch(["" if w else x for w, x in zip(whole, part)])
        if len(batch.points):
            starts, ends = pretokens(batch)
            values, index = table.values(batch, starts, ends)
            bounds = np.searchsorted(starts, batch.bounds).tolist()
            index = index.tolist()
            rows = [b"".join([values[k] for k in index[a:b]]) for a, b in zip(bounds, bounds[1:])]
        else:
            rows = [b""] * len(part)
        for k, w in enumerate(whole):
            if w:
                rows[k] = np.array(t.encode(part[k], add_special_tokens=False).ids, "<u4").tobytes()
        out.extend(rows)
    return out
