"""BPE by the tokenization automaton against the library and against plain merging."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from public_tokenizers import path as vocabulary
from tokenizers import Tokenizer

from tickframe.llm.bpe_coding import bpe_decode, bpe_digests, bpe_encode
from tickframe.llm.merge_automaton import MergeAutomaton
from tickframe.llm.rows import prepare_texts

BYTES = vocabulary("byte_bpe_50k.json")
DOCS = "doc_id long, text string, row_id long, row_text string, ids string"


def plain_merging(data: bytes, merges):
    parts = [data[i : i + 1] for i in range(len(data))]
    for pair in merges:
        i = 0
        while i + 1 < len(parts):
            if (parts[i], parts[i + 1]) == pair:
                parts[i : i + 2] = [pair[0] + pair[1]]
            i += 1
    return parts


def random_merges(rng, letters, n):
    tokens, merges = [bytes([c]) for c in letters], []
    while len(merges) < n:
        a, b = rng.choice(tokens), rng.choice(tokens)
        if a + b not in tokens:
            merges.append((a, b))
            tokens.append(a + b)
    return merges


@pytest.mark.parametrize("seed", range(30))
def test_the_path_is_the_result_of_merging(seed):
    """All words of two or three letters up to a length, over random merges, dead ones included."""
    rng = random.Random(seed)
    letters = b"ab" if seed % 2 else b"abc"
    merges = random_merges(rng, letters, rng.randrange(1, 12))
    ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + k for k, (a, b) in enumerate(merges)}
    made = MergeAutomaton(merges, ids)
    for n in range(1, 10 if len(letters) == 2 else 7):
        for word in itertools.product(letters, repeat=n):
            data = bytes(word)
            parts = plain_merging(data, merges)
            assert [made.labels[t] for t in made.path(data)] == parts
            numbers, labels = made.encode(data)
            assert np.frombuffer(numbers, "<u4").tolist() == [ids[p] for p in parts] and labels == data


def test_exactly_one_path_spells_a_text():
    merges = [(b"a", b"a"), (b"a", b"b"), (b"aa", b"b"), (b"b", b"b"), (b"aa", b"aa")]
    ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + k for k, (a, b) in enumerate(merges)}
    made = MergeAutomaton(merges, ids)

    def paths(data, state):
        if not data:
            return 1
        return sum(
            paths(data[len(label) :], t) for t, label in enumerate(made.labels)
            if made.alive[t] and data.startswith(label) and made.arc(state, t)
        )

    assert all(paths(bytes(w), -1) == 1 for n in range(1, 8) for w in itertools.product(b"ab", repeat=n))


def test_merges_out_of_order_are_refused():
    ids = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError):
        MergeAutomaton([(b"ab", b"c"), (b"a", b"b")], ids)
    with pytest.raises(ValueError):
        MergeAutomaton([(b"a", b"b")], ids)


def odd_texts():
    rng = random.Random(9)
    near = "abst dvrlme'' 'ethn  oi.,\n\t12'ß漢²½\x85\xa0\x1c<>s/\x00 ​Ā😀▁  "
    texts = ["".join(rng.choice(near) for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += ["".join(chr(rng.randrange(32, 0x3000)) for _ in range(30)) for _ in range(200)]
    texts += [None, "", " ", "a<|endoftext|>b", " <|endoftext|> <|endoftext|>漢", "<|endoftext", "it's we'LL 's", "a\n\n b"]
    texts += ["x" * 50_000, "aab" * 4000, "=" * 5000, "wörd " * 4000, "́e\U0010ffff"]
    return texts + texts[:3]


@pytest.fixture(scope="module")
def docs(spark):
    prepare_texts(spark)
    rows = [(i if i else None, t, 1, "x", "y") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows, DOCS)


def test_coding_equals_the_library_and_decodes_back(docs):
    t = Tokenizer.from_file(BYTES)
    by_id = lambda df: {r.doc_id: r for r in df.collect()}
    coded = bpe_encode(docs, BYTES)
    lists, digests, decoded = by_id(coded), by_id(bpe_digests(docs, BYTES)), by_id(bpe_decode(coded, BYTES))
    for i, text in enumerate(odd_texts()):
        key = i if i else None
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert lists[key].ids == ids and decoded[key].text == back == (text or "")
        r = digests[key]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_decoding_ids_that_encode_no_text(spark):
    t = Tokenizer.from_file(BYTES)
    rng = random.Random(2)
    lists = [[rng.randrange(256) for _ in range(12)] for _ in range(200)] + [[], [50256, 220], None]
    got = {r.doc_id: r.text for r in bpe_decode(spark.createDataFrame(list(enumerate(lists)), "doc_id int, ids array<int>"), BYTES).collect()}
    for i, ids in enumerate(lists):
        assert got[i] == (None if ids is None else t.decode(ids, skip_special_tokens=False))


def test_empty_table(docs):
    none = docs.where("doc_id < 0")
    assert bpe_digests(none, BYTES).count() == bpe_encode(none, BYTES).count() == 0
