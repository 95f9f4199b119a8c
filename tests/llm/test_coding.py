"""Token operators against the libraries that define their results."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path as vocabulary
from tokenizers import Tokenizer

from tickframe.llm.byte_model import encoded
from tickframe.llm.chunks import ChunkTable
from tickframe.llm.packing import cuts, pack_documents, packed, sequence_ids, token_pieces, vector_best_fit
from tickframe.llm.piece_coding import coding_digests, decode_ids, encode_texts
from tickframe.llm.rows import prepare_texts
from tickframe.llm.spans import TextBatch, text_batches
from tickframe.llm.token_counts import merged_count, token_counts

PIECES, BYTES = vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json")
DOCS = "doc_id long, text string, row_id long, row_text string, length long, piece string"


def odd_texts():
    rng = random.Random(4)
    letters = list("abst dvrlme'' 'ethn  oi.,\n\t12'ß漢²½\x85\xa0\x1c<>s/\x00 ​Ā😀▁  ")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(400)]
    texts += [None, "", " ", "  ", "▁", "a<|endoftext|>b", "<s></s>", "<unk>", "it's we'll 's", "a\n\n b", "x" * 3000, "wörd " * 4000]
    return texts + texts[:3]


@pytest.fixture(scope="module")
def docs(spark):
    prepare_texts(spark)
    rows = [(i if i else None, t, 1, "x", 5, "p") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows, DOCS)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_token_counts_equal_the_library(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = by_id(token_counts(docs, PIECES, limit=100))
    for i, t in enumerate(odd_texts()):
        n = len(sp.encode(t or ""))
        r = got[i if i else None]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((t or "").encode()), n, n > 100)


def test_heap_merging_takes_the_lowest_rank_leftmost():
    ranks = {c: 99 for c in "abc"} | {"ab": 1, "bc": 0, "abc": 2, "aa": 3}
    assert merged_count("abc", ranks) == 1  # bc first, then a + bc
    assert merged_count("aaa", ranks) == 2
    assert merged_count("", ranks) == 0
    assert merged_count("é", ranks) == 2  # two bytes


def test_piece_coding_equals_the_library_and_decodes_back(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    digests, coded = by_id(coding_digests(docs, PIECES)), encode_texts(docs, PIECES)
    lists, decoded = by_id(coded), by_id(decode_ids(coded, PIECES))
    for i, t in enumerate(odd_texts()):
        ids = sp.encode(t or "") + [2]
        back = sp.decode(ids)
        r = digests[i if i else None]
        assert lists[r.doc_id].ids == ids and decoded[r.doc_id].text == back == (t or "").replace("▁", " ")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_byte_level_ids_equal_the_library():
    t = Tokenizer.from_file(BYTES)
    texts = odd_texts()
    for x, data in zip(texts, encoded(texts, BYTES)):
        assert np.frombuffer(data, "<u4").tolist() == t.encode(x or "", add_special_tokens=False).ids


def test_chunk_table_forgets_and_recalls():
    seen = []
    table = ChunkTable(lambda chunks: seen.extend(chunks) or [c.upper() for c in chunks], size=2)
    batch = TextBatch(["ab", "ab", "cd", "ef", "ab"])
    starts, ends = batch.bounds[:-1], batch.bounds[1:]
    for _ in range(3):
        values, index = table.values(batch, starts, ends)
        assert [values[k] for k in index] == ["AB", "AB", "CD", "EF", "AB"]
    assert sorted(seen) == ["ab", "cd", "ef"]


def test_text_batches_keep_every_row():
    texts = ["a" * n for n in (3, 0, 5, 20, 1)] + [None]
    parts = list(text_batches(texts, 8))
    assert [x for _, p in parts for x in p] == [t or "" for t in texts]
    assert all(sum(map(len, p)) <= 8 or len(p) == 1 for _, p in parts)


def test_cuts():
    assert cuts(5, 10) == [(0, 5)] and cuts(10, 10) == [(0, 10)]
    assert cuts(25, 10) == [(0, 5), (5, 10), (15, 10)] and cuts(20, 10) == [(0, 10), (10, 10)]


def test_packing_is_gapless_and_within_every_capacity(docs):
    t = Tokenizer.from_file(BYTES)
    got = pack_documents(docs, BYTES, size=256, max_documents=6, max_cost=256 * 256).collect()
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        n, docs_in, cost = at.get(r.sequence_id, (0, 0, 0))
        assert r.offset == n
        at[r.sequence_id] = (n + r.length, docs_in + 1, cost + r.length**2)
    assert all(n <= 256 and k <= 6 and c <= 256 * 256 for n, k, c in at.values())
    for i, x in enumerate(odd_texts()):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == (i if i else None))
        assert [(s, n) for _, s, n, _ in mine] == cuts(len(ids), 256)
        assert all(c == zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) for _, s, n, c in mine)


def test_packing_needs_few_sequences(docs):
    got = pack_documents(docs, BYTES, size=256)
    used, tokens = got.select("sequence_id").distinct().count(), sum(r.length for r in got.collect())
    assert used <= -(-tokens // 256) + 1


def test_sequences_carry_the_ids(docs):
    pieces = packed(token_pieces(docs.where("doc_id < 40"), BYTES, 64, with_ids=True), 64)
    joined = {r.sequence_id: r.ids for r in sequence_ids(pieces).collect()}
    for r in pieces.collect():
        assert joined[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_best_fit_rules_and_limits():
    lengths = np.array([6, 5, 4, 3, 2])
    bins, offsets = vector_best_fit(lengths, (10, 10, 1000), (1, 0, 0))
    assert len(set(bins)) == 2 and offsets.min() == 0
    one = vector_best_fit(np.array([1, 1, 1, 1]), (10, 2, 100), (1, 1, 1), "dot")[0]
    assert sorted(np.bincount(one)) == [2, 2]
    with pytest.raises(ValueError):
        vector_best_fit(np.array([11]), (10, 10, 1000), (1, 0, 0))


def test_empty_tables(spark, docs):
    none = docs.where("doc_id < 0")
    for df in (token_counts(none, PIECES), coding_digests(none, PIECES), pack_documents(none, BYTES)):
        assert df.count() == 0
