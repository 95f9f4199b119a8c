"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tickframe.llm.conversation_trie import RESULT, prefix_trie, rebuilt, segment, turn_lists
from tickframe.llm.parentheses import Parentheses

SCHEMA = "conv_id long, turn long, role string, text string, path string, own string, shard int"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs[c].append((turn is not None, turn or 0, digest, role, text))
    convs = {c: [(t[3], t[4]) for t in sorted(v)] for c, v in convs.items()}
    own = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        own[c] = tuple(convs.get(c - c % 20, [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)

    def totals(p):
        mine = (len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        parts = [totals(q) for q in children[p]]
        return (sum(x for x, _ in parts) or 1, mine + sum(y for _, y in parts))

    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if own[c] == p)))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children[p]), *totals(p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie(df, **sizes):
    return sorted((tuple(r) for r in prefix_trie(rebuilt(turn_lists(df)), **sizes).select(*RESULT).collect()), key=str)


def random_rows(seed, n=200, deep=5):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        hot = rng.random() < 0.3  # a third of all are one conversation
        for turn in range(3 if hot else rng.randrange(1, deep)):
            text = f"same {turn}" if hot else " ".join(rng.choice("ab") for _ in range(rng.randrange(3)))
            rows.append((c, turn, rng.choice(["user", None]) if not hot else "user", text or None, "x", "y", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, turns", [(1, 200_000), (2, 7), (3, 40), (4, 1)])
def test_trie_equals_brute_force(spark, seed, turns):
    """Also with many shards and segments, so that every node may be a spine."""
    spark.conf.set("spark.sql.shuffle.partitions", "21")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = random_rows(seed)
        assert trie(spark.createDataFrame(rows, SCHEMA), segment_turns=turns, piece_ids=3, fan=4) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost", None, None, None), (0, None, None, None, None, None, None), (0, 1, "user", "b\ta ", "p", "o", 1),
        (0, 1, "user", "b\ta ", "p", "o", 1), (0, 1, "assistant", "b\ta ", "p", "o", 1), (3, 5, "user", "", None, None, None),
        (45, 0, "user", "alone", None, None, None), (1, 0, "", "", None, None, None), (2, 0, "ab", "c", None, None, None),
        (4, 0, "a", "bc", None, None, None), (7, 2, "user", "x " * 50_000, None, None, None),
        (8, 0, "user", "é\U0001f600 漢", None, None, None), (8, 0, "user", None, None, None, None),
    ] + [(20, k, "user", f"t{k}", None, None, None) for k in range(400)] + [(c, 0, "user", "t0", None, None, None) for c in range(20, 40)]
    assert trie(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
    assert trie(spark.createDataFrame([(None, 1, "user", "a", None, None, None)], SCHEMA)) == []


def test_given_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert trie(df) == brute(rows)


@pytest.mark.parametrize("seed", range(6))
def test_parentheses_close_where_a_stack_says(seed):
    rng = random.Random(seed)
    bits, open_ = [1], 1
    for _ in range([0, 1, 63, 64, 1000, 20_000][seed]):
        if open_ > 1 and rng.random() < 0.5:
            bits.append(0)
            open_ -= 1
        else:
            bits.append(1)
            open_ += 1
    bits += [0] * open_
    stack, close, depth, at = [], {}, {}, []
    for i, b in enumerate(bits):
        if b:
            depth[i] = len(stack)
            stack.append(i)
            at.append(i)
        else:
            close[stack.pop()] = i
    tree = Parentheses(np.array(bits, np.uint8))
    assert tree.find_close().tolist() == [close[i] for i in at] and tree.depths().tolist() == [depth[i] for i in at]


def test_deep_chain_in_one_segment():
    path = b"".join(i.to_bytes(16, "big") for i in range(3000))
    paths = [path[: 16 * k] for k in (0, 1, 2000, 2999, 3000)]
    words = np.ones(sum(len(p) // 16 for p in paths), np.int64)
    _, s = segment(paths, words, np.arange(5), 0, 0)
    assert s.same == 0 and s.right.values["n"].tolist() == [5, 4] + [3] * 1999 + [2] * 999 + [1]
