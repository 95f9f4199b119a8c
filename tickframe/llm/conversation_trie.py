"""The prefix trie of conversations, in balanced parentheses per shard.

A conversation is the path of its turns' digests. All paths are sorted and cut into shards by range,
whatever they share, so a first turn or a whole conversation that a third of all have fills as
many shards as it needs. Each shard writes its trie as balanced parentheses: ``find_close`` delimits
subtrees, ranks of leaf pairs count leaves, cumulative arrays in preorder give members and savings.

Nodes on the path of a shard's first or last row, its spines, may go on in other shards. A shard
hands on a summary of its two spines; summaries of neighbours are merged in rounds of FAN, what
they share added up and what closes between them given out, until one is left.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickframe.llm.parentheses import Parentheses
from tickframe.llm.rows import stored

DIGEST = 16
SEGMENT_TURNS = 200_000  # of one balanced-parentheses trie; a shard may have several
PIECE_IDS = 100_000  # identifiers in one piece of a list that spans shards
FAN = 16
ROOT_KEY = b"\0" * DIGEST
NO_ENDS = hashlib.sha256(b"").hexdigest()
IN_PIECES = "pieces"
VALUES = ("n", "leaves", "saved", "least", "children")
NODE, SUMMARY, PIECE = 0, 1, 2
OUTPUT = pa.schema([
    ("kind", pa.int32()), ("shard", pa.int64()), ("seq", pa.int64()), ("node_key", pa.binary()), ("blob", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_key", pa.binary()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()),
])
OUTPUT_DDL = (
    "kind int, shard long, seq long, node_key binary, blob binary, conv_id long, depth long, parent_conv_id long, "
    "parent_key binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def output(kind: int, count: int, **columns) -> pa.RecordBatch:
    arrays = []
    for f in OUTPUT:
        given = columns.get(f.name)
        if f.name == "kind":
            arrays.append(pa.array(np.full(count, kind, np.int32)))
        else:
            arrays.append(pa.nulls(count, f.type) if given is None else pa.array(given, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=OUTPUT)


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns at the beginning that two paths share."""
    n = min(len(a), len(b)) // DIGEST
    x, y = (np.frombuffer(p, np.uint64, 2 * n).reshape(-1, 2) for p in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def prefix_keys(path: bytes) -> list[bytes]:
    """A key for every node on a path, from the root on."""
    keys = [ROOT_KEY]
    for at in range(0, len(path), DIGEST):
        keys.append(hashlib.blake2b(keys[-1] + path[at : at + DIGEST], digest_size=DIGEST).digest())
    return keys


class Spine:
    """The nodes on one path, by depth, as far as a run of rows shows them."""

    def __init__(self, path: bytes, words: np.ndarray, values: dict[str, np.ndarray], ends: list[str]):
        self.path, self.words, self.values, self.ends = path, words, values, ends

    def __len__(self) -> int:
        return len(self.ends)


class Summary:
    """The spines of a run of sorted rows: of its first and of its last path."""

    def __init__(self, left: Spine, right: Spine):
        self.left, self.right = left, right
        self.same = shared_turns(left.path, right.path)  # up to this depth both are the same nodes


def range_least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least of values[begin:end] for many ranges, none empty, from a table of powers of two."""
    levels, width = [values], 1
    while 2 * width <= len(values):
        last = levels[-1]
        levels.append(np.minimum(last[: len(last) - width], last[width:]))
        width *= 2
    size = end - begin
    level = np.frexp(size.astype(float))[1] - 1
    out = np.empty(len(begin), np.int64)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(levels[k][begin[at]], levels[k][end[at] - (1 << int(k))])
    return out


def segment(paths: list[bytes], words: np.ndarray, ids: np.ndarray, shard: int, seq: int, piece_ids: int = PIECE_IDS) -> tuple[list[pa.RecordBatch], Summary]:
    """Closed nodes, identifier pieces and the summary of sorted rows.

    ``words``: those of the turns of all rows, one after the other.
    """
    # Rows of one path become one row with many identifiers.
    new = np.array([True] + [a != b for a, b in zip(paths, paths[1:])])
    first_of = np.flatnonzero(new)
    run_end = np.append(first_of[1:], len(paths))
    turn_end = np.cumsum([len(p) // DIGEST for p in paths])
    rows = [paths[i] for i in first_of]
    lengths = np.array([len(p) // DIGEST for p in rows])
    words_at = turn_end[first_of] - lengths
    digests = np.frombuffer(b"".join(rows), np.uint64).reshape(-1, 2)
    starts = np.cumsum(lengths) - lengths
    count = len(rows)

    # Turns shared with the row before.
    common = np.zeros(count, np.int64)
    if count > 1:
        most = np.minimum(lengths[1:], lengths[:-1])
        of = np.repeat(np.arange(count - 1), most)
        k = np.arange(len(of)) - np.repeat(np.cumsum(most) - most, most)
        differ = np.flatnonzero((digests[starts[1:][of] + k] != digests[starts[:-1][of] + k]).any(axis=1))
        common[1:] = most
        # The first difference of each row: later ones are overwritten by walking backwards.
        back = differ[::-1]
        common[1:][of[back]] = k[back]
    opened = lengths - common
    closed = np.append(0, lengths[:-1] - common[1:])
    runs = np.empty(2 * count + 2, np.int64)
    runs[0], runs[1:-1:2], runs[2:-1:2], runs[-1] = 1, closed, opened, lengths[-1] + 1
    kinds = np.zeros(len(runs), np.uint8)
    kinds[0], kinds[2:-1:2] = 1, 1
    tree = Parentheses(np.repeat(kinds, runs))
    depth, close, n = tree.depths().astype(np.int64), tree.find_close(), len(tree.opens)
    over = np.arange(n) + (close - tree.opens + 1) // 2  # preorder of the first node behind the subtree

    own_words = np.zeros(n, np.int64)
    row_of = np.repeat(np.arange(count), opened)
    own_words[1:] = words[words_at[row_of] + depth[1:] - 1]
    end_node = np.cumsum(opened)
    ending = np.zeros(n + 1, np.int64)
    ending[end_node + 1] = run_end - first_of
    rows_ended = np.zeros(n + 1, np.int64)
    rows_ended[end_node + 1] = 1
    members, rows_before = np.cumsum(ending), np.cumsum(rows_ended)
    here = np.arange(n)
    convs = members[over] - members[here]
    savings = np.concatenate(([0], np.cumsum((convs - 1) * own_words)))
    by_depth = np.argsort(depth, kind="stable") if n else here
    ranked = depth[by_depth] * n + by_depth
    parent = np.full(n, -1, np.int64)
    parent[1:] = by_depth[np.searchsorted(ranked, (depth[1:] - 1) * n + here[1:]) - 1]
    values = {
        "n": convs, "leaves": tree.leaf_rank[close] - tree.leaf_rank[tree.opens], "saved": savings[over] - savings[here],
        "least": range_least(np.minimum.reduceat(ids, first_of), rows_before[here], rows_before[over]),
        "children": np.bincount(parent[1:], minlength=n),
    }
    ends = [NO_ENDS] * n
    out = []
    for r in range(count):
        run = ids[first_of[r] : run_end[r]]
        if 0 < r < count - 1:
            ends[end_node[r]] = hashlib.sha256(",".join(map(str, run.tolist())).encode()).hexdigest()
        else:
            ends[end_node[r]] = IN_PIECES
            key = prefix_keys(rows[r])[-1]
            cut = range(0, len(run), piece_ids)
            out.append(output(
                PIECE, len(cut), shard=[shard] * len(cut), seq=[(seq * 2 + (r > 0)) * (1 << 32) + k for k in range(len(cut))], node_key=[key] * len(cut),
                blob=[",".join(map(str, run[a : a + piece_ids].tolist())).encode() for a in cut],
            ))
    left, right = here[: lengths[0] + 1], np.flatnonzero(over == n)

    def spine(nodes: np.ndarray, row: int) -> Spine:
        w = np.append(0, words[words_at[row] : words_at[row] + lengths[row]])
        return Spine(rows[row], w, {k: v[nodes] for k, v in values.items()}, [ends[i] for i in nodes])

    summary = Summary(spine(left, 0), spine(right, count - 1))
    on_spine = np.zeros(n, bool)
    on_spine[left] = on_spine[right] = True
    done = np.flatnonzero(~on_spine)
    if len(done):
        keys: dict[int, bytes] = {}
        for nodes, row in ((left, 0), (right, count - 1)):
            keys.update(zip(nodes.tolist(), prefix_keys(rows[row])))
        above = parent[done]
        waiting = on_spine[above]
        out.append(output(
            NODE, len(done), conv_id=values["least"][done], depth=depth[done],
            parent_conv_id=pa.array(values["least"][above], mask=waiting),
            parent_key=[keys[p] if w else None for p, w in zip(above.tolist(), waiting.tolist())],
            n_convs=convs[done], n_children=values["children"][done], n_leaves=values["leaves"][done],
            saved_tokens=values["saved"][done], ends_sha256=[ends[i] for i in done],
        ))
    return out, summary


def closed_nodes(spine: Spine, values: dict[str, np.ndarray], ends: list[str], depths: list[int]) -> list[pa.RecordBatch]:
    """Nodes of a path that are complete, by depth; a parent that is not is named by its key."""
    if not depths:
        return []
    keys, done = prefix_keys(spine.path), set(depths)
    known = [d > 0 and d - 1 in done for d in depths]
    return [output(
        NODE, len(depths), node_key=[keys[d] for d in depths], conv_id=values["least"][depths], depth=depths,
        parent_conv_id=[int(values["least"][d - 1]) if k else None for d, k in zip(depths, known)],
        parent_key=[None if k or not d else keys[d - 1] for d, k in zip(depths, known)],
        n_convs=values["n"][depths], n_children=values["children"][depths], n_leaves=values["leaves"][depths],
        saved_tokens=values["saved"][depths], ends_sha256=[None if ends[d] == IN_PIECES else ends[d] for d in depths],
    )]


def merged(a: Summary, b: Summary) -> tuple[list[pa.RecordBatch], Summary]:
    """The summary of rows and of those that follow them, and the nodes that close between them."""
    one, two = a.right, b.left
    common = shared_turns(one.path, two.path)
    both = slice(0, common + 1)
    x, y = ({k: v[both] for k, v in s.values.items()} for s in (one, two))
    words = one.words[both]
    joint = {
        "n": x["n"] + y["n"], "least": np.minimum(x["least"], y["least"]),
        # The last path of ``a`` was a leaf there; if it goes on, or goes on being, in ``b``, it counts there.
        "leaves": x["leaves"] + y["leaves"] - (common == len(one) - 1),
        # Each shared node counts its members less one only once.
        "saved": x["saved"] + y["saved"] + np.cumsum(words[::-1])[::-1],
        "children": x["children"] + y["children"] - (np.arange(common + 1) < common),
    }
    ends = []
    for p, q in zip(one.ends[both], two.ends[both]):
        ends.append(p if q == NO_ENDS else q if p == NO_ENDS else IN_PIECES)

    def renewed(spine: Spine, same: int) -> Spine:
        """A spine whose nodes down to ``same`` lie on the path where the two runs meet."""
        upto = min(same, common) + 1
        values = {k: np.concatenate((joint[k][:upto], v[upto:])) for k, v in spine.values.items()}
        return Spine(spine.path, spine.words, values, ends[:upto] + spine.ends[upto:])

    out = []
    for spine, same in ((one, a.same), (two, b.same)):
        whole = {k: np.concatenate((joint[k], v[common + 1 :])) for k, v in spine.values.items()}
        all_ends = ends + spine.ends[common + 1 :]
        depths = [d for d in range(common + 1, len(spine)) if d > same]
        if spine is one:
            depths = [d for d in range(common + 1) if d > max(a.same, b.same)] + depths
        out += closed_nodes(spine, whole, all_ends, depths)
    return out, Summary(renewed(a.left, a.same), renewed(b.right, b.same))


def last_nodes(s: Summary) -> list[pa.RecordBatch]:
    """All nodes of the only summary left."""
    out = closed_nodes(s.left, s.left.values, s.left.ends, list(range(len(s.left))))
    return out + closed_nodes(s.right, s.right.values, s.right.ends, list(range(s.same + 1, len(s.right))))


def shard_tries(segment_turns: int, piece_ids: int):
    """From a shard's sorted rows (shard, path, words, conv_id) to its closed nodes and summary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, words, ids, turns, seq, whole, shard = [], [], [], 0, 0, None, 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal whole, seq, turns
            out, summary = segment(paths, np.concatenate(words), np.concatenate(ids), shard, seq, piece_ids)
            yield from out
            if whole is not None:
                out, summary = merged(whole, summary)
                yield from out
            whole, seq, turns = summary, seq + 1, 0
            for held in (paths, words, ids):
                held.clear()

        for b in batches:
            if not b.num_rows:
                continue
            shard = b.column(0)[0].as_py()
            paths += b.column(1).to_pylist()
            words.append(b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            ids.append(b.column(3).to_numpy())
            turns += len(words[-1]) + b.num_rows
            if turns > segment_turns:
                yield from close()
        if paths:
            yield from close()
        if whole is not None:
            yield output(SUMMARY, 1, shard=[shard], blob=[pickle.dumps(whole)])

    return run


def merge_shards(fan: int, last: bool):
    """Merge the summaries of ``fan`` neighbouring shards; of the last ones nothing stays open."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("shard").to_numpy())
        blobs = table.column("blob").to_pylist()
        out, whole = [], None
        for k in order:
            part = pickle.loads(blobs[k])
            if whole is not None:
                more, part = merged(whole, part)
                out += more
            whole = part
        if last:
            out += last_nodes(whole)
        else:
            shard = table.column("shard")[int(order[0])].as_py() // fan
            out.append(output(SUMMARY, 1, shard=[shard], blob=[pickle.dumps(whole)]))
        return pa.Table.from_batches(out, OUTPUT)

    return run


def piece_digests(pieces: DataFrame) -> DataFrame:
    """(node_key, sha): digests of lists that came in pieces, each read once, in order, as a stream."""

    def run(batches):
        key, state, parts = None, None, 0
        for b in batches:
            keys, digests = [], []
            for k, blob in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state, parts = k, hashlib.sha256(), 0
                state.update(b"," + blob if parts else blob)
                parts += 1
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["node_key", "sha"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["node_key", "sha"])

    dealt = pieces.select("node_key", "shard", "seq", "blob").repartition("node_key")
    return dealt.sortWithinPartitions("node_key", "shard", "seq").mapInArrow(run, "node_key binary, sha string")


def turn_digest(role: Column, text: Column) -> Column:
    """Names a turn: 128 bits of SHA-256, as hex, of the role's length, the role and the text."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * DIGEST)


def turn_lists(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, own): each conversation's turns in order, as (digest, words).

    Null turns come first, equal ones in the order of their digests; null roles and texts are empty.
    Rows without a conversation id belong to no conversation. Texts stay where they are: 40 bytes a
    turn are sent, and a conversation's turns must fit a task in that form.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.struct(
            F.col(f"`{turn_col}`").alias("turn"), turn_digest(role, text).alias("digest"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))


def rebuilt(lists: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, own) with every conversation's first h turns taken from the first of its group.

    h is the unsigned crc32 of the decimal id modulo ``heads``; the group's first is the id less its
    remainder by ``group``. Fewer turns, or none, are taken where that one has fewer.
    """
    first = lists.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, heads - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = lists.join(first, F.col("conv_id") - F.col("conv_id") % group == F.col("base"), "left").withColumn("h", h)
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("own", 1, 0))
    tail = F.slice("own", F.col("h") + 1, F.size("own"))
    return both.select("conv_id", F.concat(head, tail).alias("own"))


def prefix_trie(lists: DataFrame, segment_turns: int = SEGMENT_TURNS, piece_ids: int = PIECE_IDS, fan: int = FAN) -> DataFrame:
    """One row per distinct prefix of the turn lists (conv_id, own), the empty one included.

    ``conv_id``, the smallest of the conversations that begin with it; ``depth``, its turns;
    ``parent_conv_id``; ``n_convs``; ``n_children``; ``n_leaves``, the childless nodes of its
    subtree; ``saved_tokens``, summed over its subtree, (n_convs - 1) times the words of the last turn;
    ``ends_sha256`` of the ids, ascending and joined by commas, of the conversations that are just
    this prefix. Conversations without turns belong to the root alone. No conversations, no nodes;
    a conversation id that comes in several rows of ``lists`` counts once for each.
    """
    rows = lists.select(
        F.unhex(F.array_join(F.col("own.digest"), "")).alias("path"), F.col("own.words").alias("words"), "conv_id"
    )
    rows = stored(rows, "paths")
    cut = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    cut = cut.select(F.spark_partition_id().cast("long").alias("shard"), "path", "words", "conv_id")
    made = stored(cut.mapInArrow(shard_tries(segment_turns, piece_ids), OUTPUT_DDL), "tries")
    tables, summaries = [made], made
    shards = (made.where(F.col("kind") == SUMMARY).agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        last = shards <= fan
        waiting = summaries.where(F.col("kind") == SUMMARY).select("shard", "blob", F.floor(F.col("shard") / fan).alias("group"))
        summaries = stored(waiting.groupBy("group").applyInArrow(merge_shards(fan, last), OUTPUT_DDL), "spines")
        tables.append(summaries)
        shards = -(-shards // fan)
        if last:
            break
    inner = made.where(F.col("kind") == NODE)
    spine = tables[1]
    for t in tables[2:]:
        spine = spine.union(t)
    spine = spine.where(F.col("kind") == NODE)
    digests = piece_digests(made.where(F.col("kind") == PIECE))
    spine = stored(spine.join(digests, "node_key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "sha")).drop("sha"), "spine")
    parents = spine.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("parent"))
    nodes = inner.unionByName(spine)
    waiting = nodes.where(F.col("parent_key").isNotNull()).join(parents, "parent_key")
    return nodes.where(F.col("parent_key").isNull()).select(*RESULT).union(
        waiting.withColumn("parent_conv_id", F.col("parent")).select(*RESULT)
    )
