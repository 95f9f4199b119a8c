"""Exact duplicates by a tree of merged digest runs.

Every task turns its rows into runs sorted by SHA-256. Runs travel in rounds: in each round a
merger takes the runs of ``FAN`` neighbouring senders, restricted to one more digit of the digest,
merges them and keeps, per digest, the identifier that stays and the number of rows. After the
last round each bucket of digests has met all senders. A group of any size is one entry per
sender from the first run on, so hot texts cost no more than others, and no merger sees more
than its bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tickframe.llm.rows import check_ids, id_and_text, place, placed, stored, without_rows
from tickframe.llm.workers import tidy

FAN_BITS = 3
FAN = 1 << FAN_BITS
BUCKET_ROWS = 200_000
RUN_ROWS = 1 << 16
NO_ID = np.iinfo(np.int64).min
RUN = "node long, digests binary, ids binary, sizes binary"
RUN_ARROW = pa.schema([("node", pa.int64()), ("digests", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary())])


def merged(digests: np.ndarray, ids: np.ndarray, sizes: np.ndarray, largest: bool):
    """Sorted entries, one per digest. ``digests`` has four 64-bit words a row.

    A stable sort of laid-out runs is a multiway merge. Rows count as equal only when all 256
    bits agree.
    """
    order = np.argsort(digests[:, 0], kind="stable")
    head = digests[order, 0]
    if (head[1:] == head[:-1]).any():
        order = np.lexsort((digests[:, 3], digests[:, 2], digests[:, 1], digests[:, 0]))
    digests, ids, sizes = digests[order], ids[order], sizes[order]
    new = np.ones(len(ids), bool)
    new[1:] = (digests[1:] != digests[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    if len(at) == len(ids):
        return digests, ids, sizes
    if largest:
        best = np.maximum.reduceat(ids, at)
    else:
        known = np.where(ids == NO_ID, np.iinfo(np.int64).max, ids)
        best = np.minimum.reduceat(known, at)
        best = np.where(np.maximum.reduceat(ids, at) == NO_ID, NO_ID, best)
    return digests[at], best, np.add.reduceat(sizes, at)


def digit(digests: np.ndarray, level: int) -> np.ndarray:
    """The ``level``-th group of FAN_BITS bits of each digest, from the top."""
    return ((digests[:, 0].astype(np.uint64) >> np.uint64(64 - FAN_BITS * level)) & np.uint64(FAN - 1)).astype(np.int64)


def pieces(digests, ids, sizes, path: int, level: int, sender: int) -> pa.Table:
    """A merged run cut by the next digit, addressed to the mergers of round ``level``.

    A merger's number is the digits so far and the sender group, sender // FAN ** level.
    """
    d = digit(digests, level)
    rows = {k: [] for k in RUN_ARROW.names}
    for k in range(FAN):
        take = d == k
        if take.any():
            rows["node"].append(((path << FAN_BITS | k) << 32) | (sender >> (FAN_BITS * level)))
            rows["digests"].append(digests[take].astype(">u8").tobytes())
            rows["ids"].append(ids[take].tobytes())
            rows["sizes"].append(sizes[take].tobytes())
    return pa.table(rows, schema=RUN_ARROW)


def unpack(table: pa.Table):
    join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    return join("digests", ">u8").astype(np.uint64).reshape(-1, 4), join("ids", np.int64), join("sizes", np.int64)


def merge_round(level: int, largest: bool):
    """The work of one merger: all runs of its senders become one, cut for the next round."""

    def merge(table: pa.Table) -> pa.Table:
        node = table.column("node")[0].as_py()
        sender = (node & 0xFFFFFFFF) << (FAN_BITS * (level - 1))
        return pieces(*merged(*unpack(table), largest), node >> 32, level, sender)

    return merge


def digest_groups(digests: DataFrame, largest: bool, rows: int) -> DataFrame:
    """(digest, keep, size), one row per different digest of ``digests`` (row_id, digest)."""
    rounds = max(2, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS + 1, FAN)))
    senders = FAN**rounds

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = TaskContext.get().partitionId() % senders
        held, count = [], 0

        def flush():
            d, i = (np.concatenate(x) for x in zip(*held))
            yield from pieces(*merged(d, i, np.ones(len(i), np.int64), largest), 0, 1, sender).to_batches()

        for b in batches:
            if b.num_rows:
                d = np.frombuffer(b"".join(b.column(1).to_pylist()), ">u8").astype(np.uint64).reshape(-1, 4)
                held.append((d, b.column(0).cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)))
                count += b.num_rows
                if count >= RUN_ROWS:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    runs = digests.mapInArrow(tidy(leaves), RUN)
    for level in range(2, rounds + 1):
        runs = runs.groupBy("node").applyInArrow(merge_round(level, largest), RUN)

    def last(table: pa.Table) -> pa.Table:
        d, i, n = merged(*unpack(table), largest)
        data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(i), [None, pa.py_buffer(d.astype(">u8").tobytes())])
        return pa.table({"digest": data.cast(pa.binary()), "keep": pa.array(i, mask=i == NO_ID), "size": n})

    return runs.groupBy("node").applyInArrow(last, "digest binary, keep long, size long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical; null counts as the empty text, and all empty texts form one
    group. Of equal texts the row with the largest (or smallest) identifier stays; rows that
    repeat an identifier together with its text share the verdict. A null identifier never wins
    against a known one; a group of null identifiers has a null ``keep_id`` and keeps its rows.
    Identifiers are whole numbers. Other columns of ``docs`` are not read.
    """
    check_ids(docs, id_col)
    verdict = exact_verdicts(docs, id_col, text_col, keep, {})
    return verdict.select(
        F.col("row_id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def exact_verdicts(docs: DataFrame, id_col: str, text_col: str, keep: str, also: dict[str, Column]) -> DataFrame:
    """(row_id, digest, keep_id, group_size, kept) and the columns ``also`` of every row."""
    texts = id_and_text(docs, id_col, text_col, also)
    hashed = stored(texts.select("row_id", F.unhex(F.sha2("row_text", 256)).alias("digest"), *also), "digests")
    groups = digest_groups(hashed.select("row_id", "digest"), keep == "largest", hashed.count())
    return hashed.join(groups.where("size > 1"), "digest", "left").select(
        "row_id", "digest", *also,
        F.when(F.col("size").isNull(), F.col("row_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("size").isNull(), True).otherwise(F.col("keep").eqNullSafe(F.col("row_id"))).alias("kept"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with one row of every different text. A row given twice, id and text, stays once, at
    its first place. No documents, no rows."""
    check_ids(docs, id_col)
    docs = placed(docs)
    verdict = stored(exact_verdicts(docs, id_col, text_col, keep, place(docs)), "verdict")
    dropped = verdict.where("NOT kept").select("place_file", "place_row")
    again = verdict.where("kept AND group_size > 1").groupBy("digest").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct("place_file", "place_row")).alias("stays")
    ).where("rows > 1")
    repeated = verdict.where("kept AND group_size > 1").join(again, "digest").where(
        F.struct("place_file", "place_row") != F.col("stays")
    )
    return without_rows(docs, dropped.union(repeated.select("place_file", "place_row")))
