"""Packing of documents into token sequences by vector best-fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared
lengths). Pieces are placed largest first; among the sequences that can take a piece under every
capacity the one with the smallest weighted residual norm after placing it (or the largest
weighted dot product of demand and residual) is chosen. Pieces that fill a sequence alone never
enter the search. The rest are dealt evenly, by a hash, into lanes of about LANE_PIECES; a lane
has the same mix of lengths as the whole, so one lane wastes no more than any other, and the
cost of lanes is at most one open sequence each.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tickframe.llm.byte_model import encoded
from tickframe.llm.rows import id_and_text, stored
from tickframe.llm.workers import tidy

LANE_PIECES = 16_384
PIECE_FIELDS = [
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
]


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole ones from the end, so the first may be short."""
    if n <= size:
        return [(0, n)]
    head = n % size
    return ([(0, head)] if head else []) + [(s, size) for s in range(head, n, size)]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of every document's ids plus the end id; null and empty texts are the end id alone.

    ``with_ids`` adds the ids of each piece (array<int>).
    """
    pairs = id_and_text(docs, id_col, text_col)
    fields = [T.StructField(id_col, pairs.schema["row_id"].dataType), *PIECE_FIELDS]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    schema = T.StructType(fields)
    last = np.array([end_id], "<u4").tobytes()

    def run(batches):
        for b in batches:
            row, out = [], [[] for _ in PIECE_FIELDS]
            ids = []
            for k, data in enumerate(encoded(b.column(1).to_pylist(), tokenizer_path)):
                data += last
                for p, (s, n) in enumerate(cuts(len(data) // 4, size)):
                    part = data[4 * s : 4 * (s + n)]
                    row.append(k)
                    for column, value in zip(out, (p, s, n, zlib.crc32(part))):
                        column.append(value)
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            columns = [b.column(0).take(pa.array(row, pa.int64()))]
            columns += [pa.array(x, pa.int32() if f.name == "piece" else pa.int64()) for x, f in zip(out, PIECE_FIELDS)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pairs.mapInArrow(tidy(run), schema)


def vector_best_fit(
    lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece. Ties go to the bin opened first."""
    limit = np.array(capacity, float)
    scaled = np.array(weights) / limit**2
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room = np.empty((len(lengths), 3))
    number = np.empty(len(lengths), np.int64)  # of the bins still open, in the order of opening
    used = np.zeros(len(lengths), np.int64)
    open_bins = made = 0
    for step, i in enumerate(np.argsort(-lengths, kind="stable").tolist()):
        n = int(lengths[i])
        need = np.array([n, 1, float(n) * n])
        if (need > limit).any():
            raise ValueError(f"a piece of {n} tokens exceeds a capacity")
        if step % 1024 == 0 and open_bins:
            keep = (room[:open_bins] >= 1).all(axis=1)
            k = int(keep.sum())
            room[:k], number[:k] = room[:open_bins][keep], number[:open_bins][keep]
            open_bins = k
        left = room[:open_bins] - need
        fits = np.flatnonzero((left >= 0).all(axis=1))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin((left[fits] ** 2) @ scaled)]
            else:
                at = fits[np.argmax(room[fits] @ (scaled * need))]
        else:
            at = open_bins
            room[at], number[at] = limit, made
            open_bins, made = open_bins + 1, made + 1
        room[at] -= need
        bins[i] = number[at]
        offsets[i] = used[bins[i]]
        used[bins[i]] += n
    return bins, offsets


def packed(
    pieces: DataFrame, size: int = 1024, max_documents: int | None = None, max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-9, 1e-9), rule: str = "norm",
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: gapless from 0, every capacity kept.

    Without a limit on documents or cost those capacities are the largest a full sequence can
    reach. Pieces of ``size`` tokens stand alone. No table of pieces gives no rows. A single
    piece must fit the capacities (a cost below size squared needs shorter pieces).
    """
    capacity = (size, max_documents or size, max_cost or size * size)
    partial = pieces.where(F.col("length") < size)
    lanes = max(1, math.ceil(partial.count() / LANE_PIECES))
    schema = T.StructType([*partial.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = pieces.columns

    def lane(table: pa.Table) -> pa.Table:
        number = table.column("_lane")[0].as_py()
        bins, offsets = vector_best_fit(table.column("length").to_numpy(), capacity, weights, rule)
        return table.select(names).append_column("sequence_id", pa.array(bins + (number << 32))).append_column("offset", pa.array(offsets))

    dealt = partial.withColumn("_lane", F.pmod(F.xxhash64(*[c for c in names if c != "ids"]), F.lit(lanes)).cast("long"))
    alone = pieces.where(F.col("length") >= size).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
    return dealt.groupBy("_lane").applyInArrow(lane, schema).unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per piece of every document, with its place: see ``token_pieces`` and ``packed``.

    Rows that repeat an identifier are packed as documents of their own. Other columns of
    ``docs`` are not read.
    """
    pieces = token_pieces(docs, tokenizer_path, size, end_id, False, id_col, text_col)
    return packed(stored(pieces, "pieces"), size, **limits)


def sequence_ids(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that carry their ids: one row per sequence."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
