"""Near-duplicate vectors by a pigeonhole join over subspaces.

Unit vectors are rotated and split into blocks of few dimensions. Two vectors with a cosine of at
least t lie within a squared distance of 2 - 2t, so in at least one block they lie within the
block's share of it, in proportion to its dimensions. Each block is range-joined by itself: a
vector has a home cell in a grid over the block's first coordinates and is also sent to
neighbouring cells within the block's radius. Pairs within the radius are verified exactly, in the
first block that has them, so every link is counted once for each of its ends; only counts and
a spanning forest leave a cell.

Equal vectors are one class from the start. Cells with many members are cut into tiles of
bounded size that meet pairwise, so no task holds a whole cell.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tickframe.llm.components import components, local_labels, smallest_names
from tickframe.llm.rows import check_ids, stored

BLOCK = 8
CELL_RADII = 3.0  # width of a grid cell, in radii
CELL_HOMES = 1024  # wanted members of a cell; also the side of a tile
PAIRS_AT_ONCE = 1 << 15
SLACK = 1e-9


@functools.lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int) -> list[slice]:
    return [slice(a, min(dim, a + BLOCK)) for a in range(0, dim, BLOCK)]


def rotated(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)) @ rotation(v.shape[1])


def budgets(dim: int, cosine: float) -> np.ndarray:
    """Squared-distance share of each block, with room for rounding."""
    sizes = np.array([b.stop - b.start for b in blocks_of(dim)])
    return (2 - 2 * cosine + SLACK) * sizes / dim + SLACK


def usable_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(row_id, label, key, vec): vec and key are null unless the row may link with others."""
    label_type = vectors.schema[label_col].dataType
    id_type = vectors.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("row_id", id_type), T.StructField("label", label_type),
        T.StructField("key", T.BinaryType()), T.StructField("vec", T.BinaryType()),
    ])

    def run(batches):
        for b in batches:
            keys, data = [], []
            for label, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                x = None
                if label is not None and v and None not in v:
                    x = np.array(v, np.float64)
                    x = x if np.isfinite(x).all() and x.any() else None
                data.append(None if x is None else x.tobytes())
                keys.append(None if x is None else hashlib.blake2b(data[-1], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(data, pa.binary())], names=schema.names
            )

    return vectors.select(F.col(id_col), F.col(label_col), F.col(vec_col)).mapInArrow(run, schema)


def cell_rows(classes: DataFrame, cosine: float, depth: int) -> DataFrame:
    """``classes`` with ``cells``: (block, cell, home) of every grid cell a vector belongs to."""
    schema = T.StructType([*classes.schema.fields, T.StructField("cells", T.ArrayType(T.StructType([
        T.StructField("block", T.IntegerType()), T.StructField("cell", T.StringType()), T.StructField("home", T.BooleanType()),
    ])))])
    at = classes.columns.index("vec")

    def run(batches):
        for b in batches:
            cells = []
            for data in b.column(at).to_pylist():
                x = rotated(np.frombuffer(data, np.float64)[None, :])[0]
                found = []
                for k, (part, budget) in enumerate(zip(blocks_of(len(x)), budgets(len(x), cosine))):
                    radius = math.sqrt(budget)
                    width = CELL_RADII * radius
                    reach = [("", True)]
                    for c in x[part][:depth]:
                        own = math.floor(c / width)
                        near = range(math.floor((c - radius) / width), math.floor((c + radius) / width) + 1)
                        reach = [(f"{name}{i},", home and i == own) for name, home in reach for i in near]
                    found += [{"block": k, "cell": f"{len(x)}:{name}", "home": home} for name, home in reach]
                cells.append(found)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, CELLS)], names=schema.names)

    return classes.mapInArrow(run, schema)


CELLS = pa.list_(pa.struct([("block", pa.int32()), ("cell", pa.string()), ("home", pa.bool_())]))


def tile_links(cosine: float):
    """The work of one tile: homes against members, pairs counted in their first block only."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        reps = table.column("rep").to_numpy()
        sizes = table.column("size").to_numpy()
        v = np.stack([np.frombuffer(x, np.float64) for x in table.column("vec").to_pylist()])
        r = rotated(v)
        parts, budget = blocks_of(v.shape[1]), budgets(v.shape[1], cosine)
        homes = np.flatnonzero(table.column("as_home").to_numpy(zero_copy_only=False))
        members = np.flatnonzero(table.column("as_member").to_numpy(zero_copy_only=False))
        here = r[:, parts[block]]
        square = (here**2).sum(axis=1)
        unit = v / np.abs(v).max(axis=1, keepdims=True)
        norm = np.sqrt(np.einsum("ij,ij->i", unit, unit))
        links = np.zeros(len(reps), np.int64)
        a_all, b_all = [], []
        step = max(1, (1 << 20) // max(1, len(members)))
        for at in range(0, len(homes), step):
            h = homes[at : at + step]
            near = square[h][:, None] + square[members][None, :] - 2 * here[h] @ here[members].T <= budget[block] + SLACK
            x, y = np.nonzero(near)
            x, y = h[x], members[y]
            differ = x != y
            x, y = x[differ], y[differ]
            for p in range(0, len(x), PAIRS_AT_ONCE):
                i, j = x[p : p + PAIRS_AT_ONCE], y[p : p + PAIRS_AT_ONCE]
                gap = r[i] - r[j]
                gap *= gap
                before = np.zeros(len(i), bool)
                for k in range(block):
                    before |= gap[:, parts[k]].sum(axis=1) <= budget[k]
                within = gap[:, parts[block]].sum(axis=1) <= budget[block]
                i, j = i[within & ~before], j[within & ~before]
                good = np.einsum("ij,ij->i", unit[i], unit[j]) / (norm[i] * norm[j]) >= cosine
                i, j = i[good], j[good]
                links += np.bincount(i, sizes[j], len(reps)).astype(np.int64)
                if len(i):
                    nodes, low = local_labels(reps[i], reps[j])
                    a_all.append(nodes[nodes != low])
                    b_all.append(low[nodes != low])
        counted = np.flatnonzero(links)
        a, b = [np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a_all, b_all)]
        if len(a):
            nodes, low = local_labels(a, b)
            a, b = nodes[nodes != low], low[nodes != low]
        return pa.table({
            "a": pa.array(np.concatenate([reps[counted], a])),
            "b": pa.array(np.concatenate([np.zeros(len(counted), np.int64), b]), mask=np.arange(len(counted) + len(a)) < len(counted)),
            "n": pa.array(np.concatenate([links[counted], np.zeros(len(a), np.int64)])),
        })

    return run


def near_vectors(
    vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id``, ``kept``.

    Vectors link when their labels are equal, their lengths are equal and their cosine in double
    precision is at least ``cosine``. Rows with a null label or a vector that is null, empty,
    zero or not finite link with nothing. Equal vectors link, rows that repeat an identifier too.
    Identifiers are whole numbers. Other columns are not read.
    """
    check_ids(vectors, id_col)
    rows = stored(usable_vectors(vectors, id_col, vec_col, label_col), "vectors")
    classes = rows.where("key IS NOT NULL").groupBy("label", "key").agg(
        F.min("row_id").cast("long").alias("first"), F.count(F.lit(1)).alias("size"), F.first("vec").alias("vec")
    )
    classes = classes.where("first IS NOT NULL").withColumn("rep", F.monotonically_increasing_id())
    classes = stored(classes, "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    depth = 0
    while largest > CELL_HOMES * CELL_RADII**depth and depth < BLOCK:
        depth += 1
    members = stored(cell_rows(classes.select("label", "rep", "size", "vec"), cosine, depth), "cells")
    light = members.select("label", F.explode("cells").alias("c")).select("label", "c.*")
    tiles = (
        light.groupBy("label", "block", "cell").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all"))
        .where("homes > 0")
        .select(
            "label", "block", "cell",
            F.ceil(F.col("homes") / CELL_HOMES).cast("int").alias("rows_cut"),
            F.ceil(F.col("all") / (2 * CELL_HOMES)).cast("int").alias("cols_cut"),
        )
    )
    spread = members.select("label", "rep", "size", "vec", F.explode("cells").alias("c"))
    spread = spread.select("label", "rep", "size", "vec", "c.*").join(tiles, ["label", "block", "cell"])
    spread = spread.withColumns({
        "i": F.when(F.col("home"), F.pmod(F.xxhash64("rep"), "rows_cut")),
        "j": F.pmod(F.xxhash64("rep", F.lit(1)), "cols_cut"),
    })
    # As a home the row is in tiles (i, *), as a member in tiles (*, j).
    as_home = F.when(F.col("home"), F.transform(F.sequence(F.lit(0), F.col("cols_cut") - 1), lambda k: F.struct(
        F.col("i").cast("int").alias("i"), k.alias("j"), F.lit(True).alias("as_home"), (k == F.col("j")).alias("as_member")
    ))).otherwise(F.array())
    as_member = F.transform(F.sequence(F.lit(0), F.col("rows_cut") - 1), lambda k: F.struct(
        k.alias("i"), F.col("j").cast("int").alias("j"), F.lit(False).alias("as_home"), F.lit(True).alias("as_member")
    ))
    as_member = F.filter(as_member, lambda t: ~F.coalesce(t["i"] == F.col("i"), F.lit(False)))
    dealt = spread.select("label", "block", "cell", "rep", "size", "vec", F.explode(F.concat(as_home, as_member)).alias("t"))
    dealt = dealt.select("label", "block", "cell", "rep", "size", "vec", "t.*")
    found = stored(
        dealt.groupBy("label", "block", "cell", "i", "j").applyInArrow(tile_links(cosine), "a long, b long, n long"), "found"
    )
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    names = smallest_names(components(found.where("b IS NOT NULL")), classes)
    facts = (
        classes.select("label", "key", "rep", "first", "size").join(counts, "rep", "left").join(names, "rep", "left")
        .select(
            "label", "key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
            F.coalesce("name", "first").alias("component"),
        )
    )
    own = F.col("row_id").cast("long")
    return rows.select("row_id", "label", "key").join(facts, ["label", "key"], "left").select(
        F.col("row_id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", own).alias("component_id"),
        F.coalesce("component", own).eqNullSafe(own).alias("kept"),
    )
