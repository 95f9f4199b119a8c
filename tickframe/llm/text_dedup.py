"""Near-duplicate texts by bottom-k sketches of word shingles.

Every text is a set of hashed shingles; its sketch is the k smallest hashes. Equal sets form a
class with one representative. Representatives meet through inverted lists of sketch values:
two sets that are similar enough share at least ``min_shared`` values of their sketches, so it is
enough to list each sketch under all but so many of its values less one, frequent values left out
first. Pairs from the lists are filtered by the Jaccard similarity estimated on the sketch of
their union and verified on the full sets.

A list of up to LIST_PAIRS members gives all its pairs. The members of a longer list are compared
with a few pivots; what the pivots tie together needs no further comparing, and the members
outside the main component of such a list region are then compared with all others in tiles,
exactly, with nothing leaving a tile but links between different components. No list is cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickframe.llm.components import components, smallest_names
from tickframe.llm.rows import check_ids, id_and_text, map_texts, place, placed, stored, without_rows
from tickframe.llm.spans import mix, text_batches, word_hashes
from tickframe.llm.workers import tidy

K = 64
DEVIATIONS = 5  # what shared sketch values may stay below their mean, in standard deviations
LIST_PAIRS = 64
PIVOTS = 4
TILE_ROWS, TILE_COLUMNS = 256, 512
TILE_SHINGLES = 1 << 20  # of a tile's rows, and of its columns
DF_BUCKETS = 1 << 20  # fixed size of the table of value frequencies, 4 MB
DF_BLOCK = 1 << 14
ID_BUCKETS = 1 << 22  # fixed size of the table of wanted identifiers, 4 MB


def shingle_sets(texts: list, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer than ``width`` words is one shingle, one without words the empty set.
    """
    out = []
    for _, part in text_batches(texts):
        hashes, counts = word_hashes(part)
        # Folding from the last word: each step is a bijection of what was folded so far.
        folded = hashes
        for k in range(1, width):
            folded = mix(hashes[: len(hashes) - k] + mix(folded[1:] + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)) if len(hashes) > k else folded[:0]
        ends = np.cumsum(counts)
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            if b - a >= width:
                out.append(np.unique(folded[a : b - width + 1]))
            elif b > a:
                whole = np.uint64(b - a)
                for h in hashes[a:b]:
                    whole = mix(np.array([h]) + mix(np.array([whole])))[0]
                out.append(np.array([whole], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def similar(shared: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int):
    """100 * intersection >= percent * union, in whole numbers."""
    return 100 * shared >= percent * (x + y - shared)


def sketches(docs: DataFrame, width: int, id_col: str, text_col: str, also: dict[str, Column]) -> DataFrame:
    """(row_id, n, key, sketch): set size, digest of the whole set, the K smallest hashes; and ``also``."""

    def start():
        def compute(texts: list):
            sets = shingle_sets(texts, width)
            return [
                np.array([len(s) for s in sets], np.int64),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s[:K].tobytes() for s in sets], pa.binary()),
            ]

        return compute

    fields = [T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("sketch", T.BinaryType())]
    return map_texts(docs, id_col, text_col, fields, start, keep=also).toDF("row_id", *also, "n", "key", "sketch")


def value_frequencies(classes: DataFrame) -> np.ndarray:
    """How many sketches hold a value of each of DF_BUCKETS buckets; a table of fixed size."""

    def count(batches):
        total = np.zeros(DF_BUCKETS, np.uint32)
        for b in batches:
            values = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)
            total += np.bincount(values & np.uint64(DF_BUCKETS - 1), minlength=DF_BUCKETS).astype(np.uint32)
        yield blocks_of(total)

    return summed_table(classes.select("sketch").mapInArrow(count, BLOCKS), DF_BUCKETS)


def min_shared(percent: int) -> int:
    """Values of K that the sketches of similar sets share but for a chance below 1e-5."""
    p = percent / 100
    return int(K * p - DEVIATIONS * (K * p * (1 - p)) ** 0.5)


def needed_overlap(n: int, percent: int) -> int:
    """Sketch values that a similar set shares at least. Exact where the sketch is the whole set:
    ``percent`` of n, less what the other sketch may have lost by being cut at K."""
    if n > K:
        return min_shared(percent)
    return min(-(-percent * n // 100), K - (K * (100 - percent)) // percent - 1)


def postings(classes: DataFrame, frequency: np.ndarray, percent: int) -> DataFrame:
    """(value, rep, n): each sketch under its rarest values."""
    table = classes.sparkSession.sparkContext.broadcast(frequency)

    def run(batches):
        df = table.value
        for b in batches:
            values, reps, sizes = [], [], []
            for rep, n, data in zip(*(b.column(k).to_pylist() for k in range(3))):
                s = np.frombuffer(data, np.uint64)
                take = len(s) - min(len(s), needed_overlap(n, percent)) + 1
                order = np.lexsort((s, df[s & np.uint64(DF_BUCKETS - 1)]))[:take]
                values.append(s[order].view(np.int64))
                reps.append(np.full(len(order), rep))
                sizes.append(np.full(len(order), n))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (values, reps, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in flat], names=["value", "rep", "n"])

    return classes.select("rep", "n", "sketch").mapInArrow(tidy(run), "value long, rep long, n long")


def summed_table(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the blocks (block, counts) that tasks sent, as one table of ``size`` numbers."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.uint32).astype(np.uint64) for c in table.column("counts").to_pylist())
        total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.table({"block": table.column("block").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((size // DF_BLOCK, DF_BLOCK), np.uint32)
    for row in parts.groupBy("block").applyInArrow(add, BLOCKS).collect():
        out[row["block"]] = np.frombuffer(row["counts"], np.uint32)
    return out.reshape(-1)


def blocks_of(total: np.ndarray) -> pa.RecordBatch:
    blocks = total.astype(np.uint32).reshape(-1, DF_BLOCK)
    used = np.flatnonzero(blocks.any(axis=1))
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([blocks[k].tobytes() for k in used], pa.binary())], names=["block", "counts"]
    )


BLOCKS = "block int, counts binary"


def bucket_of(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64)) & np.uint64(ID_BUCKETS - 1)).astype(np.int64)


def id_filter(reps: DataFrame) -> np.ndarray:
    """True in the buckets of the identifiers in ``reps``' only column: a table of fixed size that lets all
    of them through, and few others while they are far fewer than ID_BUCKETS."""

    def count(batches):
        total = np.zeros(ID_BUCKETS, bool)
        for b in batches:
            total[bucket_of(b.column(0).to_numpy())] = True
        yield blocks_of(total)

    return summed_table(reps.mapInArrow(count, BLOCKS), ID_BUCKETS) > 0


def size_fits(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose union sketch does not rule a link out."""
    one = classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))

    least = min_shared(percent)

    def run(batches):
        for batch in batches:
            keep = []
            for x, y, n, m in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.intersect1d(x, y, assume_unique=True)
                if n <= K and m <= K:
                    keep.append(bool(similar(len(both), n, m, percent)))
                else:
                    union = np.union1d(x, y)[:K]
                    keep.append(int((both <= union[-1]).sum()) >= least * len(union) / K)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in (0, 1)], names=["a", "b"])

    joined = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "s_a", "s_b", "n_a", "n_b")
    return joined.mapInArrow(tidy(run), "a long, b long")


def sets_of(docs: DataFrame, reps: DataFrame, classes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(rep, items): full sets of the representatives in ``reps`` (rep).

    Only texts whose identifier passes a filter of fixed size become sets; the sets, not the texts,
    are then joined with the representatives.
    """
    chosen = stored(classes.select("rep", "first", "key").join(reps.select("rep").distinct(), "rep"), "chosen")
    wanted = docs.sparkSession.sparkContext.broadcast(id_filter(chosen.select("first")))
    ids = id_and_text(docs, id_col, text_col).where("row_id IS NOT NULL")
    ids = ids.select(F.col("row_id").cast("long").alias("first"), "row_text")

    def run(batches):
        for b in batches:
            b = b.filter(pa.array(wanted.value[bucket_of(b.column(0).to_numpy())]))
            sets = shingle_sets(b.column(1).to_pylist(), width)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["first", "key", "items"],
            )

    # A text stands for its class by identifier and set; where a row is given twice, one of them does.
    found = ids.mapInArrow(tidy(run), "first long, key binary, items binary")
    return found.join(chosen, ["first", "key"]).select("rep", "items").dropDuplicates(["rep"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""
    one = sets.select(F.col("rep").alias("a"), F.col("items").alias("s_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("items").alias("s_b"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(similar(shared, len(x), len(y), percent)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in (0, 1)], names=["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "s_a", "s_b").mapInArrow(tidy(run), "a long, b long")


def tile_work(percent: int):
    """Links between different components, of the outsiders of one tile with its members."""

    def run(table: pa.Table) -> pa.Table:
        reps, comps = table.column("rep").to_numpy(), table.column("comp").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
        out = np.flatnonzero(table.column("as_outsider").to_numpy(zero_copy_only=False))
        all_ = np.flatnonzero(table.column("as_member").to_numpy(zero_copy_only=False))
        links_a, links_b = [], []
        if len(out) and len(all_):
            sizes = np.array([len(s) for s in sets])
            columns = 1 << int(np.clip(np.ceil(np.log2(8 * np.median(sizes) + 1)), 10, 14))

            def hashed(rows):
                m = np.zeros((len(rows), columns), np.float32)
                for k, r in enumerate(rows):
                    m[k] = np.bincount((sets[r] & np.uint64(columns - 1)).astype(np.int64), minlength=columns)
                return m

            most = (hashed(out) @ hashed(all_).T).astype(np.int64)  # at least the intersection
            most = np.minimum(most, np.minimum(sizes[out][:, None], sizes[all_][None, :]))
            may = similar(most, sizes[out][:, None], sizes[all_][None, :], percent)
            may &= comps[out][:, None] != comps[all_][None, :]
            done = set()
            for i, j in zip(*np.nonzero(may)):
                x, y = out[i], all_[j]
                between = (min(comps[x], comps[y]), max(comps[x], comps[y]))
                if between not in done:
                    shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if similar(shared, sizes[x], sizes[y], percent):
                        done.add(between)
                        links_a.append(reps[x])
                        links_b.append(reps[y])
        return pa.table({"a": pa.array(links_a, pa.int64()), "b": pa.array(links_b, pa.int64())})

    return run


def outsider_links(lists: DataFrame, links: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links that pivots did not show, among the members of long lists.

    Lists that share members form a region. Of a region's members, those outside its largest
    component are compared with all members of other components.
    """
    star = lists.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    region = components(star).select(F.col("node").alias("rep"), F.col("component").alias("region"))
    comp = components(links).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    members = region.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    members = stored(members.join(classes.select("rep", "n"), "rep"), "members")
    parts = members.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("n"))
    regions = parts.groupBy("region").agg(
        F.max_by("comp", F.struct("count", "comp")).alias("main"), F.sum("count").alias("all"),
        F.max("count").alias("inside"), F.sum("n").alias("all_n"), F.max(F.struct("count", "n"))["n"].alias("inside_n"),
    ).where("all > inside")
    cut = members.join(regions, "region").select(
        "region", "rep", "comp", (F.col("comp") != F.col("main")).alias("out"),
        F.ceil(F.greatest((F.col("all") - F.col("inside")) / TILE_ROWS, (F.col("all_n") - F.col("inside_n")) / TILE_SHINGLES)).cast("int").alias("rows_cut"),
        F.ceil(F.greatest(F.col("all") / TILE_COLUMNS, F.col("all_n") / TILE_SHINGLES)).cast("int").alias("cols_cut"),
    )
    cut = stored(cut, "cut")
    sets = sets_of(docs, cut.select("rep"), classes, width, id_col, text_col)
    cut = cut.withColumns({
        "i": F.when(F.col("out"), F.pmod(F.xxhash64("rep"), "rows_cut").cast("int")),
        "j": F.pmod(F.xxhash64("rep", F.lit(1)), "cols_cut").cast("int"),
    })
    outsider = F.when(F.col("out"), F.transform(F.sequence(F.lit(0), F.col("cols_cut") - 1), lambda k: F.struct(
        F.col("i").alias("i"), k.alias("j"), F.lit(True).alias("as_outsider"), (k == F.col("j")).alias("as_member")
    ))).otherwise(F.array())
    member = F.transform(F.sequence(F.lit(0), F.col("rows_cut") - 1), lambda k: F.struct(
        k.alias("i"), F.col("j").alias("j"), F.lit(False).alias("as_outsider"), F.lit(True).alias("as_member")
    ))
    member = F.filter(member, lambda t: ~F.coalesce(t["i"] == F.col("i"), F.lit(False)))
    dealt = cut.join(sets, "rep").select("region", "rep", "comp", "items", F.explode(F.concat(outsider, member)).alias("t"))
    dealt = dealt.select("region", "rep", "comp", "items", "t.*")
    return dealt.groupBy("region", "i", "j").applyInArrow(tile_work(percent), "a long, b long")


def near_duplicate_links(docs: DataFrame, classes: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) between representatives that give all components of the similarity graph."""
    listed = postings(classes, value_frequencies(classes), percent)
    listed = stored(listed, "postings")
    rank = F.struct(F.xxhash64("rep", F.pmod("value", F.lit(PIVOTS))), "rep")
    lists = listed.groupBy("value").agg(F.count(F.lit(1)).alias("members"), F.min(rank)["rep"].alias("pivot")).where("members > 1")
    lists = stored(listed.join(lists, "value"), "lists")
    short = lists.where(F.col("members") <= LIST_PAIRS).select("value", "rep", "n")
    other = short.select("value", F.col("rep").alias("b"), F.col("n").alias("n_b"))
    met = short.join(other, "value").where((F.col("rep") < F.col("b")) & size_fits("n", "n_b", percent)).select(F.col("rep").alias("a"), "b")
    long = lists.where(F.col("members") > LIST_PAIRS)
    star = long.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
    pairs = stored(estimated(met.union(star).distinct(), classes, percent), "pairs")
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets = sets_of(docs, ends, classes, width, id_col, text_col)
    links = stored(verified(pairs, stored(sets, "sets"), percent), "verified")
    if long.isEmpty():
        return links
    return links.union(outsider_links(long, links, docs, classes, width, percent, id_col, text_col))


def near_duplicates(
    docs: DataFrame, width: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id``, ``kept``.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of ``width``-word
    shingles (lower-cased A-Z; words end at blanks and the characters 9 to 13). A text of fewer
    words is one shingle; null, empty and wordless texts have none and link with nothing. The
    component is the smallest identifier that links reach. Identifiers are whole numbers; null
    ones belong to no component. Other columns are not read.
    """
    check_ids(docs, id_col)
    verdict = near_verdicts(docs, width, percent, id_col, text_col, {})
    return verdict.select(F.col("row_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def near_verdicts(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, also: dict[str, Column]) -> DataFrame:
    """(row_id, n, component_id, kept) and the columns ``also`` of every row.

    Classes of equal sets are numbered: an identifier that repeats with other texts names several
    of them, which stay apart.
    """
    known = stored(sketches(docs, width, id_col, text_col, also), "sketches")
    classes = known.where("n > 0 AND row_id IS NOT NULL").groupBy("key").agg(
        F.min("row_id").cast("long").alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    names = smallest_names(components(near_duplicate_links(docs, classes, width, percent, id_col, text_col)), classes)
    facts = classes.select("key", "rep", "first").join(names, "rep", "left")
    facts = facts.select("key", F.coalesce("name", "first").alias("component"))
    own = F.col("row_id").cast("long")
    component = F.when(F.col("n") > 0, F.coalesce("component", own)).otherwise(own)
    return known.drop("sketch").join(facts, "key", "left").select(
        "row_id", "n", *also, F.when(F.col("row_id").isNotNull(), component).alias("component_id"),
        F.when(F.col("row_id").isNotNull(), component == own).otherwise(True).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are not the first of their component.

    Rows are judged one by one: where an identifier repeats with another text, only the copy goes.
    Rows without an identifier or words stay, and so do rows given twice with what is kept.
    """
    check_ids(docs, id_col)
    docs = placed(docs)
    verdict = near_verdicts(docs, width, percent, id_col, text_col, place(docs))
    return without_rows(docs, verdict.where("NOT kept").select("place_file", "place_row"))
