"""Shared plumbing of the text operators: batched row functions, hold-out keys, stored steps."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickframe.llm.shared_files import read_arrays, write_arrays
from tickframe.llm.workers import tidy
from tickframe.session import scratch_path
from tickframe.sinks.tables import write_table

ARROW_ROWS, ARROW_BYTES = 256, 8 << 20
PLACE_ROWS = 1 << 22  # rows of a file that share a bitmap of 512 KB


def prepare_texts(spark: SparkSession) -> SparkSession:
    """Arrow batches of at most ARROW_ROWS rows and, but for the last row, ARROW_BYTES: batches of
    long texts or sets must fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives executors."""
    return write_table(df, scratch_path(df.sparkSession, name))


def id_and_text(docs: DataFrame, id_col: str, text_col: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """Only the identifier and the text (null: empty), under fixed names, and the columns ``keep``."""
    return docs.select(
        F.col(f"`{id_col}`").alias("row_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("row_text"),
        *[c.alias(n) for n, c in (keep or {}).items()],
    )


def held_out(id_col: str, parts: int, part: int) -> Column:
    """True where crc32 of the identifier as text leaves ``part``; a null identifier is in no part."""
    rest = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(False))


def may_learn(id_col: str, parts: int, part: int) -> Column:
    """True for rows whose identifier is known and not held out."""
    return F.col(f"`{id_col}`").isNotNull() & ~held_out(id_col, parts, part)


def check_ids(df: DataFrame, id_col: str) -> None:
    """Identifiers that are compared as numbers must be whole numbers."""
    kind = df.select(F.col(f"`{id_col}`")).schema[0].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"the identifier {id_col} must be a whole number, not {kind.simpleString()}")


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with a place for every row, its file and the row's number there: as it is where it
    reads files, else written to the shared folder and read back."""
    try:
        place(docs)
        return docs
    except AnalysisException:
        return stored(docs, "documents")


def place(docs: DataFrame) -> dict[str, Column]:
    """The columns that say where each row of ``docs`` is stored."""
    where = docs.metadataColumn("_metadata")
    found = {"place_file": where["file_path"], "place_row": where["row_index"]}
    docs.select(*found.values())
    return found


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose places (place_file, place_row) are in ``dropped``.

    Only places travel: those of PLACE_ROWS neighbouring rows of a file become one bitmap in the
    shared folder, and the task that reads these rows reads the bitmap. Whatever is dropped, no
    text is sent anywhere and nothing is broadcast.
    """
    folder = scratch_path(docs.sparkSession, "dropped")

    def name(file: str, chunk: int) -> str:
        return f"{folder}/{hashlib.sha256(file.encode()).hexdigest()}-{chunk}"

    def mark(table: pa.Table) -> pa.Table:
        bits = np.zeros(PLACE_ROWS, np.uint8)
        bits[table.column("place_row").to_numpy() % PLACE_ROWS] = 1
        file, chunk = (table.column(c)[0].as_py() for c in ("place_file", "chunk"))
        write_arrays(name(file, chunk), {"bits": np.packbits(bits, bitorder="little")})
        return pa.table({"rows": pa.array([table.num_rows], pa.int64())})

    chunks = dropped.select("place_file", "place_row", F.expr(f"place_row DIV {PLACE_ROWS}").alias("chunk"))
    chunks.groupBy("place_file", "chunk").applyInArrow(mark, "rows long").agg(F.sum("rows")).collect()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bits = None, None
        for b in batches:
            rows = b.column(b.num_columns - 1).to_numpy()
            files, index = np.unique(b.column(b.num_columns - 2).to_numpy(zero_copy_only=False), return_inverse=True)
            keep = np.ones(len(rows), bool)
            for k, chunk in sorted(set(zip(index.tolist(), (rows // PLACE_ROWS).tolist()))):
                if (files[k], chunk) != at:
                    at = (files[k], chunk)
                    try:
                        bits = read_arrays(name(*at))["bits"]
                    except FileNotFoundError:
                        bits = None  # nothing is dropped here
                if bits is not None:
                    mine = np.flatnonzero((index == k) & (rows // PLACE_ROWS == chunk))
                    row = rows[mine] % PLACE_ROWS
                    keep[mine] = bits[row >> 3] >> (row & 7).astype(np.uint8) & 1 == 0
            left = b if keep.all() else b.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(left.columns[:-2], names=left.schema.names[:-2])

    return map_rows(docs.select("*", *place(docs).values()), run, docs.schema)


def map_rows(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | None = None) -> DataFrame:
    """``docs``, batch by batch, as ``run`` leaves it: columns by position, whatever their names are."""
    schema = schema or docs.schema
    names = schema.names

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names=names)

    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(tidy(named, f"{run.__module__}.{run.__qualname__}"), schema)


def gathered(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until ``column`` holds ``size`` bytes: for work with a cost per batch."""
    held, total = [], 0
    for b in batches:
        held.append(b)
        total += b.column(column).nbytes
        if total >= size:
            yield pa.concat_batches(held)
            held, total = [], 0
    if held:
        yield pa.concat_batches(held)


def map_texts(
    docs: DataFrame, id_col: str, text_col: str, fields: list[T.StructField],
    start: Callable[[], Callable[[list], list]], gather: int = 0, keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One result row per document: its identifier and ``fields`` computed from its text.

    ``start`` runs once per task and gives a function from a list of texts to one list or array
    per field. Empty tables give empty results; nothing is kept between rows but what ``start``
    holds. Batches are joined up to ``gather`` bytes of text first. The columns
    ``keep`` are handed on, too.
    """
    pairs = id_and_text(docs, id_col, text_col, keep)
    schema = T.StructType([pairs.schema[0], *pairs.schema[2:], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for b in gathered(batches, 1, gather):
            found = compute(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], *[f if isinstance(f, pa.Array) else pa.array(f) for f in found]],
                names=schema.names,
            )

    return pairs.mapInArrow(tidy(run, f"{start.__module__}.{start.__qualname__}"), schema).withColumnRenamed("row_id", id_col)
