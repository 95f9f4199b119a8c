"""Commits of a date-partitioned table: small numbered files that name the folder of every date.

A batch of dates is written to a folder of its own, which nothing reads yet. A commit then adds one
file, the manifest, with the folder and the validity of each date of the whole calendar. It appears
whole under the next number or not at all, so readers see all of a batch or nothing of it, a date
that came out empty loses its old rows, and a writer that dies leaves only a folder to vacuum. The
store must rename a file atomically and refuse an existing target, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from datetime import date
from typing import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tickframe.sinks.files import children, file_system, remove

PLAIN = ""  # the folder ``date=...`` of the table itself, as other writers leave it
NONE = "-"  # no rows


@dataclass(frozen=True)
class Manifest:
    """``folders``: date -> batch, PLAIN or NONE; dates that are not named are PLAIN. ``seen``: the
    last date of the sources when a date was computed, of tables that look ahead."""

    number: int = 0
    folders: dict[date, str] = field(default_factory=dict)
    valid: frozenset[date] = frozenset()
    schema: str | None = None
    seen: dict[date, date] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "folders": {d.isoformat(): b for d, b in sorted(self.folders.items())},
            "valid": [d.isoformat() for d in sorted(self.valid)], "schema": self.schema,
            "seen": {d.isoformat(): x.isoformat() for d, x in sorted(self.seen.items())},
        })

    @staticmethod
    def from_json(number: int, text: str) -> Manifest:
        found, day = json.loads(text), date.fromisoformat
        return Manifest(
            number, {day(d): b for d, b in found["folders"].items()}, frozenset(map(day, found["valid"])), found["schema"],
            {day(d): day(x) for d, x in found["seen"].items()},
        )


class NumberedFiles:
    """A folder of small texts with ascending numbers, each published whole and once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def numbers(self) -> list[int]:
        names = children(self.spark, self.folder)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> str:
        fs, p = file_system(self.spark, self._path(number))
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, number: int, text: str) -> bool:
        """False if the number is taken."""
        jvm = self.spark.sparkContext._jvm
        fs, temporary = file_system(self.spark, f"{self.folder}/.{uuid.uuid4().hex}")
        out = fs.create(temporary, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        target = jvm.org.apache.hadoop.fs.Path(self._path(number))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        no_options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(temporary, target, no_options)  # fails where the target exists
        except Py4JJavaError as e:
            fs.delete(temporary, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def remove(self, number: int) -> bool:
        return bool(remove(self.spark, self._path(number)))


class Commits:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.files = NumberedFiles(spark, f"{path}/_commits")

    def batch_path(self, batch: str) -> str:
        return f"{self.path}/_batches/batch={batch}"

    def new_batch(self) -> str:
        return f"b{uuid.uuid4().hex}"

    def read(self, number: int | None = None) -> Manifest:
        """The newest manifest, or one by its number."""
        if number is None:
            number = max(self.files.numbers(), default=0)
        return Manifest.from_json(number, self.files.read(number)) if number else Manifest()

    def commit(self, change: Callable[[Manifest], Manifest]) -> Manifest:
        """Apply ``change`` to the newest manifest; again if another writer was faster."""
        while True:
            before = self.read()
            after = replace(change(before), number=before.number + 1)
            if replace(after, number=before.number) == before:
                return before
            if self.files.publish(after.number, after.to_json()):
                return after

    def vacuum(self, keep: int = 1) -> int:
        """Remove manifests but the newest ``keep``, and the batch folders that none of these names.

        Not while a batch is being computed: its folder is named only by its commit.
        """
        numbers = self.files.numbers()
        held = {b for n in numbers[-keep:] for b in self.read(n).folders.values()}
        done = sum(self.files.remove(n) for n in numbers[:-keep])
        for b in children(self.spark, f"{self.path}/_batches"):
            if b.removeprefix("batch=") not in held:
                done += bool(remove(self.spark, f"{self.path}/_batches/{b}"))
        return done
