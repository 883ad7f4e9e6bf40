"""Which tables of a run are whole, and what they were made from.

A run writes a table, then a marker with the table's fingerprint: a digest of
its name, its parameters and the fingerprints of everything it reads. A run
that is started again under the same id reads back each table whose marker
has the fingerprint it would get now, and makes the others anew. A marker
goes before its table is rewritten and comes back after, so a run that dies
in between never leaves a marker on half a table. Input tables have
fingerprints of their rows that don't depend on order or files.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_names, read_text, remove, write_text

#: Raise when a stage's meaning changes, so that tables of older code aren't read back.
CODE = 1


def fingerprint_of(*parts) -> str:
    return hashlib.sha256(json.dumps([CODE, *parts], sort_keys=True, default=str).encode()).hexdigest()


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> str:
    """Digest of the rows of ``df`` (of ``columns``), equal for equal rows in any order.

    One aggregate of two sums over row hashes; no shuffle but one row a task.
    """
    cols = [c for c in (columns or df.columns) if c in df.columns]
    rows = df.select(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b"))
    one = rows.agg(F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")),
                   F.sum(F.col("b").cast("decimal(38,0)"))).first()
    return fingerprint_of(cols, [str(x) for x in one])


def of_files(files: DataFrame) -> str:
    """Fingerprint of a tree: its listing where there is one, else paths and bytes."""
    listed = {"length", "modificationTime"} <= set(files.columns)
    return fingerprint(files, ["path", "length", "modificationTime"] if listed else ["path", "content"])


class Manifest:
    """Markers and the event log of one run, as small files below its folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _marker(self, name: str) -> str:
        return os.path.join(self.root, "_committed", f"{name}.json")

    def committed(self, name: str) -> str | None:
        """The fingerprint of the whole table ``name``, None if there is none."""
        text = read_text(self.spark, self._marker(name))
        return json.loads(text)["fingerprint"] if text else None

    def commit(self, name: str, fingerprint: str) -> None:
        write_text(self.spark, self._marker(name), json.dumps({"name": name, "fingerprint": fingerprint}))

    def drop(self, name: str) -> None:
        remove(self.spark, self._marker(name))

    def settings(self) -> dict | None:
        text = read_text(self.spark, os.path.join(self.root, "_run.json"))
        return json.loads(text) if text else None

    def set_up(self, settings: dict) -> None:
        write_text(self.spark, os.path.join(self.root, "_run.json"), json.dumps(settings))

    def append(self, number: int, event: list) -> None:
        write_text(self.spark, os.path.join(self.root, "_log", f"{number:06d}.json"), json.dumps(event))

    def events(self) -> list[list]:
        folder = os.path.join(self.root, "_log")
        return [json.loads(read_text(self.spark, os.path.join(folder, n)))
                for n in sorted(list_names(self.spark, folder)) if n.endswith(".json")]
