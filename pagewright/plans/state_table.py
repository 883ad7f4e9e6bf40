"""U6 as a table with a patch log, folded bucket by bucket.

Rows lie in folders ``bucket=n`` by a hash of their page_id; a run appends its
patches to the log of the same buckets. Readers see the rows with the log over
them. :meth:`StateTable.compact` counts the log per bucket and folds only the
buckets in which it has grown enough, each replaced as a whole by dynamic
partition overwrite; all others stay as they are. So the bytes written follow
the changed buckets and not the table.

Folding is idempotent: a patch that is folded twice gives the same row. A
compaction that dies leaves either the old folder of a bucket or the new one,
and its log until the new one is in place.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mutations import patch_pages
from ..session import delete_path, list_names, read_text, write_text


class StateTable:
    """The page state at ``root``: ``rows`` and ``log``, both in folders by bucket."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        layout = json.loads(read_text(spark, os.path.join(root, "_layout.json")) or "null")
        if layout is None:
            raise ValueError(f"no state table at {root}")
        self.buckets, self.columns, self.patch_columns = layout["buckets"], layout["rows"], layout["log"]

    @classmethod
    def create(cls, pages: DataFrame, patch_schema: str, root: str, buckets: int) -> "StateTable":
        """A new table of ``pages``; ``patch_schema``: the columns of its patches as DDL."""
        spark = pages.sparkSession
        cls._put(pages, os.path.join(root, "rows"), buckets)
        write_text(spark, os.path.join(root, "_layout.json"), json.dumps({
            "buckets": buckets, "rows": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema),
            "log": patch_schema}))
        return cls(spark, root)

    @staticmethod
    def _bucket(buckets: int) -> Column:
        return F.pmod(F.xxhash64("page_id"), F.lit(buckets)).cast("int")

    @classmethod
    def _put(cls, rows: DataFrame, path: str, buckets: int, mode: str = "error") -> None:
        """Rows into the folders of their buckets, each written by one task."""
        (rows.withColumn("bucket", cls._bucket(buckets)).repartition(buckets, "bucket")
         .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))

    def add(self, pages: DataFrame) -> None:
        """New pages, one more file in their buckets (the caller says that they are new)."""
        self._put(pages, os.path.join(self.root, "rows"), self.buckets, "append")

    def append(self, patches: DataFrame, run: int) -> None:
        """A run's patches (``page_id, seq, ...``); runs are numbered in order. Appending a run again replaces it."""
        self._put(patches, os.path.join(self.root, "log", f"run={run:09d}"), self.buckets, "overwrite")

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(f"{self.columns}, bucket int").parquet(os.path.join(self.root, "rows"))

    def _log(self) -> DataFrame | None:
        """Patches with ``seq`` counted through all runs: a later run's patches come after an earlier run's."""
        path = os.path.join(self.root, "log")
        if not any(n.startswith("run=") for n in list_names(self.spark, path)):
            return None
        rows = self.spark.read.schema(f"{self.patch_columns}, run long, bucket int").parquet(path)
        return rows.withColumn("seq", F.col("run") * F.lit(1 << 32) + F.col("seq"))

    def read(self) -> DataFrame:
        """The pages with all patches over them."""
        rows, log = self._rows().drop("bucket"), self._log()
        return rows if log is None else patch_pages(rows, log.drop("bucket", "run"))

    def patch_counts(self) -> DataFrame:
        """``bucket, rows, patches``: one short row per bucket, counted from folders and row counts alone."""
        rows = self._rows().groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
        log = self._log()
        if log is None:
            return rows.withColumn("patches", F.lit(0).cast("long"))
        patches = log.groupBy("bucket").agg(F.count(F.lit(1)).alias("patches"))
        return rows.join(patches, "bucket", "left").select("bucket", "rows", F.coalesce("patches", F.lit(0)).alias("patches"))

    def compact(self, least: float = 0.1) -> list[int]:
        """Fold the log of the buckets in which it has ``least`` patches a row or more; their numbers."""
        runs = [n for n in list_names(self.spark, os.path.join(self.root, "log")) if n.startswith("run=")]
        worth = sorted(r.bucket for r in self.patch_counts().filter(
            (F.col("patches") > 0) & (F.col("patches") >= least * F.col("rows"))).collect())
        if not worth:
            return []
        # a filter on the folders: nothing of other buckets is read
        rows, log = (df.filter(F.col("bucket").isin(worth)) for df in (self._rows(), self._log()))
        self._put(patch_pages(rows.drop("bucket"), log.drop("bucket", "run")), os.path.join(self.root, "rows"),
                  self.buckets, "overwrite")
        self._drop_log(runs, worth)
        return worth

    def _drop_log(self, runs: list[str], buckets: list[int]) -> None:
        """Remove the folded part of the log; runs appended meanwhile keep theirs."""
        for run in runs:
            folder = os.path.join(self.root, "log", run)
            there = {n for n in list_names(self.spark, folder) if n.startswith("bucket=")}
            done = there & {f"bucket={b}" for b in buckets}
            for name in [*done] if done != there else [""]:
                delete_path(self.spark, os.path.join(folder, name) if name else folder)
