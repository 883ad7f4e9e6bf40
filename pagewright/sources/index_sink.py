"""S8/P6 index sink with commit: a Python Data Source whose tasks stage and whose driver publishes.

``write_index(rows, client, run)`` hands each task's Arrow batches to
``client.stage``. Each task returns a message, and only when all have ended
the driver calls ``client.publish`` with the messages of those attempts that
count. If any task fails, ``client.discard`` is called and readers see what
they saw before. So a run is visible as a whole or not at all, whatever was
retried or lost on the way.

A client stands for a service (a search index with an alias to switch, a
vector store with collections). :class:`FolderIndex` is the one for a folder
of Parquet files. Clients are pickled to tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..schemas import PAGE_INDEX
from .storage import inside, store_of


class IndexClient:
    """What a sink needs of an index service."""

    def stage(self, run: str, part: str, batches: Iterator[pa.RecordBatch]) -> str:
        """In a task: put the rows where readers don't see them; a message for :meth:`publish`."""
        raise NotImplementedError

    def publish(self, run: str, messages: list[str]) -> None:
        """On the driver: make what these messages name visible, at once.

        Rows replace earlier ones of their page_id. Publishing a run again
        changes nothing.
        """
        raise NotImplementedError

    def discard(self, run: str) -> None:
        """On the driver: drop what the run has staged. Tasks that end later may
        leave more; it is never published."""
        raise NotImplementedError


@dataclass
class _Message(WriterCommitMessage):
    text: str


def write_index(rows: DataFrame, client: IndexClient, run: str) -> None:
    """Write index rows (one per page_id) through ``client`` as the run ``run``."""
    columns = rows.schema

    class Writer(DataSourceArrowWriter):
        def write(self, iterator):
            at = TaskContext.get()
            # attempts of one task write apart from each other
            part = f"{at.partitionId():06d}-{at.attemptNumber()}-{uuid.uuid4().hex[:8]}"
            return _Message(client.stage(run, part, iterator))

        def commit(self, messages):
            client.publish(run, [m.text for m in messages if m is not None])

        def abort(self, messages):
            client.discard(run)

    class Sink(DataSource):
        @classmethod
        def name(cls):
            return "pagewright_index"

        def schema(self):
            return columns

        def writer(self, schema, overwrite):
            return Writer()

    spark = rows.sparkSession
    spark.dataSource.register(Sink)
    rows.write.format("pagewright_index").mode("append").save()


class FolderIndex(IndexClient):
    """Published runs as folders of Parquet files with a list of those that count.

    Tasks write into ``staged``. Publishing writes one small file that names
    the run's parts: before it appears the run isn't there, afterwards all of
    it is. Files of attempts that don't count are in no list.
    """

    def __init__(self, root: str):
        self.root = root

    def _at(self):
        return store_of(self.root)

    def stage(self, run, part, batches):
        fs, base = self._at()
        folder, name = f"{base}/staged/{inside(run)}", f"part-{part}.parquet"
        fs.create_dir(folder, recursive=True)
        writer = None
        n = 0
        with fs.open_output_stream(f"{folder}/{name}") as out:
            for b in batches:
                writer = writer or pq.ParquetWriter(out, b.schema)
                writer.write_batch(b)
                n += b.num_rows
            if writer:
                writer.close()
        if not n:
            fs.delete_file(f"{folder}/{name}")
        return json.dumps({"part": name if n else None, "rows": n})

    def publish(self, run, messages):
        fs, base = self._at()
        parts = [m["part"] for m in map(json.loads, messages) if m["part"]]
        known = self.runs()
        number = next((r["number"] for r in known if r["run"] == run), 1 + max((r["number"] for r in known), default=0))
        fs.create_dir(f"{base}/published", recursive=True)
        place = f"{base}/published/{number:08d}-{inside(run)}.json"
        with fs.open_output_stream(f"{place}.part") as out:
            out.write(json.dumps({"run": run, "number": number, "parts": sorted(parts)}).encode())
        fs.move(f"{place}.part", place)

    def discard(self, run):
        fs, base = self._at()
        if any(r["run"] == run for r in self.runs()):
            return  # an earlier attempt has published; its parts stay
        folder = f"{base}/staged/{inside(run)}"
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)

    def runs(self) -> list[dict]:
        """Published runs, oldest first."""
        fs, base = self._at()
        found = fs.get_file_info(pafs.FileSelector(f"{base}/published", allow_not_found=True))
        out = []
        for name in sorted(f.path for f in found if f.path.endswith(".json")):
            with fs.open_input_stream(name) as f:
                out.append(json.loads(f.read()))
        return out

    def read(self, spark: SparkSession) -> DataFrame:
        """Index rows: of each page_id the row that was published last.

        Which run that is comes from the short page_id column; the wide rows
        are read once and not sorted.
        """
        runs = [r for r in self.runs() if r["parts"]]
        if not runs:
            return spark.createDataFrame([], PAGE_INDEX)
        rows = None
        for r in runs:
            one = (spark.read.schema(PAGE_INDEX).parquet(*(f"{self.root}/staged/{r['run']}/{p}" for p in r["parts"]))
                   .withColumn("_run", F.lit(r["number"])))
            rows = one if rows is None else rows.unionByName(one)
        if len(runs) == 1:
            return rows.drop("_run")
        last = rows.groupBy("page_id").agg(F.max("_run").alias("_run"))
        return rows.join(last, ["page_id", "_run"], "left_semi").drop("_run")
