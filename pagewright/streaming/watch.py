"""P10 with state: new, edited, moved and deleted files, without reading the registry.

Each poll lists the tree (no bytes) and puts the listing down as one more
folder of a stream of polls. The stream keeps a row of state per path: length,
modification time, hashes, and the poll that saw it last. A batch of the
stream sorts state and listings by path and goes through them once, in Arrow
batches: no path has a call, a frame or a timer of its own. A row that equals
its state ends there; only for another length or time the task opens the file
and hashes it in chunks. A path that the latest poll hasn't is gone. Events
and new state are written in the folder of the batch, which reads the state
of the batch before it, so a batch that is run again writes the same, and a
poll that dies is finished by the next one: no event is lost or written twice.

Work per poll is the listing and the state, rows of a few hundred bytes; bytes
are read of changed files only; neither the registry nor earlier listings are
read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.mutations import apply_changes_strict
from ..operators.rank import row_number_within
from ..session import delete_path, list_names, new_run_id, rename
from ..sources.files import PDF_GLOB, read_tree
from ..sources.storage import digests, inside, store_of

NEW, MODIFIED, DELETED, MOVED, ERROR = "NEW", "MODIFIED", "DELETED", "MOVED", "ERROR"

#: A poll's rows. ``modified`` is in microseconds; hashes are null where the file is to be read.
LISTING = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("modified", T.LongType()), T.StructField("content_hash", T.StringType()),
    T.StructField("doc_id", T.StringType()), T.StructField("seen", T.TimestampType())])
EVENTS = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("event", T.StringType()),
    T.StructField("content_hash", T.StringType()), T.StructField("doc_id", T.StringType()),
    T.StructField("old_content_hash", T.StringType()), T.StructField("old_doc_id", T.StringType()),
    T.StructField("seen_ms", T.LongType()), T.StructField("error", T.StringType())])
_STATE = "path string, length long, modified long, content_hash string, doc_id string, seen_ms long"
#: What a batch writes: events and, with ``length`` and ``modified``, the new state, in folders by ``kind``.
_WRITTEN = T.StructType([*EVENTS.fields, T.StructField("length", T.LongType()), T.StructField("modified", T.LongType()),
                         T.StructField("kind", T.StringType())])
_EVENT, _KNOWN = "event", "state"
#: The path of the row that every poll has, so that an empty tree has a time, too.
_BEAT = ""


class Watcher:
    """Goes through the rows of a partition, each path's state first and then its polls in order; ``now`` is the latest poll."""

    def __init__(self, root: str | None, now: int):
        self.root, self.now = root, now

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, old, begun = None, None, False
        for batch in batches:
            out = []
            for known, p, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or p != path:
                    out += self._left(path, old)
                    path, old, begun = p, None, True
                old = tuple(row) if known else self._polled(path, old, row, out)
            yield _arrow(out)
        yield _arrow(self._left(path, old))

    def _polled(self, path, old, row, out: list) -> tuple | None:
        """The state after a poll's row; what happened goes to ``out``."""
        length, modified, *_, seen_ms = row
        if path == _BEAT or old and old[:2] == (length, modified):
            return (*(old or row)[:4], seen_ms)
        content, doc, error = self._hashes(row, path)
        before = old[2:4] if old else (None, None)
        if error:
            out.append((path, ERROR, None, None, *before, seen_ms, error, None, None, _EVENT))
            return (*old[:4], seen_ms) if old else None  # it is there, and is read again next time
        if not old:
            out.append((path, NEW, content, doc, None, None, seen_ms, None, None, None, _EVENT))
        elif old[2] != content:
            out.append((path, MODIFIED, content, doc, *before, seen_ms, None, None, None, _EVENT))
        return (length, modified, content, doc, seen_ms)

    def _left(self, path, old) -> list:
        """After the last row of a path: its new state, or that it is gone."""
        if old is None:
            return []
        length, modified, content, doc, seen_ms = old
        if seen_ms < self.now:
            return [(path, DELETED, None, None, content, doc, self.now, None, None, None, _EVENT)]
        return [(path, None, content, doc, None, None, seen_ms, None, length, modified, _KNOWN)]

    def _hashes(self, row, path: str):
        length, _, content, doc, _ = row
        if content is not None:
            return content, doc, None
        try:
            fs, base = store_of(self.root)
            content, doc, n = digests(fs, f"{base}/{inside(path)}", path)
        except Exception as e:  # noqa: BLE001 - errors become values
            return None, None, f"{type(e).__name__}: {e}"
        return (content, doc, None) if n == length else (None, None, "changed while it was read")


def _arrow(rows: list) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    columns = zip(*rows) if rows else [()] * len(_WRITTEN)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, _WRITTEN)],
                                      names=_WRITTEN.fieldNames())


def list_tree(spark: SparkSession, root: str, glob: str = PDF_GLOB) -> DataFrame:
    """``path, length, modified`` of the files below ``root``, without their bytes."""
    return read_tree(spark, root, glob).select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def write_poll(listing: DataFrame, folder: str, seen_ms: int) -> None:
    """One more poll of the stream below ``folder``: ``path, length, modified`` and hashes if they are known.

    Polls are numbered by their time, which must grow. The rows appear at
    once, by the rename of a folder: half a listing would look like deletions.
    """
    spark = listing.sparkSession
    none = F.lit(None).cast("string")
    rows = listing.select("path", "length", "modified",
                          *(F.col(c) if c in listing.columns else none.alias(c) for c in ("content_hash", "doc_id")))
    beat = spark.createDataFrame([(_BEAT, None, None, None, None)], T.StructType(LISTING.fields[:-1])).coalesce(1)
    part = os.path.join(folder, "staged", new_run_id())
    (rows.union(beat).withColumn("seen", F.timestamp_millis(F.lit(seen_ms))).write.parquet(part))
    rename(spark, part, os.path.join(folder, "polls", f"poll-{seen_ms:016d}"))


def _state_before(spark: SparkSession, work: str, epoch: int) -> DataFrame | None:
    """The state that the last batch before ``epoch`` left; those before it, which no batch needs again, are removed."""
    names = sorted((n for n in list_names(spark, work) if n.startswith("batch=")), key=lambda n: int(n[6:]))
    *older, last = [None, *(n for n in names if int(n[6:]) < epoch)]
    for name in older[-3:]:
        if name:
            delete_path(spark, os.path.join(work, name, f"kind={_KNOWN}"))
    return spark.read.schema(_STATE).parquet(os.path.join(work, last, f"kind={_KNOWN}")) if last else None


def _work_off(work: str, root: str | None):
    def write(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        state, seen = _state_before(spark, work, epoch), F.unix_millis("seen")
        columns = [F.lit(False).alias("known"), "path", "length", "modified", "content_hash", "doc_id", seen.alias("seen_ms"),
                   F.monotonically_increasing_id().alias("nr")]
        rows = batch
        if state is not None:  # an earlier poll that comes late says nothing new
            rows = batch.filter(seen > state.filter(F.col("path") == _BEAT).agg(F.max("seen_ms")).first()[0])
        now = rows.filter(F.col("path") == _BEAT).agg(F.max(seen)).first()[0]
        if now is None:
            return
        rows = rows.select(*columns)
        if state is not None:
            rows = rows.unionByName(state.withColumns({"known": F.lit(True), "nr": F.lit(0).cast("long")}))
        (rows.repartition("path").sortWithinPartitions("path", F.col("known").desc(), "seen_ms", "nr").drop("nr")
         .mapInArrow(Watcher(root, now), _WRITTEN)
         # one folder per batch: a batch that is run again rewrites its own
         .write.mode("overwrite").partitionBy("kind").parquet(os.path.join(work, f"batch={epoch}")))
    return write


def follow(spark: SparkSession, folder: str, root: str | None = None) -> DataFrame:
    """Work off the polls that wait below ``folder``; all events so far (``EVENTS``).

    ``root`` is the tree, for rows without hashes. Handled polls but the
    latest are removed: the state has what they said.
    """
    polls, work, checkpoint = (os.path.join(folder, n) for n in ("polls", "batches", "checkpoint"))
    if list_names(spark, os.path.join(checkpoint, "state")):
        raise ValueError(f"{folder} has its state in Spark's state store, as an earlier version left it; start with a new folder")
    (spark.readStream.schema(LISTING).parquet(os.path.join(polls, "poll-*"))
     .writeStream.foreachBatch(_work_off(work, root)).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    for name in sorted(n for n in list_names(spark, polls) if n.startswith("poll-"))[:-1]:
        delete_path(spark, os.path.join(polls, name))
    written = spark.read.schema(T.StructType([*EVENTS.fields, T.StructField("kind", T.StringType())])).parquet(work)
    return written.filter(F.col("kind") == _EVENT).select(*EVENTS.fieldNames())


def poll(spark: SparkSession, root: str, folder: str, now_ms: int, glob: str = PDF_GLOB) -> DataFrame:
    """List the tree and return the events of this poll, moves paired (see :func:`with_moves`)."""
    write_poll(list_tree(spark, root, glob), folder, now_ms)
    return with_moves(follow(spark, folder, root).filter(F.col("seen_ms") == now_ms))


def with_moves(events: DataFrame) -> DataFrame:
    """``EVENTS`` with ``old_path``: a deleted and a new file of one poll and one content are a move.

    Of several such files the n-th deleted and the n-th new path belong
    together, numbered over range partitions, so a content that many files
    share goes to no single task. Only events are read.
    """
    key = ["seen_ms", "_hash"]
    gone = row_number_within(events.filter(F.col("event") == DELETED).withColumn("_hash", F.col("old_content_hash")), key, "path")
    come = row_number_within(events.filter(F.col("event") == NEW).withColumn("_hash", F.col("content_hash")), key, "path")
    gone = gone.select(*key, "rn", F.col("path").alias("old_path"), F.col("old_content_hash").alias("_oc"),
                       F.col("old_doc_id").alias("_od"))
    both = come.join(gone, [*key, "rn"], "full_outer")
    moved = F.col("path").isNotNull() & F.col("old_path").isNotNull()
    paired = both.select(
        F.coalesce("path", "old_path").alias("path"),
        F.when(moved, MOVED).when(F.col("path").isNull(), DELETED).otherwise(NEW).alias("event"),
        "content_hash", "doc_id", F.col("_oc").alias("old_content_hash"), F.col("_od").alias("old_doc_id"),
        "seen_ms", "error", F.when(moved, F.col("old_path")).alias("old_path"))
    rest = events.filter(~F.col("event").isin(NEW, DELETED)).withColumn("old_path", F.lit(None).cast("string"))
    return rest.unionByName(paired)


def register_events(registry: DataFrame, events: DataFrame, now) -> DataFrame:
    """The registry after the events of one poll (as :func:`poll` gives them)."""
    known = events.filter(F.col("event") != ERROR).select(
        F.col("event").alias("change"), "path", "doc_id", "content_hash", "old_doc_id")
    # a file that comes back has its row already, which becomes ACTIVE again
    back = known.filter(F.col("change").isin(NEW, MOVED)).withColumn("change", F.lit("RESURRECTED")) \
        .withColumn("old_doc_id", F.lit(None).cast("string"))
    return apply_changes_strict(registry, known.unionByName(back), now)
