"""S9 mirror: what a one-way sync of a source tree to a target would do, and doing it.

The reference shells out to a single-machine rsync tool (dry run, then the
real run). Here the plan is a full outer join of the two manifests on path:
COPY (source only), UPDATE (both, content differs), DELETE (target only,
unmatched objects are removed), SKIP (same content) and ERROR (the source
could not be read: the target stays). :func:`apply_mirror` carries a plan out
in tasks, a row per file; counting a plan is one aggregate.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import copy_file, inside, store_of

COPY, UPDATE, DELETE, SKIP, ERROR = "COPY", "UPDATE", "DELETE", "SKIP", "ERROR"


def mirror_plan(source: DataFrame, target: DataFrame, scan_errors: DataFrame | None = None) -> DataFrame:
    """``source``/``target``: ``path, content_hash``; ``scan_errors``: ``path``
    of unreadable sources. Output ``path, action``.

    Presence is the row, not the hash: a NULL hash is present and equals only NULL.
    """
    s = source.select("path", F.col("content_hash").alias("_s"), F.lit(False).alias("_bad"))
    if scan_errors is not None:
        bad = scan_errors.select("path", F.lit(None).cast("string").alias("_s"), F.lit(True).alias("_bad"))
        s = s.join(bad.select("path"), "path", "left_anti").unionByName(bad.distinct())
    s = s.withColumn("_in_s", F.lit(True))
    t = target.select("path", F.col("content_hash").alias("_t"), F.lit(True).alias("_in_t"))
    j = s.join(t, "path", "full_outer")
    action = (F.when(F.col("_bad"), F.lit(ERROR))
              .when(F.col("_in_t").isNull(), F.lit(COPY))
              .when(F.col("_in_s").isNull(), F.lit(DELETE))
              .when(~F.col("_s").eqNullSafe(F.col("_t")), F.lit(UPDATE))
              .otherwise(F.lit(SKIP)))
    return j.select("path", action.alias("action"))


def mirror_plan_counts(plan: DataFrame) -> DataFrame:
    """Rows per action; a plan with only SKIP means nothing to apply."""
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


DONE, FAILED = "DONE", "FAILED"


def apply_mirror(plan: DataFrame, source_root: str, target_root: str, out: str,
                 hashes: DataFrame | None = None, max_concurrency: int | None = None) -> DataFrame:
    """Carry out ``plan`` (``path, action``); the outcome of each file is a row, written to ``out``.

    Tasks copy a file chunk by chunk under a hidden name beside its target
    and rename it when it is whole, so a reader never sees half a file and a
    lost executor leaves the old one. ``hashes`` (``path, content_hash``, such
    as the scan that the plan was made from) makes a copy of other content
    fail and a target that has the content already count as done. Applying
    a plan twice gives the same tree as applying it once; a failed file is a
    row and stops no other. SKIP and ERROR rows need no work and have no row.

    Output ``path, action, status, bytes, error``. ``max_concurrency`` caps
    the tasks that copy at once.
    """
    todo = plan.filter(F.col("action").isin(COPY, UPDATE, DELETE)).select("path", "action")
    known = F.lit(None).cast("string")
    todo = (todo.withColumn("content_hash", known) if hashes is None
            else todo.join(hashes.select("path", "content_hash"), "path", "left"))

    def one(source, target, path, action, expected, attempt) -> int:
        (from_fs, from_base), (to_fs, to_base) = source, target
        place = f"{to_base}/{inside(path)}"
        if action != DELETE:
            folder, _, name = place.rpartition("/")
            return copy_file(from_fs, f"{from_base}/{path}", to_fs, place, f"{folder}/.{name}.{attempt}.part", expected)
        if to_fs.get_file_info(place).type == pafs.FileType.File:
            to_fs.delete_file(place)
        return 0

    def run(batches):
        source, target = store_of(source_root), store_of(target_root)
        attempt = TaskContext.get().attemptNumber()
        for b in batches:
            for path, action, expected in zip(*(b.column(i).to_pylist() for i in range(3))):
                try:
                    status, n, error = DONE, one(source, target, path, action, expected, attempt), None
                except Exception as e:  # noqa: BLE001 - errors become values
                    status, n, error = FAILED, None, f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([action]), pa.array([status]), pa.array([n], pa.int64()),
                     pa.array([error], pa.string())], ["path", "action", "status", "bytes", "error"])

    spark = plan.sparkSession
    tasks = max_concurrency or 4 * spark.sparkContext.defaultParallelism
    # side effects happen once, where the outcome is written
    (todo.repartition(tasks).mapInArrow(run, "path string, action string, status string, bytes long, error string")
     .write.mode("overwrite").parquet(out))
    return spark.read.parquet(out)
