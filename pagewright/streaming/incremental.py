"""P10 incremental ingest with Structured Streaming.

The reference re-lists the whole bucket on every poll and keeps only files
whose hash it has not seen. Here a file stream source remembers which files
it has already processed (in the checkpoint), so each trigger reads only
new files; ``trigger(availableNow=True)`` processes everything pending and
stops, which is the batch-style "poll" of the reference. Each micro-batch is
hashed and registered with a keyed anti-join (U1) against the rows of all
other micro-batches, so a batch replayed after a failure writes the same rows
again. The source remembers files by path: an edited file is seen by
:func:`poll_tree`, which compares paths, lengths and modification times.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import content_hash, doc_hash
from ..operators.mutations import new_document_rows
from ..schemas import DOCUMENTS_STATE
from ..sources.files import PDF_GLOB, scan_tree_incremental

# schema of Spark's binaryFile source (streams need it up front)
_BY_EPOCH = T.StructType(DOCUMENTS_STATE.fields + [T.StructField("epoch", T.LongType())])
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _register_batch(registry_path: str, now):
    def write(batch: DataFrame, epoch_id: int):
        spark = batch.sparkSession
        scanned = batch.select(doc_hash("content", "path").alias("doc_id"), "path",
                               content_hash("content").alias("content_hash"))
        # a replayed epoch must not find its own first attempt
        current = (spark.read.schema(_BY_EPOCH).parquet(registry_path)
                   .filter(F.col("epoch") != epoch_id).drop("epoch"))
        fresh = new_document_rows(current, scanned, now)
        # one folder per epoch: a replayed epoch rewrites its own folder
        fresh.write.mode("overwrite").parquet(os.path.join(registry_path, f"epoch={epoch_id}"))
    return write


def ingest_files(spark: SparkSession, source: DataFrame, registry_path: str,
                 checkpoint: str, now) -> DataFrame:
    """Run the stream ``source`` (``path, content``) until it is drained and
    return the registry table (earlier rows plus one folder per epoch)."""
    if not _exists(spark, registry_path):
        spark.createDataFrame([], DOCUMENTS_STATE).write.parquet(os.path.join(registry_path, "epoch=-1"))
    q = (source.writeStream.foreachBatch(_register_batch(registry_path, now))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(registry_path).select(*DOCUMENTS_STATE.fieldNames())


def compact_registry(spark: SparkSession, registry_path: str, out_path: str) -> DataFrame:
    """All epochs as one table at ``out_path`` (a new folder; start the next stream on it)."""
    rows = spark.read.schema(_BY_EPOCH).parquet(registry_path).drop("epoch")
    rows.write.parquet(os.path.join(out_path, "epoch=-1"))
    return spark.read.parquet(out_path).select(*DOCUMENTS_STATE.fieldNames())


def poll_tree(spark: SparkSession, root: str, registry: DataFrame, previous: DataFrame | None,
              now, glob: str = PDF_GLOB) -> tuple[DataFrame, DataFrame]:
    """``(scan, new registry rows)`` of a tree in which files may be edited in place.

    Only files whose (path, length, modificationTime) isn't in ``previous``
    are read. An edited file has a new doc id and so a new row.
    """
    scan = scan_tree_incremental(spark, root, previous, glob=glob)
    return scan, new_document_rows(registry, scan.filter(F.col("error").isNull()), now)


def binary_file_stream(spark: SparkSession, root: str, glob: str = PDF_GLOB) -> DataFrame:
    """New files below ``root`` as ``path, content`` (paths relative to root)."""
    s = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
         .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
         .load(root))
    rel = F.regexp_extract("path", r"^.*?\Q" + root.rstrip("/") + r"\E/(.*)$", 1)
    return s.select(rel.alias("path"), "content")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
