"""S8/P6 index sink: index-ready page documents keyed by ``page_id``.

``index_documents`` projects the nine fields of an index document (plus
the embedding model, since a new model means a new index). ``upsert_index``
replaces rows by ``page_id`` (anti-join + union), so writing the same batch
twice gives the same table. ``foreach_batch_writer`` hands batches to an
external client when one is configured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import pad5
from ..schemas import FAILED, SUCCESS
from .embed import MODEL


def index_documents(pages: DataFrame, model: str = MODEL, unique: bool = False) -> DataFrame:
    """Index rows for pages that have an embedding; of rows that repeat a
    page_id the latest ``updated_at`` counts (then the greatest row).
    ``unique`` says that no page_id repeats, which saves sorting wide rows."""
    pages = pages if unique else latest(pages)
    return pages.filter(F.col("embedding").isNotNull()).select(
        "page_id", "doc_id", pad5("page_number").alias("page_number"), "status",
        "gcs_path", "gcs_pdf_path", "extracted_text", "summary", "embedding",
        F.lit(model).alias("model"))


def latest(pages: DataFrame) -> DataFrame:
    """One row per page_id: the latest by ``updated_at`` where there is such a
    column, then by the text columns. No shuffle on a state bucketed by page_id."""
    order = [F.col(c).desc_nulls_last() for c in ("updated_at", "extracted_text", "summary", "doc_id") if c in pages.columns]
    if not order:
        return pages.dropDuplicates(["page_id"])
    first = F.row_number().over(Window.partitionBy("page_id").orderBy(*order))
    return pages.withColumn("_first", first).filter("_first = 1").drop("_first")


def index_results(pages: DataFrame) -> DataFrame:
    """Stage result per page: a missing embedding fails only that page."""
    ok = F.col("embedding").isNotNull()
    return pages.select(
        "page_id", F.lit(None).cast("string").alias("value"),
        F.when(ok, F.lit(None)).otherwise(F.lit("Indexing Error: no embedding")).alias("error"),
        F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"))


def upsert_index(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Replace by ``page_id``; ``rows`` hold one row per page_id (as
    :func:`index_documents` gives them)."""
    if existing is None:
        return rows
    return existing.join(rows.select("page_id"), "page_id", "left_anti").unionByName(rows)


def foreach_batch_writer(send):
    """``writeStream.foreachBatch`` callback: ``send(partition_rows)`` per partition.

    ``send`` receives an iterator of Rows; it must upsert by ``page_id`` so
    a retried batch is harmless.
    """
    def write(batch_df: DataFrame, epoch_id: int):
        batch_df.foreachPartition(send)
    return write
