"""Registry lookups in bulk (Q1-Q5, Q7, Q8).

The reference asks one key at a time; here each lookup is a join of a key
set against the registry, so it runs once for all keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE


def all_doc_ids(registry: DataFrame) -> DataFrame:
    """Q1: every registered doc id, any status."""
    return registry.select("doc_id").distinct()


def exists_document(keys: DataFrame, registry: DataFrame) -> DataFrame:
    """Q2: ``keys`` with ``exists`` telling whether the doc id is registered."""
    known = registry.select("doc_id").distinct().withColumn("_hit", F.lit(True))
    return keys.join(known, "doc_id", "left") \
        .withColumn("exists", F.coalesce("_hit", F.lit(False))).drop("_hit")


def docs_by_content_hash(hashes: DataFrame, registry: DataFrame) -> DataFrame:
    """Q3: ACTIVE documents holding each requested content hash."""
    want = hashes.select("content_hash").distinct()
    act = registry.filter(F.col("status") == ACTIVE).select("content_hash", "doc_id", "path")
    return act.join(want, "content_hash", "left_semi")


def doc_id_by_content_hash(registry: DataFrame) -> DataFrame:
    """Q4: one ACTIVE doc id per non-empty hash; ties fixed to the least id."""
    act = registry.filter((F.col("status") == ACTIVE) & (F.col("content_hash") != ""))
    return act.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"))


def active_doc_ids(registry: DataFrame) -> DataFrame:
    """Q5: ACTIVE doc ids, e.g. as the semi-join side of a search filter."""
    return registry.filter(F.col("status") == ACTIVE).select("doc_id")


def document_pages(registry: DataFrame, pages: DataFrame) -> DataFrame:
    """Q8: each page with its document's path and status (inner join)."""
    docs = registry.select("doc_id", F.col("path").alias("doc_path"),
                           F.col("status").alias("doc_status"))
    return pages.select("page_id", "doc_id", "page_number").join(docs, "doc_id", "inner")
