"""Registry snapshot, table creation and description."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ACTIVE, TABLES


def registry_snapshot(registry: DataFrame) -> DataFrame:
    """ACTIVE documents, one per path, a missing hash read as ``""``.

    Two ACTIVE rows may share a path (an in-place edit registered by the
    detect-only path). The latest ``created_at`` wins, then the highest
    ``doc_id``. ``max_by`` aggregates partially before the shuffle, so a
    path with many versions never gathers in one task.
    """
    active = registry.filter(F.col("status") == ACTIVE)
    order = F.struct(F.col("created_at"), F.col("doc_id"))
    picked = F.struct(F.col("doc_id"), F.coalesce(F.col("content_hash"), F.lit("")).alias("h"))
    snap = active.groupBy("path").agg(F.max_by(picked, order).alias("_r"))
    return snap.select("path", F.col("_r.doc_id").alias("doc_id"),
                       F.col("_r.h").alias("content_hash"))


def initialize_tables(spark: SparkSession, root: str, names=None) -> list[str]:
    """Create each missing table as an empty Parquet table of fixed schema.

    Returns the names that were created; existing tables are left alone.
    """
    created = []
    for name in names or TABLES:
        path = os.path.join(root, name)
        if _exists(spark, path):
            continue
        spark.createDataFrame([], TABLES[name]).write.mode("errorifexists").parquet(path)
        created.append(name)
    return created


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def describe_tables(spark: SparkSession, tables: dict | None = None) -> DataFrame:
    """One row per column: table, position, name, type, nullable."""
    rows = []
    for tname, schema in (tables or TABLES).items():
        for i, f in enumerate(schema.fields, start=1):
            rows.append((tname, i, f.name, f.dataType.simpleString(), f.nullable))
    return spark.createDataFrame(
        rows, "table string, position int, column string, type string, nullable boolean")
