"""Skew-safe ``row_number()`` within a group.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sends each group to one
task, so a group holding a third of all rows becomes one straggler. Here
the rows are range-partitioned on ``(g, k)`` instead: a large group spans
several contiguous partitions. Each (partition, group) piece is numbered
locally (pieces are bounded by the partition size), the piece sizes are
counted (one small row per piece) and turned into offsets with a running
sum per group, and the offset is added back with an equi-join on
``(g, partition)``. Ties in ``k`` must not occur (``k`` unique in ``g``).
The numbered pieces are written once below the checkpoint folder, since
range partitioning is not guaranteed to repeat itself across evaluations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_through


def row_number_within(df: DataFrame, group, order: str, out: str = "rn",
                      partitions: int | None = None, write: bool = True) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)``, skew-safe.

    ``group``: a column name or a list of them. ``write=False`` writes
    nothing and uses the plain window instead, one task per group.
    """
    spark = df.sparkSession
    g = [group] if isinstance(group, str) else list(group)
    if not write:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*g).orderBy(order)).cast("long"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(c) for c in g + [order]]) \
        .withColumn("_pid", F.spark_partition_id())
    local = ranged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("_pid", *g).orderBy(order)))
    # Range bounds come from sampling, and Spark re-samples imbalanced inputs
    # with a seed taken from the RDD id: two evaluations of ``ranged`` may
    # put a row in different partitions. The numbered rows are therefore
    # written once and both the piece counts and the final join read them.
    local = write_through(local, "rank_local")
    pieces = local.groupBy(*g, "_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))) \
        .select(*g, "_pid", "_off")
    return local.join(offsets, g + ["_pid"], "inner") \
        .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long")) \
        .drop("_pid", "_lrn", "_off")
