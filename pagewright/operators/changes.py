"""Change detection between a file scan and the document registry.

``scan``: ``path, content_hash, doc_id`` (one row per path).
``registry``: ``doc_id, path, content_hash, status, created_at``.

All classes come from equi-joins on ``path`` or ``content_hash``. Before a
hash is used as a join key its side is reduced to one row per hash
(``groupBy`` with partial aggregation, or ``distinct``), so a hash shared by
millions of files cannot multiply rows; the remaining per-key skew on the
large side is split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.registry import registry_snapshot

NEW, MOVED, DELETED, UNCHANGED = "new", "moved", "deleted", "unchanged"

_OUT = ["change", "path", "old_path", "doc_id", "content_hash"]


def _scan(scan: DataFrame) -> DataFrame:
    return scan.select("path", "doc_id", "content_hash")


def hash_holders(snapshot: DataFrame) -> DataFrame:
    """One row per non-empty registry hash with the path a move starts from.

    The reference keeps whichever holder its dict saw last; we fix the tie
    to the greatest path.
    """
    return (snapshot.filter(F.col("content_hash") != "")
            .groupBy("content_hash").agg(F.max("path").alias("old_path")))


def new_documents(scan: DataFrame, registry: DataFrame) -> DataFrame:
    """Scanned files whose doc id is not registered in any status.

    ``left_anti``, never ``NOT IN``: one NULL id would empty ``NOT IN``.
    """
    known = registry.select("doc_id")
    return _scan(scan).join(known, "doc_id", "left_anti").select("path", "doc_id", "content_hash")


def changes_new(scan: DataFrame, registry: DataFrame) -> DataFrame:
    """Path not in the registry and content not in the registry."""
    snap = registry_snapshot(registry)
    holders = hash_holders(snap)
    fresh = _scan(scan).join(snap.select("path"), "path", "left_anti")
    return fresh.join(holders.select("content_hash"), "content_hash", "left_anti") \
        .select("path", "doc_id", "content_hash")


def changes_moved(scan: DataFrame, registry: DataFrame) -> DataFrame:
    """D3: path not in the registry, content held by a registered path."""
    snap = registry_snapshot(registry)
    holders = hash_holders(snap)
    fresh = _scan(scan).join(snap.select("path"), "path", "left_anti")
    return fresh.join(holders, "content_hash", "inner") \
        .select("old_path", F.col("path").alias("new_path"), "content_hash", "doc_id")


def changes_deleted(scan: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered path gone, hash non-empty and found nowhere in the scan."""
    snap = registry_snapshot(registry)
    gone = snap.filter(F.col("content_hash") != "").join(scan.select("path"), "path", "left_anti")
    present = scan.select("content_hash").distinct()
    return gone.join(present, "content_hash", "left_anti").select("path", "doc_id", "content_hash")


def changes_unchanged(scan: DataFrame, registry: DataFrame) -> DataFrame:
    """Path in both; content is not compared (see D10 for MODIFIED)."""
    snap = registry_snapshot(registry)
    return _scan(scan).join(snap.select("path"), "path", "left_semi") \
        .select("path", "doc_id", "content_hash")


def detect_changes(scan: DataFrame, registry: DataFrame) -> DataFrame:
    """All four classes.

    Output ``change, path, old_path, doc_id, content_hash``. Paths are
    settled first; only scan rows with an unknown path and registry rows
    whose path is gone look their content up, so no join key is NULL. Scan
    and snapshot are shuffled by path once for all three path joins (Spark
    reuses the exchanges). Registry paths that vanished while their content
    lives on elsewhere, or whose hash is empty, get no class, as in the
    reference (D10 names them).
    """
    snap = registry_snapshot(registry)
    s, r = _scan(scan), snap.select("path", "doc_id", "content_hash")
    none = F.lit(None).cast("string")
    same = s.join(r.select("path"), "path", "left_semi").select(
        F.lit(UNCHANGED).alias("change"), "path", none.alias("old_path"), "doc_id", "content_hash")
    fresh = s.join(r.select("path"), "path", "left_anti").join(hash_holders(snap), "content_hash", "left").select(
        F.when(F.col("old_path").isNull(), F.lit(NEW)).otherwise(F.lit(MOVED)).alias("change"),
        "path", "old_path", "doc_id", "content_hash")
    gone = (r.filter(F.col("content_hash") != "").join(s.select("path"), "path", "left_anti")
            .join(s.select("content_hash").distinct(), "content_hash", "left_anti")
            .select(F.lit(DELETED).alias("change"), "path", none.alias("old_path"), "doc_id", "content_hash"))
    return same.unionByName(fresh).unionByName(gone)


def change_counts(changes: DataFrame) -> DataFrame:
    """Rows per class."""
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def duplicate_hashes(scan: DataFrame) -> DataFrame:
    """Files whose content occurs more than once, one row per file.

    Counted with a partial aggregation and joined back, so a hash held by a
    third of all files is never gathered into one row or one task's list.
    """
    counts = scan.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies")) \
        .filter(F.col("copies") > 1)
    return scan.select("content_hash", "path").join(counts, "content_hash", "inner")


def new_hash_counts(changes: DataFrame) -> DataFrame:
    """Number of new files and of distinct contents among them."""
    new = changes.filter(F.col("change") == NEW)
    return new.agg(F.count(F.lit(1)).alias("n_new"),
                   F.countDistinct("content_hash").alias("n_distinct_hashes"))


# ---- D10: strict classes ----------------------------------------

UNCHANGED_S, MODIFIED, RESURRECTED = "UNCHANGED", "MODIFIED", "RESURRECTED"
MOVED_S, COPIED, NEW_S = "MOVED", "COPIED", "NEW"
ERROR, ORPHANED, DELETED_S = "ERROR", "ORPHANED", "DELETED"

_STRICT_OUT = ["change", "path", "old_path", "doc_id", "old_doc_id", "content_hash"]


def detect_changes_strict(scan: DataFrame, registry: DataFrame,
                          scan_errors: DataFrame | None = None,
                          checkpoint: bool = True) -> DataFrame:
    """Every scanned path and every vanished registry path gets a class.

    Output ``change, path, old_path, doc_id, old_doc_id, content_hash``:
    ``doc_id`` is the scanned document, ``old_doc_id`` the registry document
    the change acts on (deactivated, or hash filled in for UNCHANGED).

    Plan: one full outer join of scan and snapshot on ``path``; every row is
    tagged with the facts it needs (read error, INACTIVE doc id, content held
    in the registry, content present in the scan) by three equi-joins, and
    the tagged table is written once (narrow rows, Parquet below the shared
    checkpoint folder) because every class reads it. New paths with
    held content and vacated holders are numbered by path within (side,
    hash) in one skew-safe ranking (:func:`row_number_within`) and paired by
    an aggregate on (hash, number) whose groups hold at most one row per
    side; the pairs are written too, since the ranking uses the partition id
    and Spark would otherwise compute it once per reader. ``checkpoint=False``
    writes nothing: the plan is recomputed per class, and a hash is numbered
    by one task.
    """
    from ..session import write_through
    from .rank import row_number_within

    spark = scan.sparkSession
    if scan_errors is None:
        scan_errors = spark.createDataFrame([], "path string, error string")
    err = scan_errors.select("path").distinct().withColumn("_err", F.lit(True))
    snap = registry_snapshot(registry)
    s = _scan(scan).withColumn("_in_scan", F.lit(True))
    r = snap.select("path", F.col("doc_id").alias("old_doc_id"),
                    F.col("content_hash").alias("_r_hash"), F.lit(True).alias("_in_reg"))
    full = s.join(r, "path", "full_outer").join(err, "path", "left").select(
        "path", "doc_id", "content_hash", "old_doc_id", "_r_hash",
        F.coalesce("_in_scan", F.lit(False)).alias("_in_scan"),
        F.coalesce("_in_reg", F.lit(False)).alias("_in_reg"),
        F.coalesce("_err", F.lit(False)).alias("_err"))

    # per hash: held by a registry holder, present in the scan (partial aggregate)
    facts = (full.select(F.explode(F.array(
                F.when(F.col("_in_scan"), F.struct(F.col("content_hash").alias("k"),
                                                   F.lit(True).alias("present"), F.lit(False).alias("held"))),
                F.when(F.col("_in_reg") & (F.col("_r_hash") != ""),
                       F.struct(F.col("_r_hash").alias("k"), F.lit(False).alias("present"),
                                F.lit(True).alias("held"))))).alias("f"))
             .filter(F.col("f").isNotNull())
             .groupBy(F.col("f.k").alias("_k"))
             .agg(F.bool_or("f.present").alias("_present"), F.bool_or("f.held").alias("_held")))
    inactive = registry.filter(F.col("status") == "INACTIVE").select("doc_id").distinct() \
        .withColumn("_inactive", F.lit(True))
    # a scanned row looks up its own content, a vanished row its registry content
    # vanished rows have no scanned doc id: their own path spreads them
    key = F.coalesce("doc_id", F.concat(F.lit("\x00"), "path"))
    tagged = (full.withColumn("_d", key).join(inactive.withColumnRenamed("doc_id", "_d"), "_d", "left")
              .withColumn("_k", F.coalesce("content_hash", "_r_hash"))
              .join(facts, "_k", "left")
              .select("path", "doc_id", "content_hash", "old_doc_id", "_r_hash", "_in_scan", "_in_reg",
                      "_err", F.coalesce("_inactive", F.lit(False)).alias("_inactive"),
                      F.coalesce("_held", F.lit(False)).alias("_held"),
                      F.coalesce("_present", F.lit(False)).alias("_present")))
    if checkpoint:
        tagged = write_through(tagged, "changes_tagged")
    c = F.col
    both, fresh, gone = c("_in_scan") & c("_in_reg"), c("_in_scan") & ~c("_in_reg"), ~c("_in_scan") & c("_in_reg")
    nul = F.lit(None).cast("string")
    same = (c("_r_hash") == c("content_hash")) | (c("_r_hash") == "")
    cls = (F.when(both & same, F.lit(UNCHANGED_S))
           .when(both, F.lit(MODIFIED))
           .when(fresh & c("_inactive"), F.lit(RESURRECTED))
           .when(fresh & c("_held"), F.lit("_CAND"))
           .when(fresh, F.lit(NEW_S))
           .when(gone & c("_err"), F.lit(ERROR))
           .when(gone & (c("_r_hash") == ""), F.lit(DELETED_S))
           .when(gone, F.lit("_VAC")))
    t = tagged.withColumn("change", cls)
    settled = t.filter(~c("change").isin("_CAND", "_VAC")).select(
        "change", "path", nul.alias("old_path"), "doc_id",
        F.when(c("_in_reg"), c("old_doc_id")).alias("old_doc_id"),
        F.coalesce("content_hash", "_r_hash").alias("content_hash"))

    # ranking sides: candidates, and holders whose path lost that content
    # (vanished, or now holding other content: those are MODIFIED above)
    vacated = c("_in_reg") & ~c("_err") & (c("_r_hash") != "") & \
        (~c("_in_scan") | (c("_r_hash") != c("content_hash")))
    sides = t.filter((c("change") == "_CAND") | vacated).select(
        F.when(c("change") == "_CAND", F.lit("c")).otherwise(F.lit("v")).alias("_side"),
        F.when(c("change") == "_CAND", c("content_hash")).otherwise(c("_r_hash")).alias("content_hash"),
        "path",
        F.when(c("change") == "_CAND", c("doc_id")).otherwise(c("old_doc_id")).alias("doc_id"),
        (~c("_in_scan")).alias("_gone"), "_present")
    ranked = row_number_within(sides, ["_side", "content_hash"], "path", write=checkpoint)
    row = F.struct("path", "doc_id", "_gone", "_present")
    pairs = ranked.groupBy("content_hash", "rn").agg(
        F.max_by(row, F.when(c("_side") == "c", F.lit(1))).alias("c"),
        F.max_by(row, F.when(c("_side") == "v", F.lit(1))).alias("v"))
    if checkpoint:
        pairs = write_through(pairs, "changes_pairs")
    moved = pairs.filter(c("c").isNotNull()).select(
        F.when(c("v").isNotNull(), F.lit(MOVED_S)).otherwise(F.lit(COPIED)).alias("change"),
        c("c.path").alias("path"), c("v.path").alias("old_path"),
        c("c.doc_id").alias("doc_id"), c("v.doc_id").alias("old_doc_id"), "content_hash")
    unpaired = pairs.filter(c("c").isNull() & c("v._gone")).select(
        F.when(c("v._present"), F.lit(ORPHANED)).otherwise(F.lit(DELETED_S)).alias("change"),
        c("v.path").alias("path"), nul.alias("old_path"), nul.alias("doc_id"),
        c("v.doc_id").alias("old_doc_id"), "content_hash")
    return settled.unionByName(moved).unionByName(unpaired)
