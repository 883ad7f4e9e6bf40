"""Registry and page-state mutations as table rewrites.

Parquet tables cannot be updated in place, so every mutation returns the
new table as a DataFrame (written by the caller to a new versioned folder).
All are joins on the table key, idempotent: applying one twice gives the
same table as applying it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE, COMPLETED, DOC_STATUSES, FAILED, INACTIVE, PATCHABLE, RUNNING

DOC_COLS = ["doc_id", "path", "content_hash", "status", "created_at", "updated_at"]


def _now(now) -> Column:
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp_ntz")


def new_document_rows(registry: DataFrame, candidates: DataFrame, now) -> DataFrame:
    """Registry rows for ``candidates`` (``doc_id, path, content_hash``) whose
    doc id is unknown: ACTIVE, with their hash in the same row."""
    return (candidates.select("doc_id", "path", "content_hash")
            .dropDuplicates(["doc_id"])
            .join(registry.select("doc_id"), "doc_id", "left_anti")
            .select("doc_id", "path", "content_hash", F.lit(ACTIVE).alias("status"),
                    _now(now).alias("created_at"), _now(now).alias("updated_at")))


def register_documents(registry: DataFrame, candidates: DataFrame, now) -> DataFrame:
    """U1+U2: the registry plus :func:`new_document_rows` (idempotent)."""
    return registry.select(*DOC_COLS).unionByName(new_document_rows(registry, candidates, now))


def set_document_status(registry: DataFrame, keys: DataFrame, status: str, now) -> DataFrame:
    """Set ``status`` on the documents in ``keys`` (``doc_id``)."""
    hit = keys.select("doc_id").distinct().withColumn("_hit", F.lit(True))
    j = registry.select(*DOC_COLS).join(hit, "doc_id", "left")
    change = F.col("_hit") & (F.col("status") != status)
    return j.select(
        "doc_id", "path", "content_hash",
        F.when(change, F.lit(status)).otherwise(F.col("status")).alias("status"),
        "created_at",
        F.when(change, _now(now)).otherwise(F.col("updated_at")).alias("updated_at"))


def apply_deleted(registry: DataFrame, deleted: DataFrame, now) -> DataFrame:
    """U3 for DELETED files: their documents become INACTIVE."""
    return set_document_status(registry, deleted, INACTIVE, now)


def move_sources(registry: DataFrame, moved: DataFrame) -> DataFrame:
    """ACTIVE documents at a move's old path with the moved content."""
    src = moved.select(F.col("old_path").alias("path"), "content_hash").distinct()
    act = registry.filter(F.col("status") == ACTIVE).select("doc_id", "path", "content_hash")
    return act.join(src, ["path", "content_hash"], "left_semi").select("doc_id")


def apply_moved(registry: DataFrame, moved: DataFrame, now) -> DataFrame:
    """U4: deactivate the old document, register the new one if absent.

    ``moved``: ``old_path, new_path, content_hash, doc_id`` (doc id of the
    new path).
    """
    off = set_document_status(registry, move_sources(registry, moved), INACTIVE, now)
    cand = moved.select("doc_id", F.col("new_path").alias("path"), "content_hash")
    return register_documents(off, cand, now)


def apply_changes(registry: DataFrame, changes: DataFrame, now) -> DataFrame:
    """U11 steps 3-5 for D6 output, in the reference's order:
    deleted, moved, new."""
    c = changes
    deleted = c.filter(F.col("change") == "deleted").select("doc_id")
    moved = c.filter(F.col("change") == "moved").select(
        "old_path", F.col("path").alias("new_path"), "content_hash", "doc_id")
    new = c.filter(F.col("change") == "new").select("doc_id", "path", "content_hash")
    r = apply_deleted(registry, deleted, now)
    r = apply_moved(r, moved, now)
    return register_documents(r, new, now)


def fold_patches(patches: DataFrame) -> DataFrame:
    """U6 helper: per page, the latest non-NULL value of every patch column.

    ``max_by(value, seq)`` over rows where the value is set: a NULL in a
    later patch leaves the earlier value, ``""`` overwrites it. Partial
    aggregation keeps the shuffle at one row per page and map task.
    """
    cols = [c for c in PATCHABLE + ("updated_at",) if c in patches.columns]
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in cols]
    stages = [c for c in ("extracted", "summarized", "embedded", "indexed") if c in patches.columns]
    if stages and "error_message" in patches.columns:
        ok = None
        for c in stages:
            t = F.col(c) == "SUCCESS"
            ok = t if ok is None else (ok | t)
        # did the latest patch report a success without an error?
        clean = F.coalesce(ok, F.lit(False)) & F.col("error_message").isNull()
        aggs.append(F.max_by(clean, F.col("seq")).alias("_clean_success"))
    return patches.groupBy("page_id").agg(*aggs)


def patch_pages(pages: DataFrame, patches: DataFrame,
                clear_error_on_success: bool = False) -> DataFrame:
    """Apply patches ``page_id, seq, <columns>`` to the page state.

    A patch for an unknown page is ignored (the reference's ``get`` finds
    nothing). With ``clear_error_on_success`` a patch that sets a stage to
    SUCCESS without an error clears ``error_message``; by default it stays,
    as in the reference.
    """
    folded = fold_patches(patches)
    pcols = [c for c in folded.columns if c not in ("page_id", "_clean_success")]
    extra = ["_clean_success"] if "_clean_success" in folded.columns else []
    f = folded.select("page_id", *[F.col(c).alias(f"_p_{c}") for c in pcols], *extra)
    j = pages.join(f, "page_id", "left")
    out = []
    for c in pages.columns:
        if c in pcols:
            v = F.coalesce(F.col(f"_p_{c}"), F.col(c))
            if c == "error_message" and clear_error_on_success and extra:
                v = F.when(F.coalesce(F.col("_clean_success"), F.lit(False)),
                           F.lit(None).cast("string")).otherwise(v)
            out.append(v.alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def stage_patches(results: DataFrame, stage: str, value_col: str | None, seq: int, now) -> DataFrame:
    """Stage results ``page_id, value, error, status`` as patch rows.

    The error text is written only when there is one (NULL is skipped by the
    fold, as in the reference), and a failed text stage writes ``""``.
    """
    cols = [F.col("page_id"), F.lit(seq).cast("long").alias("seq"),
            F.col("status").alias(stage), F.col("error").alias("error_message"),
            _now(now).alias("updated_at")]
    if value_col:
        cols.append(F.col("value").alias(value_col))
    return results.select(*cols)


def page_status_flips(pages: DataFrame, registry: DataFrame, keep: tuple = ()) -> DataFrame:
    """``page_id, _new_status`` (and ``keep``) for pages whose document status differs.

    Computed on the narrow ``(page_id, doc_id, status)`` projection, so the
    join by ``doc_id`` never moves page text or vectors.
    """
    docs = registry.select("doc_id", F.col("status").alias("_d"))
    narrow = pages.select("page_id", "doc_id", "status", *keep).join(docs, "doc_id", "inner")
    flip = (F.col("_d").isin(*DOC_STATUSES) & F.col("status").isin(*DOC_STATUSES)
            & (F.col("_d") != F.col("status")))
    kept = [c for c in ("status", *keep) if keep]
    return narrow.filter(flip).select("page_id", F.col("_d").alias("_new_status"), *kept)


def sync_page_status(pages: DataFrame, registry: DataFrame, now) -> DataFrame:
    """A page takes its document's status when both are ACTIVE/INACTIVE
    and they differ; ``updated_at`` is set on changed rows. The flips are
    applied by ``page_id`` (free on a state bucketed by page_id, a broadcast
    when few pages change)."""
    j = pages.join(page_status_flips(pages, registry), "page_id", "left")
    flip = F.col("_new_status").isNotNull()
    cols = []
    for c in pages.columns:
        if c == "status":
            cols.append(F.when(flip, F.col("_new_status")).otherwise(F.col("status")).alias("status"))
        elif c == "updated_at":
            cols.append(F.when(flip, _now(now)).otherwise(F.col("updated_at")).alias("updated_at"))
        else:
            cols.append(F.col(c))
    cols.append(flip.alias("_flip"))
    return j.select(*cols)


def sync_page_status_counts(synced: DataFrame) -> DataFrame:
    """U8: pages changed per direction by :func:`sync_page_status`."""
    return synced.agg(
        F.count_if(F.col("_flip") & (F.col("status") == INACTIVE)).alias("to_inactive"),
        F.count_if(F.col("_flip") & (F.col("status") == ACTIVE)).alias("to_active"))


def cascade_delete(pages: DataFrame, registry: DataFrame) -> DataFrame:
    """Pages whose document row is gone are removed with it."""
    return pages.join(registry.select("doc_id"), "doc_id", "left_semi")


def delete_documents(registry: DataFrame, pages: DataFrame, doc_ids: DataFrame):
    """Delete documents and, by cascade, their pages: ``(registry, pages)``."""
    ids = doc_ids.select("doc_id").distinct()
    return (registry.join(ids, "doc_id", "left_anti"), pages.join(ids, "doc_id", "left_anti"))


def run_state(run_log: DataFrame) -> DataFrame:
    """Fold run events ``id, status, stage, ts, <extra>`` to the run row.

    The status is the latest event's; the stage and extra fields the latest
    non-NULL ones; ``started_at`` the first RUNNING event (kept on later
    ones); ``completed_at`` the time of the latest COMPLETED/FAILED event if
    the run ended. One aggregate with partial combine: one row out.
    """
    extra = [c for c in run_log.columns if c not in ("id", "status", "stage", "ts")]
    latest = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("id")))
    agg = run_log.agg(
        F.max("id").alias("id"),
        F.max_by("status", "id").alias("status"),
        latest("stage").alias("stage"),
        F.min(F.when(F.col("status") == RUNNING, F.col("ts"))).alias("started_at"),
        F.max_by(F.when(F.col("status").isin(COMPLETED, FAILED), F.col("ts")), "id")
        .alias("_end"),
        *[latest(c).alias(c) for c in extra])
    return agg.filter(F.col("id").isNotNull()).select(
        "id", "status", "stage", "started_at",
        F.col("_end").alias("completed_at"), *extra)


def apply_changes_strict(registry: DataFrame, changes: DataFrame, now) -> DataFrame:
    """Actions of SURVEY 2.5.1 for :func:`detect_changes_strict` output, in
    one rewrite of the registry plus an append of new documents.

    Deactivate ``old_doc_id`` of MODIFIED, MOVED, ORPHANED and DELETED;
    activate ``doc_id`` of RESURRECTED (and of MODIFIED when it exists);
    fill the empty hash of UNCHANGED; register MODIFIED, MOVED, COPIED, NEW.
    """
    c = changes
    off = c.filter(F.col("change").isin("MODIFIED", "MOVED", "ORPHANED", "DELETED")) \
        .select(F.col("old_doc_id").alias("doc_id"), F.lit(INACTIVE).alias("_to"),
                F.lit(None).cast("string").alias("_fill"), F.lit(1).alias("_prio"))
    on = c.filter(F.col("change").isin("RESURRECTED", "MODIFIED")) \
        .select("doc_id", F.lit(ACTIVE).alias("_to"), F.lit(None).cast("string").alias("_fill"),
                F.lit(2).alias("_prio"))
    # of the unchanged documents, nearly all rows, only those without a hash
    empty = registry.filter(F.coalesce("content_hash", F.lit("")) == "").select(F.col("doc_id").alias("old_doc_id"))
    fill = c.filter(F.col("change") == "UNCHANGED").join(empty, "old_doc_id", "left_semi") \
        .select(F.col("old_doc_id").alias("doc_id"), F.lit(None).cast("string").alias("_to"),
                F.col("content_hash").alias("_fill"), F.lit(0).alias("_prio"))
    acts = off.unionByName(on).unionByName(fill).groupBy("doc_id").agg(
        F.max_by("_to", F.when(F.col("_to").isNotNull(), F.col("_prio"))).alias("_to"),
        F.max("_fill").alias("_fill"))
    j = registry.select(*DOC_COLS).join(acts, "doc_id", "left")
    new_status = F.coalesce(F.col("_to"), F.col("status"))
    new_hash = F.when((F.coalesce(F.col("content_hash"), F.lit("")) == "") & F.col("_fill").isNotNull(),
                      F.col("_fill")).otherwise(F.col("content_hash"))
    changed = (new_status != F.col("status")) | (F.coalesce(new_hash, F.lit("")) !=
                                                 F.coalesce(F.col("content_hash"), F.lit("")))
    upd = j.select("doc_id", "path", new_hash.alias("content_hash"), new_status.alias("status"),
                   "created_at",
                   F.when(changed, _now(now)).otherwise(F.col("updated_at")).alias("updated_at"))
    reg = c.filter(F.col("change").isin("MODIFIED", "MOVED", "COPIED", "NEW")) \
        .select("doc_id", "path", "content_hash")
    return register_documents(upd, reg, now)
