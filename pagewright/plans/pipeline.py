"""Whole runs as chains of Spark jobs (P7 pipeline, U11 sync).

Every step that is read more than once, or that calls a plug-in, is written
as a table below ``<spark.checkpoint.dir>/pagewright/<run id>/`` and read
back. That cuts the lineage (a lost executor recomputes from the last
written table, not from the raw files), keeps a model from being called
twice by a later action, and makes each step's output keyed and
idempotent: re-running a step rewrites the same folder.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as D
from ..operators import embed as EM
from ..operators import extract as EX
from ..operators import index as IX
from ..operators import mirror as MR
from ..operators import mutations as U
from ..operators import pages as PG
from ..operators import queues as W
from ..operators import situate as SI
from ..operators import stats as A
from ..schemas import ACTIVE, COMPLETED, FAILED, RUN_LOG, RUNNING, STAGES, SUCCESS
from ..session import drop_temporary, new_run_id, temporary_count, work_path
from ..sources.files import read_tree, scan_tree, scan_with_errors
from ..sources.index_sink import IndexClient, write_index
from .manifest import Manifest, fingerprint, fingerprint_of, of_files


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` (Parquet, replaced if present) and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a Parquet table bucketed by ``key`` at ``path``.

    Joins of two such tables on ``key`` need no shuffle, and a join with an
    unbucketed side shuffles only that side into the same buckets: the
    large page state stays in place while the (smaller) patches move.
    """
    # Rows are hash-partitioned by the bucket key first, so every task holds
    # one bucket and writes one file (unaligned input would write up to
    # tasks x buckets files). Spark drops this shuffle when the input is
    # already partitioned that way, e.g. the output of a bucketed join.
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    spark = df.sparkSession
    (spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1)
     .write.mode("overwrite").parquet(_layout_path(path)))
    return spark.table(table)


def open_bucketed(spark: SparkSession, path: str, key: str = "page_id",
                  buckets: int | None = None, table: str | None = None) -> DataFrame:
    """Read a page-keyed table written by an earlier run *as bucketed*.

    A plain ``read.parquet`` forgets the bucketing, so the next run's first
    join would shuffle the whole state. Registering an external table over
    the same files with its bucket spec (no data is rewritten) lets joins on
    ``key`` use the existing layout. The key and the bucket count are those
    that were stored when the table was written; a different ``key`` or
    ``buckets`` is an error, since joins would silently lose rows.
    """
    layout = spark.read.parquet(_layout_path(path)).first()
    if key != layout["key"] or buckets not in (None, layout["buckets"]):
        raise ValueError(f"{path} has {layout['buckets']} buckets of {layout['key']}, not {buckets} of {key}")
    name = table or f"pw_prev_{new_run_id()}"
    quoted = lambda x: "`" + x.replace("`", "``") + "`"
    cols = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {quoted(name)} ({cols}) USING parquet CLUSTERED BY ({quoted(key)}) "
              f"SORTED BY ({quoted(key)}) INTO {layout['buckets']} BUCKETS LOCATION '{place}'")
    return spark.table(quoted(name))


def _layout_path(path: str) -> str:
    return path.rstrip("/") + "-layout"


@dataclass
class RunContext:
    spark: SparkSession
    root: str
    now: object
    tables: dict = field(default_factory=dict)

    run_id: str = ""
    buckets: int = 0
    events: list = field(default_factory=list)
    entries: list = field(default_factory=list)
    #: Markers of a run that can be started again, None for one that can't.
    manifest: Manifest | None = None
    #: Fingerprints of inputs and tables by name, and the tables read back from an earlier attempt.
    prints: dict = field(default_factory=dict)
    reused: list = field(default_factory=list)

    @classmethod
    def create(cls, spark: SparkSession, now, run_id: str | None = None,
               fallback_dir: str | None = None, buckets: int | None = None):
        """A new run or, if a run ``run_id`` was started before, its continuation.

        A continued run keeps the first attempt's ``now`` and bucket count.
        Runs without a ``run_id`` get one and can't be continued; they take no
        fingerprints.
        """
        rid = run_id or new_run_id()
        root = work_path(spark, rid, fallback=fallback_dir)
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if run_id is None:
            return cls(spark, root, now, run_id=rid, buckets=n)
        manifest = Manifest(spark, root)
        set_up = manifest.settings()
        if set_up is None:
            at = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
            set_up = {"now": spark.range(1).select(at.cast("string")).first()[0], "buckets": n}
            manifest.set_up(set_up)
        ctx = cls(spark, root, F.lit(set_up["now"]).cast("timestamp_ntz"), run_id=rid, buckets=set_up["buckets"],
                  manifest=manifest)
        ctx.events = [(*e[:3], dt.datetime.fromisoformat(e[3]), *e[4:]) for e in manifest.events()]
        return ctx

    def input(self, name: str, df: DataFrame | None, columns: list[str] | None = None) -> None:
        """Take the fingerprint of an input table that stages name in ``uses``."""
        if self.manifest is None:
            return
        if df is None:
            self.prints[name] = fingerprint_of("none")
        else:
            self.prints[name] = of_files(df) if name == "files" else fingerprint(df, columns)

    def stage(self, name: str, make, uses=(), params=None) -> DataFrame:
        """The table ``name``: read back if it was made before from equal ``uses``
        with equal ``params``, else written from ``make()`` and marked whole."""
        if self.manifest is None:
            return self.save(name, make())
        mine = self.prints[name] = fingerprint_of(name, params, [self.prints[u] for u in uses])
        if self.manifest.committed(name) == mine:
            self.reused.append(name)
            out = self.tables[name] = self.spark.read.parquet(os.path.join(self.root, name))
            return out
        self.manifest.drop(name)
        out = self.save(name, make())
        self.manifest.commit(name, mine)
        return out

    def save(self, name: str, df: DataFrame, bucket_by: str | None = None) -> DataFrame:
        path = os.path.join(self.root, name)
        if bucket_by:
            entry = f"pw_{self.run_id}_{name}"
            out = materialize_bucketed(df, path, entry, bucket_by, self.buckets)
            self.entries.append(entry)
        else:
            out = materialize(df, path)
        self.tables[name] = out
        return out

    def close(self):
        """Drop the run's catalog entries; its files stay, see :func:`open_bucketed`."""
        while self.entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.entries.pop()}")

    def log(self, status: str, stage: str | None = None, error: str | None = None,
            total: int | None = None, processed: int | None = None):
        """Append a run event (a handful per run, kept on the driver)."""
        ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        event = (len(self.events) + 1, status, stage, ts, total, processed, error)
        self.events.append(event)
        if self.manifest:
            self.manifest.append(event[0], [*event[:3], ts.isoformat(), *event[4:]])

    def run_log(self) -> DataFrame:
        return self.save("run_log", self.spark.createDataFrame(self.events, RUN_LOG))


def sync(ctx: RunContext, files: DataFrame | None, registry: DataFrame, pages: DataFrame,
         target: DataFrame | None = None, scan_errors: DataFrame | None = None,
         mode: str = "strict", scan: DataFrame | None = None) -> dict:
    """Mirror plan, detect, apply, page sync and statistics, in order.

    ``files``: the current tree as ``path, content`` (the bytes are hashed
    once and dropped). ``target``: ``path, content_hash`` of the mirror
    target, if a mirror plan is wanted. ``mode``: ``strict`` (D10) or
    ``compat`` (D6 and the reference's actions). ``scan``: a scan computed
    elsewhere (``path, content_hash, doc_id, length``), e.g. by
    ``scan_tree_incremental``, which re-reads only changed files; ``files``
    is then not read here.
    """
    out = {}
    ctx.input("registry_before", registry)
    ctx.input("pages_before", pages, [*PageState.STATUS, "updated_at"])
    ctx.input("scan_errors", scan_errors)
    # one pass over the bytes; unreadable files (NULL content) become scan
    # errors, not deletions
    if scan is None:
        ctx.input("files", files)
        scanned = ctx.stage("scan_all", lambda: scan_with_errors(files), ["files"])
    else:
        ctx.input("scan", scan)
        err = F.col("error") if "error" in scan.columns else F.lit(None).cast("string")
        scanned = ctx.stage("scan_all", lambda: scan.select("path", "content_hash", "doc_id", "length",
                                                            err.alias("error")), ["scan"])
    own_errors = scanned.filter(F.col("error").isNotNull()).select("path", "error")
    scan_errors = own_errors if scan_errors is None else own_errors.unionByName(scan_errors.select("path", "error"))
    scan = scanned.filter(F.col("error").isNull()).drop("error").join(scan_errors.select("path"), "path", "left_anti")
    if target is not None:
        ctx.input("target", target)
        plan = ctx.stage("mirror_plan", lambda: MR.mirror_plan(scan, target, scan_errors),
                         ["scan_all", "scan_errors", "target"])
        out["mirror_counts"] = MR.mirror_plan_counts(plan)
    before = temporary_count()
    if mode == "strict":
        found, apply = (lambda: D.detect_changes_strict(scan, registry, scan_errors)), U.apply_changes_strict
    elif mode == "compat":
        found, apply = (lambda: D.detect_changes(scan, registry)), U.apply_changes
    else:
        raise ValueError(f"unknown sync mode {mode}")
    changes = ctx.stage("changes", found, ["scan_all", "scan_errors", "registry_before"], mode)
    new_reg = ctx.stage("registry", lambda: apply(registry, changes, ctx.now), ["registry_before", "changes"])
    drop_temporary(ctx.spark, before)
    flips = ctx.stage("page_status_flips", lambda: U.page_status_flips(pages, new_reg, STAGES),
                      ["pages_before", "registry"])
    state = PageState(pages)
    state.patch(flips.select("page_id", F.lit(0).cast("long").alias("seq"), F.col("_new_status").alias("status"),
                             F.lit(ctx.now).cast("timestamp_ntz").alias("updated_at")
                             if not isinstance(ctx.now, Column) else ctx.now.alias("updated_at")))
    out.update(scan=scan, changes=changes, change_counts=D.change_counts(changes),
               registry=new_reg, state=state, pages=state.view(), flips=flips,
               page_status_counts=U.sync_page_status_counts(
                   flips.select(F.col("_new_status").alias("status"), F.lit(True).alias("_flip"))),
               stats=A.processing_stats(state.narrow()))
    return out


def mirror(ctx: RunContext, source_root: str, target_root: str, max_concurrency: int | None = None) -> dict:
    """S9 from tree to tree: scan both, plan, carry the plan out.

    Returns ``plan``, ``counts`` (per action) and ``outcome`` (a row per file
    that had work). Sources that can't be read are ERROR in the plan and keep
    their target. On a named run that died, finished steps are read back, and
    a copy that was done already is seen by its hash.
    """
    ctx.input("files", read_tree(ctx.spark, source_root))
    source = ctx.stage("mirror_source", lambda: scan_tree(ctx.spark, source_root), ["files"], source_root)
    ctx.input("files", read_tree(ctx.spark, target_root))
    target = ctx.stage("mirror_target", lambda: scan_tree(ctx.spark, target_root), ["files"], target_root)
    bad = F.col("error").isNotNull()
    plan = ctx.stage("mirror_plan", lambda: MR.mirror_plan(source.filter(~bad), target, source.filter(bad)),
                     ["mirror_source", "mirror_target"])
    path = os.path.join(ctx.root, "mirror_outcome")
    outcome = MR.apply_mirror(plan, source_root, target_root, path, source, max_concurrency)
    return {"plan": plan, "counts": MR.mirror_plan_counts(plan), "outcome": outcome}


class PageState:
    """The page table of earlier runs, rows registered since, and a log of patches.

    A run appends to the log and never rewrites the table: what it writes is
    as large as what changed. :meth:`open_up` writes the status columns of the
    open pages (ACTIVE, some stage not done); queues read only these, and
    :meth:`settle` writes them again after a stage, so that a stage folds no
    patches but its own. :meth:`narrow` has the status columns of all pages,
    :meth:`view` everything.
    """

    STATUS = ("page_id", "doc_id", "status", *STAGES)

    def __init__(self, base: DataFrame):
        self.base, self.log = base, None
        self.closed, self.open, self.since = None, base.select(*self.STATUS), None

    def add(self, rows: DataFrame) -> None:
        """New pages, all of them open."""
        self.base = self.base.unionByName(rows)
        self.open = self._patched(self.open, self.since).unionByName(rows.select(*self.STATUS))
        self.since = None

    def patch(self, patches: DataFrame) -> None:
        self.log = patches if self.log is None else self.log.unionByName(patches, allowMissingColumns=True)
        self.since = patches if self.since is None else self.since.unionByName(patches, allowMissingColumns=True)

    def _patched(self, base: DataFrame, log: DataFrame | None, clear_errors: bool = False) -> DataFrame:
        if log is None:
            return base
        kept = [c for c in log.columns if c == "seq" or c in base.columns]
        says = [F.col(c).isNotNull() for c in kept if c not in ("page_id", "seq", "updated_at")]
        if says and "updated_at" not in base.columns:  # patches of other columns only
            log = log.filter(reduce(Column.__or__, says))
        return U.patch_pages(base, log.select(*kept), clear_errors)

    def narrow(self) -> DataFrame:
        rows = self._patched(self.open, self.since)
        return rows if self.closed is None else self.closed.unionByName(rows)

    def open_up(self, write) -> None:
        """``write`` (a table writer) puts down the open pages; only these are patched from now on."""
        waiting = (F.col("status") == ACTIVE) & ~A.all_done()
        rows = self.narrow()
        self.closed = rows.filter(~F.coalesce(waiting, F.lit(False)))
        self.open, self.since = write(lambda: rows.filter(waiting)), None

    def settle(self, write, everywhere: bool = False) -> None:
        """``write`` puts down the open pages with the patches since the last time;
        ``everywhere`` says that closed pages may have patches, too."""
        rows = self._patched(self.open, self.since)
        if everywhere and self.closed is not None:
            self.closed = self._patched(self.closed, self.since)
        self.open, self.since = write(lambda: rows), None

    def of(self, ids: DataFrame, *columns: str) -> DataFrame:
        """``page_id`` and ``columns`` of the pages in ``ids``."""
        return self._patched(self.base.select("page_id", *columns).join(ids.select("page_id"), "page_id", "left_semi"),
                             self.log)

    def view(self, clear_errors: bool = False) -> DataFrame:
        return self._patched(self.base, self.log, clear_errors)


def run_pipeline(ctx: RunContext, files: DataFrame, registry: DataFrame, pages: DataFrame,
                 payload: DataFrame | None = None, index: DataFrame | None = None,
                 mode: str = "strict", extract_fn=None, summary_fn=None, embed_fn=None,
                 plugin_opts: dict | None = None, clear_error_on_success: bool = False,
                 scan: DataFrame | None = None, contents=None,
                 scan_errors: DataFrame | None = None, sink: IndexClient | None = None,
                 counts: DataFrame | None = None) -> dict:
    """Detect, split, extract, situate, embed, index.

    ``payload``: page objects of earlier runs (``page_id, doc_id,
    page_number, gcs_pdf_path, text``). Each stage reads its queue from the
    narrow status columns and writes its results, one row per queued page;
    they are the patches of the next stages. So text and vectors are written
    once, for changed pages only, and a model is called once per page. The
    returned ``pages``, ``payload`` and ``index`` are the earlier tables with
    the run's rows over them; :func:`compact` rewrites them when the log has
    grown. ``clear_error_on_success`` drops a page's old error text when a
    stage succeeds (the reference keeps it). ``scan`` and ``contents``
    (``paths -> path, content``, e.g. ``read_contents``) let an incremental
    run read the bytes of changed and newly split files only; ``scan_errors``
    (``path, error``) are files that the caller could not read.

    Called again on the context of a named run that failed, it reads back the
    tables of finished stages and goes on after the last of them, provided
    that the inputs are the same rows; a plug-in counts as the same while its
    module and name are. ``files`` with ``length`` and ``modificationTime``
    are compared by these and not by their bytes. ``sink`` is an index service:
    the run's index rows are staged there by tasks and published as a whole
    before any page is marked as indexed. ``counts`` are the status counts
    that the last run returned for ``pages``: this run then adds what it
    changed to them and doesn't count the whole table again.
    """
    try:
        out = _run_stages(ctx, files, registry, pages, payload, index, mode, extract_fn,
                          summary_fn, embed_fn, plugin_opts or {}, clear_error_on_success,
                          scan, contents, scan_errors, sink, counts)
    except Exception as e:
        ctx.log(FAILED, error=f"{type(e).__name__}: {e}")
        ctx.run_log()
        raise
    total = out["registry"].filter(F.col("status") == ACTIVE).count()
    ctx.log(COMPLETED, total=total, processed=total - out["open_docs"].count())
    out["run_state"] = U.run_state(ctx.run_log())
    return out


def _named(fn) -> str | None:
    return None if fn is None else f"{getattr(fn, '__module__', '')}.{getattr(fn, '__qualname__', type(fn).__qualname__)}"


def _run_stages(ctx, files, registry, pages, payload, index, mode, extract_fn, summary_fn,
                embed_fn, opts, clear_errors, scan=None, contents=None, scan_errors=None, sink=None, counts=None):
    ctx.log(RUNNING, "sync")
    s = sync(ctx, files, registry, pages, mode=mode, scan=scan, scan_errors=scan_errors)
    reg, state = s["registry"], s["state"]
    ctx.input("payload_before", payload, ["page_id", "doc_id", "page_number", "gcs_pdf_path"])
    ctx.input("index_before", index, ["page_id", "model"])

    def status(name: str, *uses: str):
        return lambda rows: ctx.stage(f"status_{name}", rows, uses)

    state.open_up(status("sync", "pages_before", "page_status_flips"))

    # split: ACTIVE documents without pages, content read once by path
    ctx.log(RUNNING, "split")

    # as short tables of their own: while they are small, the wide side stays where it is
    todo = ctx.stage("split_queue", lambda: W.queue_split(reg, state.base), ["registry", "pages_before"])

    def split_pages():
        # binary file contents are read as UTF-8 text (string input is unchanged)
        source = contents(todo.select("path")) if contents is not None else files.select("path", "content")
        docs = todo.join(source, "path", "inner") \
            .select("doc_id", "path", F.col("content").cast("string").alias("content"))
        return PG.paginate(docs)

    split = ctx.stage("split", split_pages, ["split_queue", "scan_all"])
    pay = split.select("page_id", "doc_id", "page_number", "gcs_pdf_path", "text")
    if payload is not None:
        # of earlier page objects few are replaced: every stage reads the payload, and only their ids decide
        replaced = ctx.stage("payload_replaced", lambda: payload.select("page_id").join(
            split.select("page_id"), "page_id", "left_semi").distinct(), ["split", "payload_before"])
        pay = payload.select(*pay.columns).join(replaced, "page_id", "left_anti").unionByName(pay)
    # the split queue holds documents without pages, so none is there yet
    state.add(PG.new_page_rows(split, ctx.now))

    def done(name: str, make, stage: str, value_col: str | None, seq: int, uses: list[str], fn=None):
        """Write a stage's results, which are its patches, and the status columns after them."""
        before = "status_sync" if seq == 1 else f"status_{('extract', 'summary', 'embed')[seq - 2]}"
        res = ctx.stage(f"{name}_results", make, [before, "split", "payload_before", *uses], _named(fn))
        state.patch(U.stage_patches(res, stage, value_col, seq, ctx.now))
        # of a new model's index queue, some pages were done before
        state.settle(status(name, before, "split", f"{name}_results"), everywhere=stage == "indexed" and index is not None)

    ctx.log(RUNNING, "extract")

    def extracted():
        q = W.queue(state.open, "extract").select("page_id")
        return EX.extract(q.join(pay.select("page_id", F.col("text").alias("payload")), "page_id"), extract_fn, **opts)

    done("extract", extracted, "extracted", "extracted_text", 1, [], extract_fn)

    ctx.log(RUNNING, "summary")

    def summarized():
        return SI.situate(W.queue(state.open, "summary").select("page_id"), pay, summary_fn=summary_fn, **opts)

    done("summary", summarized, "summarized", "summary", 2, [], summary_fn)

    ctx.log(RUNNING, "embed")

    def embedded():
        q = W.queue(state.open, "embed").select("page_id")
        return EM.embed(state.of(q, "summary", "extracted_text"), embed_fn, **opts)

    done("embed", embedded, "embedded", "embedding", 3, ["extract_results", "summary_results"], embed_fn)

    ctx.log(RUNNING, "index")
    made = ["status_embed", "split", "extract_results", "summary_results", "embed_results", "index_before"]
    waiting = ctx.stage("index_queue", lambda: (
        W.queue(state.open, "index") if index is None
        else W.queue_index_for_model(state.narrow(), index, EM.MODEL)).select(*PageState.STATUS), made)
    # repeated ids are rare, and seen on the short rows; only then are the wide ones sorted
    unique = not waiting.groupBy("page_id").count().filter("count > 1").limit(1).count()
    wide = state.of(waiting, *[c for c in state.base.columns if c != "page_id"])
    rows = ctx.stage("index_rows", lambda: IX.index_documents(wide, unique=unique), made)

    if sink is not None:
        def sent():
            write_index(rows, sink, ctx.run_id)
            return rows.agg(F.count(F.lit(1)).alias("n"))

        ctx.stage("index_sent", sent, ["index_rows"], type(sink).__qualname__)

    def indexed():
        # the pages with an index row have a vector; no wide row is read again
        there = rows.select("page_id", F.lit(True).alias("embedding"))
        return IX.index_results(waiting.select("page_id").distinct().join(there, "page_id", "left"))

    done("index", indexed, "indexed", None, 4, ["index_queue", "index_rows"])

    # pages that were done and only missing in this model's index
    stale = waiting.filter(F.col("indexed") == SUCCESS)
    again = stale.drop("indexed").join(ctx.tables["index_results"].select("page_id", F.col("status").alias("indexed")), "page_id")
    ctx.input("counts_before", counts)

    def counted():
        flips = s["flips"]
        return A.add_counts(
            A.status_counts(pages) if counts is None else counts,
            A.count_change(flips, flips.withColumn("status", F.col("_new_status"))),
            A.count_change(ctx.tables["status_sync"], state.open), A.count_change(stale, again))

    now = ctx.stage("status_counts", counted,
                    ["counts_before", "pages_before", "page_status_flips", "status_sync", "status_index", "index_queue", "index_results"])
    open_docs = state.open.filter((F.col("status") == ACTIVE) & ~A.all_done()).select("doc_id").union(
        again.filter(F.col("indexed") != SUCCESS).select("doc_id")).distinct()
    s.update(pages=state.view(clear_errors), payload=pay, index=IX.upsert_index(index, rows), counts=now,
             open_docs=open_docs, stats=A.processing_stats(now, "n"), complete=A.processing_complete(now, "n"))
    return s


def compact(ctx: RunContext, out: dict) -> dict:
    """The page state, payload and index of a run as new tables bucketed by
    page_id, with the patch log folded in: the one rewrite of the whole state."""
    for name in ("pages", "payload", "index"):
        out[name] = ctx.save(name, out[name], bucket_by="page_id")
    return out
