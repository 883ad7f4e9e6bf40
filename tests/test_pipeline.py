"""The whole run (P7/U11) on the smallest tables, twice."""

from pyspark.sql import functions as F

from pagewright.plans import pipeline as PL
from pagewright.sources import fixtures as fx

NOW = "2024-06-01 00:00:00"


def test_pipeline_runs_and_rerun_is_stable(spark, sf):
    files = fx.storage(spark, sf)
    ctx = PL.RunContext.create(spark, NOW)
    out = PL.run_pipeline(ctx, files, fx.registry_f2(spark, sf), fx.pages_f3(spark, sf),
                          payload=fx.payload(spark, sf))
    st = out["run_state"].first()
    assert st.status == "COMPLETED" and st.stage == "index" and st.started_at <= st.completed_at
    pages = out["pages"]
    # every page id is unique and every ACTIVE document has pages
    assert pages.select("page_id").distinct().count() == pages.count()
    assert out["registry"].filter("status = 'ACTIVE'").join(pages, "doc_id", "left_anti").count() == 0
    # every index row is an ACTIVE page whose indexing succeeded (pages the
    # fixture marks as indexed by earlier runs live in an index not given here)
    ok = pages.filter("status = 'ACTIVE' AND indexed = 'SUCCESS'").select("page_id")
    idx = out["index"].select("page_id")
    assert idx.count() > 0 and idx.subtract(ok).count() == 0
    assert out["index"].filter(F.col("embedding").isNull()).count() == 0

    ctx2 = PL.RunContext.create(spark, NOW)
    out2 = PL.run_pipeline(ctx2, files, out["registry"], pages, payload=out["payload"],
                           index=out["index"])
    assert {r.change for r in out2["changes"].collect()} == {"UNCHANGED"}
    assert ctx2.tables["split"].count() == 0
    # pages that earlier runs indexed elsewhere are missing in this index and come back
    ids, ids2 = ({r.page_id for r in o["index"].select("page_id").collect()} for o in (out, out2))
    embedded = {r.page_id for r in out2["pages"].filter("status = 'ACTIVE' AND embedding IS NOT NULL").select("page_id").collect()}
    assert ids <= ids2 <= embedded and out2["index"].count() == len(ids2)
    assert out2["registry"].count() == out["registry"].count()


def test_pipeline_with_failing_embed_plugin(spark, sf):
    """A model that fails on some pages fails only those pages; the run completes."""
    def embed_fn(pdf):
        import pandas as pd
        bad = pdf["text"].str.contains("é", regex=False)
        if bad.any() and len(pdf) == 1:
            raise RuntimeError("model rejected the page")
        if bad.any():
            raise RuntimeError("batch rejected")
        return pd.DataFrame({"page_id": pdf["page_id"], "value": [[0.5, 0.5]] * len(pdf), "error": None})

    ctx = PL.RunContext.create(spark, NOW)
    out = PL.run_pipeline(ctx, fx.storage(spark, sf), fx.registry_f2(spark, sf), fx.pages_f3(spark, sf),
                          payload=fx.payload(spark, sf), embed_fn=embed_fn)
    assert out["run_state"].first().status == "COMPLETED"
    res = {r.page_id: r for r in ctx.tables["embed_results"].collect()}
    failed = [r for r in res.values() if r.status == "FAILED"]
    ok = [r for r in res.values() if r.status == "SUCCESS"]
    assert failed and ok
    assert all("rejected" in r.error or "empty" in r.error for r in failed)
    assert all(list(r.value) == [0.5, 0.5] for r in ok)
    idx = {r.page_id for r in out["index"].select("page_id").collect()}
    assert not idx & {r.page_id for r in failed}


def test_sync_keeps_unreadable_files_registered(spark):
    import hashlib
    ts = __import__("datetime").datetime(2024, 1, 1)
    reg = spark.createDataFrame(
        [(hashlib.sha256(b"xa.pdf").hexdigest(), "a.pdf", hashlib.sha256(b"x").hexdigest(), "ACTIVE", ts, ts),
         (hashlib.sha256(b"yb.pdf").hexdigest(), "b.pdf", hashlib.sha256(b"y").hexdigest(), "ACTIVE", ts, ts)],
        "doc_id string, path string, content_hash string, status string, created_at timestamp_ntz, updated_at timestamp_ntz")
    files = spark.createDataFrame([("a.pdf", "x"), ("b.pdf", None)], "path string, content string")
    pages = spark.createDataFrame([], fx.pages_f3(spark, "/root/testdata/sf0.001").schema)
    out = PL.sync(PL.RunContext.create(spark, NOW), files, reg, pages)
    assert sorted((r.change, r.path) for r in out["changes"].collect()) == [("ERROR", "b.pdf"), ("UNCHANGED", "a.pdf")]
    assert {r.path: r.status for r in out["registry"].collect()} == {"a.pdf": "ACTIVE", "b.pdf": "ACTIVE"}


def test_readme_usage_on_a_real_tree(spark, tmp_path):
    import os
    from pagewright.sources.files import read_tree
    from pagewright.sources.registry import initialize_tables
    src, root = str(tmp_path / "pdf"), str(tmp_path / "state")
    os.makedirs(os.path.join(src, "a"))
    for rel, text in {"a/one.pdf": "First page. " * 200, "two.PDF": "Zwei Seiten hier. " * 30}.items():
        with open(os.path.join(src, rel), "w", encoding="utf-8") as f:
            f.write(text)
    initialize_tables(spark, root)

    def run(reg, pages, index, payload=None):
        ctx = PL.RunContext.create(spark, NOW)
        return PL.run_pipeline(ctx, read_tree(spark, src).select("path", "content"), reg, pages,
                               payload=payload, index=index)

    out = run(spark.read.parquet(f"{root}/documents_state"), spark.read.parquet(f"{root}/pages_state"),
              spark.read.parquet(f"{root}/page_index"))
    assert sorted(r.change for r in out["changes"].collect()) == ["NEW", "NEW"]
    assert out["pages"].count() == 4            # 2400 chars -> 3 pages, 540 chars -> 1 page
    assert out["index"].count() == 4
    assert out["run_state"].first().status == "COMPLETED"
    with open(os.path.join(src, "a", "three.pdf"), "w", encoding="utf-8") as f:
        f.write("Third document.")
    out2 = run(out["registry"], out["pages"], out["index"], out["payload"])
    assert sorted(r.change for r in out2["changes"].collect()) == ["NEW", "UNCHANGED", "UNCHANGED"]
    assert out2["index"].count() == 5


def test_compat_sync_matches_reference_order(spark, sf):
    """mode='compat': the reference's four classes and its action order
    (deleted, moved, new) give the registry of the `apply_changes` query."""
    from pagewright.plans.catalog import synced_registry
    out = PL.sync(PL.RunContext.create(spark, NOW), fx.storage(spark, sf), fx.registry_f2(spark, sf),
                  fx.pages_f3(spark, sf), mode="compat")
    assert {r.change for r in out["changes"].collect()} <= {"new", "moved", "deleted", "unchanged"}
    assert sorted(out["registry"].collect()) == sorted(synced_registry(spark, sf).collect())


def test_incremental_tree_run_reads_only_changed_files(spark, tmp_path):
    import os
    import time
    from pagewright.sources import files as FS
    from pagewright.sources.registry import initialize_tables
    src, root = str(tmp_path / "pdf"), str(tmp_path / "state")
    os.makedirs(src)
    for name, text in {"one.pdf": "Alpha beta. " * 100, "two.pdf": "Gamma delta. " * 10}.items():
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    initialize_tables(spark, root)
    contents = lambda paths: FS.read_contents(spark, src, paths)
    scan1 = FS.scan_tree_incremental(spark, src, None)
    out1 = PL.run_pipeline(PL.RunContext.create(spark, NOW), None,
                           spark.read.parquet(f"{root}/documents_state"), spark.read.parquet(f"{root}/pages_state"),
                           index=spark.read.parquet(f"{root}/page_index"), scan=scan1, contents=contents)
    assert out1["index"].count() == 3
    time.sleep(1.1)
    with open(os.path.join(src, "three.pdf"), "w") as f:
        f.write("Epsilon.")
    prev = spark.createDataFrame(scan1.collect(), scan1.schema)
    scan2 = FS.scan_tree_incremental(spark, src, prev)
    out2 = PL.run_pipeline(PL.RunContext.create(spark, NOW), None, out1["registry"], out1["pages"],
                           payload=out1["payload"], index=out1["index"], scan=scan2, contents=contents)
    assert sorted(r.change for r in out2["changes"].collect()) == ["NEW", "UNCHANGED", "UNCHANGED"]
    assert out2["index"].count() == 4
