"""Physical plans: top-k pushdown, no cartesian products, no Python in
native paths, and pruned Parquet scans."""

from pagewright.operators import changes as D
from pagewright.operators import embed as EM
from pagewright.operators import extract as EX
from pagewright.operators import pages as PG
from pagewright.operators import queues as W
from pagewright.operators import situate as SI
from pagewright.sources import fixtures as fx

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_first_n_pages_uses_window_group_limit(spark, sf):
    p = plan(PG.first_n_pages(fx.pages_f3(spark, sf)))
    assert "WindowGroupLimit" in p


def test_change_detection_has_no_cartesian_product(spark, sf):
    scan, reg = fx.scan_f1(spark, sf), fx.registry_f2(spark, sf)
    for df in (D.detect_changes(scan, reg), D.detect_changes_strict(scan, reg)):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_native_stages_stay_in_the_jvm(spark, sf):
    pages = fx.pages_f3(spark, sf)
    html = fx.table(spark, sf, "pages").selectExpr("cast(page_id as string) page_id", "html as payload")
    dfs = [EX.extract(html),
           EM.embed(W.queue(pages, "embed"), vectorized=False)]
    for df in dfs:
        p = plan(df)
        assert not any(n in p for n in PY_NODES), p


def test_situate_never_makes_a_row_of_a_token(spark, sf):
    p = SI.situate(W.queue(fx.pages_f3(spark, sf), "summary").select("page_id"), fx.payload(spark, sf)) \
        ._jdf.queryExecution().executedPlan().toString()
    cut = [x for x in p.splitlines() if "Generate" in x]  # pages are cut from documents, nothing else is exploded
    assert all("regexp_extract_all" in x for x in cut) and "ArrowEvalPython" in p


def test_queue_scan_reads_only_needed_columns(spark, sf):
    d = fx.table(spark, sf, "documents")
    q = d.filter(d["lang"] == "de").select("doc_id")
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in p
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in p


def test_vectorized_embed_uses_arrow_batches_only(spark, sf):
    p = plan(EM.embed(W.queue(fx.pages_f3(spark, sf), "embed")))
    assert "ArrowEvalPython" in p and "BatchEvalPython" not in p


def test_patch_step_on_bucketed_state_shuffles_only_patches(spark, sf):
    from pagewright.operators import mutations as U
    from pagewright.plans import pipeline as PL
    ctx = PL.RunContext.create(spark, "2024-06-01 00:00:00")
    state = ctx.save("state", fx.pages_f3(spark, sf), bucket_by="page_id")
    res = ctx.save("res", state.selectExpr("page_id", "'x' AS value", "CAST(NULL AS STRING) AS error",
                                           "'SUCCESS' AS status"), bucket_by="page_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = U.patch_pages(state, U.stage_patches(res, "extracted", "extracted_text", 1, ctx.now)) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange") <= 1


def test_previous_run_state_reopened_as_bucketed(spark, sf):
    import os
    from pagewright.operators import mutations as U
    from pagewright.plans import pipeline as PL
    ctx = PL.RunContext.create(spark, "2024-06-01 00:00:00")
    ctx.save("state", fx.pages_f3(spark, sf), bucket_by="page_id")
    prev = PL.open_bucketed(spark, os.path.join(ctx.root, "state"), buckets=ctx.buckets)
    patches = prev.selectExpr("page_id", "1L AS seq", "'x' AS extracted_text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = U.patch_pages(prev, patches)
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    if "== Final Plan ==" in p:
        p = p.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    assert "Bucketed: true" in p
    assert p.count("Exchange hashpartitioning") <= 1
