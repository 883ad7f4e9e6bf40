"""Inputs on which rows were once lost or misstated."""

import hashlib
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.functions import text as TX
from pagewright.operators import changes as D
from pagewright.operators import index as IX
from pagewright.operators import mirror as MR
from pagewright.operators import pages as PG
from pagewright.operators import queues as W
from pagewright.operators.plugins import run_plugin
from pagewright.plans import pipeline as PL
from pagewright.schemas import DOCUMENTS_STATE
from pagewright.sources import files as FS
from pagewright.sources import fixtures as fx
from pagewright.sources.registry import initialize_tables
from pagewright.streaming import incremental as INC

NOW = "2024-06-01 00:00:00"


def test_a_replayed_epoch_keeps_its_rows(spark, tmp_path):
    reg = str(tmp_path / "reg")
    spark.createDataFrame([], DOCUMENTS_STATE).write.parquet(os.path.join(reg, "epoch=-1"))
    write = INC._register_batch(reg, NOW)
    batches = [spark.createDataFrame([(f"{n}{i}.pdf", f"text {n}{i}") for i in range(2)], "path string, content string") for n in "ab"]
    for epoch in (0, 1, 1, 0):
        write(batches[epoch], epoch)
        assert spark.read.parquet(reg).filter(f"epoch = {epoch}").count() == 2
    assert INC.compact_registry(spark, reg, str(tmp_path / "new")).select("doc_id").distinct().count() == 4


def test_a_poll_sees_files_edited_in_place(spark, tmp_path):
    root = str(tmp_path / "src")
    os.makedirs(root)
    for name, text in (("a.pdf", "A"), ("b.pdf", "B")):
        open(os.path.join(root, name), "w").write(text)
    scan, rows = INC.poll_tree(spark, root, spark.createDataFrame([], DOCUMENTS_STATE), None, NOW)
    scan, registry = (spark.createDataFrame(x.collect(), x.schema) for x in (scan, rows))
    assert registry.count() == 2
    time.sleep(1.1)
    open(os.path.join(root, "a.pdf"), "w").write("C")
    _, rows = INC.poll_tree(spark, root, registry, scan, NOW)
    assert [(r.path, r.content_hash) for r in rows.collect()] == [("a.pdf", hashlib.sha256(b"C").hexdigest())]


def test_a_bucketed_table_is_opened_with_its_own_buckets(spark, tmp_path):
    ctx = PL.RunContext.create(spark, NOW, buckets=32)
    ctx.root = str(tmp_path / "it's")
    df = spark.range(1000).selectExpr("cast(id as string) page_id", "id")
    ctx.save("state", df, bucket_by="page_id")
    path = os.path.join(ctx.root, "state")
    assert spark.conf.get("spark.sql.shuffle.partitions") != "32"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert PL.open_bucketed(spark, path).join(df, "page_id").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="32 buckets"):
        PL.open_bucketed(spark, path, buckets=8)
    ctx.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"pw_{ctx.run_id}")]


def test_the_mirror_plan_tests_presence(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "path string, content_hash string")
    source = rows(("new", "1"), ("same", "2"), ("null here", None), ("null there", "3"), ("both null", None), ("edited", "4"))
    target = rows(("same", "2"), ("null here", "5"), ("null there", None), ("both null", None), ("edited", "6"), ("gone", "7"),
                  ("unreadable", "8"))
    errors = spark.createDataFrame([("unreadable", "x"), ("never copied", "y")], "path string, error string")
    assert {r.path: r.action for r in MR.mirror_plan(source, target, errors).collect()} == {
        "new": "COPY", "same": "SKIP", "null here": "UPDATE", "null there": "UPDATE", "both null": "SKIP", "edited": "UPDATE",
        "gone": "DELETE", "unreadable": "ERROR", "never copied": "ERROR"}


@pytest.mark.parametrize("kind", ["omits", "all", "repeats", "invents"])
def test_every_page_given_to_a_plug_in_comes_back(spark, kind):
    def fn(pdf):
        out = pdf[["page_id"]].assign(value="v", error=None)
        if kind == "omits":
            return out[out["page_id"] != "2"]
        if kind == "all":
            return out.iloc[0:0]
        if kind == "repeats":
            return pd.concat([out, out])
        return out.assign(page_id="other")
    df = spark.createDataFrame([("1",), ("2",), ("3",)], "page_id string").coalesce(1)
    got = {r.page_id: r.status for r in run_plugin(df, fn, T.StringType()).collect()}
    assert got == {"1": "SUCCESS", "2": "FAILED", "3": "SUCCESS"} if kind == "omits" else set(got.values()) == {"FAILED"}
    assert set(got) == {"1", "2", "3"}


def test_a_failed_batch_waits_before_its_rows_are_tried(spark):
    def fn(pdf):
        if len(pdf) > 1:
            raise RuntimeError("batch refused")
        return pdf[["page_id"]].assign(value="v", error=None)
    df = spark.createDataFrame([("1",), ("2",)], "page_id string").coalesce(1)
    run_plugin(df, fn, T.StringType()).collect()
    start = time.time()
    assert run_plugin(df, fn, T.StringType(), retry_wait_s=1.5).filter("status = 'SUCCESS'").count() == 2
    assert time.time() - start >= 1.5


@pytest.mark.parametrize("html,text", [
    ("<footer><script>x()</script>copyright 2020</footer>a", "a"),
    ("a &amp;lt; b &lt; c &mdash; d &#39;e&#39;", "a &lt; b < c — d 'e'"),
    ("x<img src=a alt='cap'>y", "x\n<image>cap</image>\ny"),
    ("a &amp;&amp;&amp; b &amp; c", "a b & c"),
])
def test_text_rules(spark, html, text):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(TX.html_to_markdown("h").alias("t")).first().t == text


def tree(root, files):
    for name, data in files.items():
        os.makedirs(os.path.dirname(os.path.join(root, name)) or root, exist_ok=True)
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)


def test_oversized_and_unreadable_files_stay_registered(spark, tmp_path):
    src, root = str(tmp_path / "pdf"), str(tmp_path / "state")
    os.makedirs(src)
    tree(src, {"a.pdf": b"fine", "big.pdf": b"grows", "bad.pdf": b"rots"})
    initialize_tables(spark, root)
    state = [spark.read.parquet(f"{root}/{t}") for t in ("documents_state", "pages_state", "page_index")]
    first = FS.scan_tree_incremental(spark, src, None)
    contents = lambda paths: FS.read_contents(spark, src, paths, max_bytes=20)
    out = PL.run_pipeline(PL.RunContext.create(spark, NOW), None, state[0], state[1], index=state[2], scan=first, contents=contents)
    assert out["registry"].filter("status = 'ACTIVE'").count() == 3
    prev = spark.createDataFrame(first.collect(), first.schema)
    time.sleep(1.1)
    tree(src, {"big.pdf": b"x" * 50, "bad.pdf": b"rotten", ".bad.pdf.crc": b"crc\x00\x00\x00\x02\x00\x00\x00\x00\x07"})
    for scan in (FS.scan_tree_incremental(spark, src, prev, max_bytes=20), FS.scan_tree(spark, src, max_bytes=20)):
        assert {r.path: r.error for r in scan.collect()} == {
            "a.pdf": None, "big.pdf": "file larger than 20 bytes", "bad.pdf": "unreadable"}
        again = PL.run_pipeline(PL.RunContext.create(spark, NOW), None, out["registry"], out["pages"], payload=out["payload"],
                                index=out["index"], scan=scan, contents=contents)
        assert sorted((r.change, r.path) for r in again["changes"].collect()) == [
            ("ERROR", "bad.pdf"), ("ERROR", "big.pdf"), ("UNCHANGED", "a.pdf")]
        assert again["registry"].filter("status = 'ACTIVE'").count() == 3
        row = again["run_state"].first()
        assert (row.status, row.total_documents, row.processed_documents) == ("COMPLETED", 3, 3)


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_run_writes_what_changed(spark, tmp_path):
    """The page tables that a run writes for one changed document don't grow with the state."""
    written = []
    for n in (20, 200):
        src, root = str(tmp_path / f"pdf{n}"), str(tmp_path / f"state{n}")
        tree(src, {f"d{i}.pdf": f"Document {i} speaks. ".encode() * 150 for i in range(n)})
        initialize_tables(spark, root)
        state = [spark.read.parquet(f"{root}/{t}") for t in ("documents_state", "pages_state", "page_index")]
        files = FS.read_tree(spark, src).select("path", "content")
        ctx = PL.RunContext.create(spark, NOW)
        out = PL.compact(ctx, PL.run_pipeline(ctx, files, state[0], state[1], index=state[2]))
        assert out["index"].count() == out["pages"].count() == sum(-(-len(f"Document {i} speaks. ") * 150 // 1000) for i in range(n))
        tree(src, {"d0.pdf": b"Another text. " * 50})
        ctx2 = PL.RunContext.create(spark, NOW)
        out2 = PL.run_pipeline(ctx2, files, out["registry"], out["pages"], payload=out["payload"], index=out["index"])
        assert {r.change for r in out2["changes"].collect()} == {"UNCHANGED", "MODIFIED"}
        assert out2["pages"].filter("status = 'ACTIVE' AND indexed <> 'SUCCESS'").count() == 0
        narrow = ("scan_all", "changes", "registry", "run_log")  # a short row per file
        written.append(sum(folder_bytes(os.path.join(ctx2.root, t)) for t in os.listdir(ctx2.root) if t not in narrow))
        ctx.close()
    assert written[1] < 1.3 * written[0]


def test_first_load_has_no_hot_partition(spark):
    scan = spark.range(4000).selectExpr("concat('p', id) path", "concat('d', id) doc_id", "concat('h', id) content_hash")
    empty = spark.createDataFrame([], DOCUMENTS_STATE)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = D.detect_changes(scan, empty)
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) < 1000


def test_pages_are_cut_in_linear_time(spark):
    def seconds(n):
        df = spark.createDataFrame([("d", "p.pdf", "word " * n)], "doc_id string, path string, content string")
        best = 9.0
        for _ in range(3):
            start = time.time()
            PG.paginate(df).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - start)
        return best
    seconds(1000)
    assert seconds(800_000) < 4 * seconds(400_000) + 0.3


def test_pages_of_any_text(spark):
    texts = ["", None, "x", "ab\U0001f600\ncd" * 7, "y" * 10, "z" * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", PG.page_texts("t", 10).alias("p")).collect():
        t = texts[r.i]
        assert r.p == ([t] if not t else [t[k:k + 10] for k in range(0, len(t), 10)])


def test_the_index_has_the_latest_row_of_a_page(spark):
    schema = "page_id string, updated_at string, embedding array<float>, extracted_text string, summary string, doc_id string, " \
             "page_number int, status string, gcs_path string, gcs_pdf_path string"
    rows = [("p", f"2024-01-0{d}", [float(d)], f"t{d}", "s", "d", 1, "ACTIVE", "g", "g") for d in (1, 3, 2)]
    got = IX.index_documents(spark.createDataFrame(rows, schema)).collect()
    assert [(r.page_id, r.extracted_text) for r in got] == [("p", "t3")]


def test_another_model_indexes_its_pages_again(spark):
    pages = spark.createDataFrame([("a", "ACTIVE", "SUCCESS", "SUCCESS"), ("b", "ACTIVE", "SUCCESS", "SUCCESS"),
                                   ("c", "ACTIVE", "SUCCESS", "PENDING"), ("d", "INACTIVE", "SUCCESS", "SUCCESS")],
                                  "page_id string, status string, embedded string, indexed string")
    index = spark.createDataFrame([("a", "m1"), ("b", "m2")], "page_id string, model string")
    assert sorted(r.page_id for r in W.queue_index_for_model(pages, index, "m2").collect()) == ["a", "c"]


def test_a_missing_shared_folder_is_an_error(spark):
    from unittest.mock import MagicMock

    from pagewright.session import checkpoint_dir
    cluster = MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.getCheckpointDir.return_value = None
    cluster.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(cluster)
