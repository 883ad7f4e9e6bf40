"""File-tree scanning, table creation and the incremental stream."""

import hashlib
import os

from pyspark.sql import functions as F

from pagewright.sources import files as FS
from pagewright.sources import registry as R
from pagewright.streaming import incremental as INC


def _tree(root, files):
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)


def test_scan_tree_hashes_and_skips(spark, tmp_path):
    root = str(tmp_path / "tree")
    files = {"a#1%20.pdf": b"one", "한글.pdf": b"two", "sub/x.PDF": b"three", "big.pdf": b"x" * 50,
             "note.txt": b"no", "_x.pdf": b"hidden", ".x.pdf": b"hidden", "_dir/y.pdf": b"hidden",
             "empty.pdf": b""}
    _tree(root, files)
    rows = FS.scan_tree(spark, root, max_bytes=10).collect()
    got = {r.path: r for r in rows if r.error is None}
    assert set(got) == {"a#1%20.pdf", "한글.pdf", "sub/x.PDF"}
    for p, r in got.items():
        assert r.content_hash == hashlib.sha256(files[p]).hexdigest()
        assert r.doc_id == hashlib.sha256(files[p] + p.encode()).hexdigest()
    assert [(r.path, r.error) for r in rows if r.error] == [("big.pdf", "file larger than 10 bytes")]


def test_list_files_on_manifest(spark):
    m = spark.createDataFrame([("a/x.pdf",), ("a/y.PDF",), ("b/z.pdf",), ("a/w.txt",)], "path string")
    assert sorted(r.path for r in FS.list_files(m, "a/").collect()) == ["a/x.pdf", "a/y.PDF"]


def test_initialize_tables_creates_only_missing(spark, tmp_path):
    root = str(tmp_path / "db")
    assert set(R.initialize_tables(spark, root)) == {"documents_state", "pages_state", "run_log", "page_index"}
    assert R.initialize_tables(spark, root) == []
    d = R.describe_tables(spark).filter("table = 'pages_state'").orderBy("position").collect()
    assert d[0].column == "page_id" and d[0].nullable is False


def test_incremental_ingest_only_new_files(spark, tmp_path):
    root = str(tmp_path / "src")
    _tree(root, {"a.pdf": b"A", "d/b.pdf": b"B"})
    reg, ckpt = str(tmp_path / "reg"), str(tmp_path / "ckpt")
    out = INC.ingest_files(spark, INC.binary_file_stream(spark, root), reg, ckpt, "2024-06-01 00:00:00")
    assert sorted(r.path for r in out.collect()) == ["a.pdf", "d/b.pdf"]
    _tree(root, {"c.pdf": b"C"})
    out = INC.ingest_files(spark, INC.binary_file_stream(spark, root), reg, ckpt, "2024-06-01 00:00:00")
    assert sorted(r.path for r in out.collect()) == ["a.pdf", "c.pdf", "d/b.pdf"]
    assert out.select("doc_id").distinct().count() == 3


def test_incremental_scan_reuses_hashes_of_unchanged_files(spark, tmp_path):
    import time
    root = str(tmp_path / "inc")
    _tree(root, {"a.pdf": b"A", "d/b.pdf": b"B", "x [1].pdf": b"X"})
    first = FS.scan_tree_incremental(spark, root, None)
    full = {r.path: (r.content_hash, r.doc_id) for r in FS.scan_tree(spark, root).collect()}
    assert {r.path: (r.content_hash, r.doc_id) for r in first.collect()} == full
    prev = spark.createDataFrame(first.collect(), first.schema)
    time.sleep(1.1)
    _tree(root, {"d/b.pdf": b"B2", "c.pdf": b"C"})            # one edit, one new file
    # a planted wrong hash for an unchanged file proves it was not re-read
    planted = prev.withColumn("content_hash", F.when(F.col("path") == "a.pdf", F.lit("kept"))
                              .otherwise(F.col("content_hash")))
    second = {r.path: r.content_hash for r in FS.scan_tree_incremental(spark, root, planted).collect()}
    assert second["a.pdf"] == "kept"
    assert second["d/b.pdf"] == hashlib.sha256(b"B2").hexdigest()
    assert second["c.pdf"] == hashlib.sha256(b"C").hexdigest()
    assert second["x [1].pdf"] == hashlib.sha256(b"X").hexdigest()
    third = {r.path: r.content_hash for r in FS.scan_tree_incremental(spark, root, None).collect()}
    assert third["c.pdf"] == hashlib.sha256(b"C").hexdigest() and len(third) == 4
