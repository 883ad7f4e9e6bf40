"""Large files, byte ranges, range covers and the mirror, on real files."""

import datetime as dt
import hashlib
import os
import tracemalloc

import pytest
from pyspark.sql import functions as F

from pagewright.operators import mirror as MR
from pagewright.sources import files as FS
from pagewright.sources import storage as ST


def tree(root, files):
    for name, data in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)


def contents(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read()
            for d, _, names in os.walk(root) for f in names}


def test_a_file_beyond_2_gib_has_hashes(spark, tmp_path):
    big = tmp_path / "tree" / "big.pdf"
    big.parent.mkdir()
    with open(big, "wb") as f:
        f.write(b"%PDF head")
        f.truncate(3 << 30)  # sparse
        f.seek(3 << 30)
        f.write(b"tail")
    tree(big.parent, {"small.pdf": b"x"})
    tracemalloc.start()
    content, doc, n = ST.digests(*ST.store_of(str(big)), "big.pdf")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = hashlib.sha256()
    with open(big, "rb") as f:
        while data := f.read(1 << 24):
            want.update(data)
    assert content == want.hexdigest() and n == (3 << 30) + 4 and peak < 4 * ST.CHUNK
    want.update(b"big.pdf")
    assert doc == want.hexdigest()
    got = {r.path: r for r in FS.scan_tree(spark, str(big.parent)).collect()}
    assert (got["big.pdf"].content_hash, got["big.pdf"].doc_id, got["big.pdf"].error) == (content, doc, None)
    assert got["small.pdf"].content_hash == hashlib.sha256(b"x").hexdigest()
    # a limit of the caller's own is an error still
    got = {r.path: r for r in FS.scan_tree(spark, str(big.parent), max_bytes=1 << 30).collect()}
    assert "larger than" in got["big.pdf"].error and got["big.pdf"].doc_id is None


@pytest.fixture
def short_rows(spark):
    """A session in which files above 1,000 bytes don't fit a row."""
    key = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "1000")
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_both_ways_of_reading_agree(spark, tmp_path, short_rows):
    files = {f"d{i}/é {i}.pdf": bytes([i]) * n for i, n in enumerate((1, 999, 1000, 1001, 5000, 70_000))}
    tree(tmp_path, files)
    got = {r.path: r for r in FS.scan_tree(spark, f"file:{tmp_path}").collect()}
    assert set(got) == set(files)
    for name, data in files.items():
        assert got[name].content_hash == hashlib.sha256(data).hexdigest() and got[name].error is None
        assert got[name].doc_id == hashlib.sha256(data + name.encode()).hexdigest()
    # unchanged large files aren't read again, changed ones are
    before = spark.createDataFrame(
        FS.scan_tree(spark, str(tmp_path)).collect(), FS.scan_tree(spark, str(tmp_path)).schema)
    tree(tmp_path, {"d5/é 5.pdf": b"z" * 70_001})
    again = {r.path: r for r in FS.scan_tree_incremental(spark, str(tmp_path), before).collect()}
    assert again["d4/é 4.pdf"].content_hash == got["d4/é 4.pdf"].content_hash
    assert again["d5/é 5.pdf"].content_hash == hashlib.sha256(b"z" * 70_001).hexdigest()


def test_a_large_file_that_cannot_be_read_is_an_error_row(spark, tmp_path):
    tree(tmp_path, {"a.pdf": b"a" * 50})
    rows = spark.createDataFrame([("a.pdf", 50), ("gone.pdf", 10), ("a.pdf/../../x", 1)], "path string, length long")
    got = {r.path: r for r in ST.hash_files(rows, str(tmp_path)).collect()}
    assert got["a.pdf"].read_error is None and "FileNotFound" in got["gone.pdf"].read_error
    assert "not a path below" in got["a.pdf/../../x"].read_error
    shorter = spark.createDataFrame([("a.pdf", 60)], "path string, length long")
    assert "changed while" in ST.hash_files(shorter, str(tmp_path)).first().read_error


def test_byte_ranges(spark, tmp_path):
    data = {"a.pdf": bytes(range(256)) * 10, "b.pdf": b"", "c.pdf": b"x" * 1024}
    tree(tmp_path, data)
    listing = spark.createDataFrame([(k, len(v)) for k, v in data.items()], "path string, length long")
    got = ST.read_chunks(listing, str(tmp_path), chunk=1024).orderBy("path", "chunk").collect()
    assert [(r.path, r.chunk, r.offset, len(r.content)) for r in got] == [
        ("a.pdf", 0, 0, 1024), ("a.pdf", 1, 1024, 1024), ("a.pdf", 2, 2048, 512), ("b.pdf", 0, 0, 0), ("c.pdf", 0, 0, 1024)]
    assert b"".join(r.content for r in got if r.path == "a.pdf") == data["a.pdf"]


def test_cover_is_disjoint_and_whole(spark):
    at = dt.datetime(2024, 1, 1)
    days = [0, 0, 1, 1, 2, 500, 501, 900, 900, 2000]
    rows = spark.createDataFrame([(at + dt.timedelta(days=d, seconds=i), 100 + i) for i, d in enumerate(days)],
                                 "modificationTime timestamp, length long")
    for n in (1, 2, 3, 4, 32):
        spans = FS.cover(rows, ranges=n)
        assert len(spans) <= n and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        assert all(any(s[0] <= r.modificationTime <= s[1] and s[2] <= r.length <= s[3] for s in spans) for r in rows.collect())
    four = FS.cover(rows, ranges=4)
    assert [(s[0] - at).days for s in four] == [0, 500, 900, 2000] and [s[2:] for s in four] == [(100, 104), (105, 106), (107, 108), (109, 109)]
    assert FS.cover(rows.limit(0)) == []


def test_an_old_and_a_new_file_read_two_files(spark, tmp_path):
    tree(tmp_path, {f"f{i}.pdf": b"%d" % i * 20 for i in range(20)})
    for i in range(20):
        os.utime(tmp_path / f"f{i}.pdf", (1_700_000_000 + 86_400 * i,) * 2)
    wanted = spark.createDataFrame([("f0.pdf",), ("f19.pdf",)], "path string")
    rows = FS.read_contents(spark, str(tmp_path), wanted)
    assert {r.path for r in rows.collect()} == {"f0.pdf", "f19.pdf"}
    spans = FS.cover(FS.read_tree(spark, str(tmp_path)).join(wanted, "path"))
    inside = FS.read_tree(spark, str(tmp_path)).filter(" or ".join(
        f"modificationTime between timestamp'{a}' and timestamp'{b}'" for a, b, _, _ in spans)).count()
    assert len(spans) == 2 and inside == 2
    assert "OR" in rows._jdf.queryExecution().executedPlan().toString().upper()


def test_mirror_is_applied(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    tree(src, {"a/new é.pdf": b"n" * 10_000, "same.pdf": b"same", "b/changed.pdf": b"after", "bad.pdf": b"?"})
    tree(dst, {"same.pdf": b"same", "b/changed.pdf": b"before", "old/gone.pdf": b"g"})

    def plan():
        s, t = FS.scan_tree(spark, src), FS.scan_tree(spark, dst)
        return MR.mirror_plan(s, t), s

    p, scan = plan()
    rows = spark.createDataFrame(p.collect(), p.schema)
    hashes = spark.createDataFrame(scan.select("path", "content_hash").collect(), "path string, content_hash string")
    # one source goes, one changes after the plan was made
    os.rename(os.path.join(src, "bad.pdf"), str(tmp_path / "bad.pdf"))
    got = {r.path: r for r in MR.apply_mirror(rows, src, dst, str(tmp_path / "out"), hashes).collect()}
    assert set(got) == {"a/new é.pdf", "b/changed.pdf", "old/gone.pdf", "bad.pdf"}
    assert got["bad.pdf"].status == "FAILED" and "FileNotFound" in got["bad.pdf"].error
    assert all(got[k].status == "DONE" for k in got if k != "bad.pdf") and got["a/new é.pdf"].bytes == 10_000
    want = {"a/new é.pdf": b"n" * 10_000, "same.pdf": b"same", "b/changed.pdf": b"after"}
    assert contents(dst) == want
    # once more: the same tree, nothing copied
    again = {r.path: r for r in MR.apply_mirror(rows, src, dst, str(tmp_path / "out2"), hashes).collect()}
    assert contents(dst) == want and [again[k].bytes for k in want if k in again] == [0, 0]
    assert {r.action for r in plan()[0].collect()} == {"SKIP"}


def test_a_mirror_run(spark, tmp_path):
    from pagewright.plans import pipeline as PL
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    tree(src, {f"d{i % 3}/f{i}.pdf": b"%d" % i * 100 for i in range(12)})
    tree(dst, {"d0/f0.pdf": b"0" * 100, "d1/f1.pdf": b"old", "x/gone.pdf": b"g"})
    run = f"mirror-{os.urandom(8).hex()}"
    out = PL.mirror(PL.RunContext.create(spark, "2024-06-01 00:00:00", run_id=run), src, dst)
    assert {r.action: r.n for r in out["counts"].collect()} == {"SKIP": 1, "UPDATE": 1, "COPY": 10, "DELETE": 1}
    assert out["outcome"].filter("status = 'DONE'").count() == 12 and contents(dst) == contents(src)
    # the target has changed, so only the source's scan is read back
    ctx = PL.RunContext.create(spark, "2024-06-01 00:00:00", run_id=run)
    out = PL.mirror(ctx, src, dst)
    assert ctx.reused == ["mirror_source"] and out["outcome"].count() == 0
    assert {r.action: r.n for r in out["counts"].collect()} == {"SKIP": 12}


def test_a_changed_source_leaves_the_target(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    tree(src, {"x.pdf": b"now"})
    tree(dst, {"x.pdf": b"old"})
    plan = spark.createDataFrame([("x.pdf", "UPDATE"), ("../y.pdf", "DELETE"), ("z.pdf", "SKIP")], "path string, action string")
    tree(tmp_path, {"y.pdf": b"outside"})
    other = spark.createDataFrame([("x.pdf", hashlib.sha256(b"then").hexdigest())], "path string, content_hash string")
    got = {r.path: r for r in MR.apply_mirror(plan, src, dst, str(tmp_path / "o"), other).collect()}
    assert set(got) == {"x.pdf", "../y.pdf"} and "has changed since" in got["x.pdf"].error
    assert contents(dst) == {"x.pdf": b"old"} and (tmp_path / "y.pdf").exists() and "below" in got["../y.pdf"].error
    # without hashes the file is taken as it is
    assert MR.apply_mirror(plan.limit(1), src, dst, str(tmp_path / "o2")).first().status == "DONE"
    assert contents(dst) == {"x.pdf": b"now"}
    assert MR.apply_mirror(plan.filter(F.lit(False)), src, dst, str(tmp_path / "o3")).count() == 0
