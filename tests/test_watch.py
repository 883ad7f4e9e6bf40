"""The stream of polls over a real tree, and its crash cases."""

import hashlib
import os

import pytest

from pagewright.schemas import ACTIVE, DOCUMENTS_STATE, INACTIVE
from pagewright.streaming import watch as W


def put(root, name, data, at):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    os.utime(path, (at, at))


def drop(root, name, place):
    os.makedirs(place, exist_ok=True)
    os.rename(os.path.join(root, name), os.path.join(place, name.replace("/", "-") + str(len(os.listdir(place)))))


def sha(*parts):
    return hashlib.sha256(b"".join(parts)).hexdigest()


def seen(events):
    return {(r.event, r.path, r.old_path) for r in events.collect()}


def test_edits_moves_and_deletions(spark, tmp_path):
    root, folder, away = str(tmp_path / "tree"), str(tmp_path / "watch"), str(tmp_path / "away")
    for name, data in {"a.pdf": b"a", "b.pdf": b"b", "dir/c.pdf": b"c", "d.pdf": b"d"}.items():
        put(root, name, data, 1_700_000_000)
    registry = spark.createDataFrame([], DOCUMENTS_STATE)
    first = W.poll(spark, root, folder, 1_000)
    assert seen(first) == {("NEW", p, None) for p in ("a.pdf", "b.pdf", "dir/c.pdf", "d.pdf")}
    one = {r.path: r for r in first.collect()}
    assert one["dir/c.pdf"].content_hash == sha(b"c") and one["dir/c.pdf"].doc_id == sha(b"c", b"dir/c.pdf")
    registry = spark.createDataFrame(W.register_events(registry, first, "2024-06-01 00:00:00").collect(), DOCUMENTS_STATE)

    put(root, "a.pdf", b"A", 1_700_000_001)          # edited, same length
    put(root, "d.pdf", b"d", 1_700_000_009)          # touched only
    drop(root, "b.pdf", away)                        # gone
    drop(root, "dir/c.pdf", away)
    put(root, "moved/c.pdf", b"c", 1_700_000_002)    # moved
    put(root, "e.pdf", b"e", 1_700_000_003)
    second = W.poll(spark, root, folder, 2_000)
    assert seen(second) == {("MODIFIED", "a.pdf", None), ("DELETED", "b.pdf", None), ("MOVED", "moved/c.pdf", "dir/c.pdf"),
                            ("NEW", "e.pdf", None)}
    two = {r.path: r for r in second.collect()}
    assert (two["a.pdf"].old_content_hash, two["a.pdf"].content_hash) == (sha(b"a"), sha(b"A"))
    assert two["moved/c.pdf"].old_doc_id == one["dir/c.pdf"].doc_id
    registry = spark.createDataFrame(W.register_events(registry, second, "2024-06-02 00:00:00").collect(), DOCUMENTS_STATE)
    rows = {(r.path, r.content_hash): r.status for r in registry.collect()}
    assert rows == {("a.pdf", sha(b"a")): INACTIVE, ("a.pdf", sha(b"A")): ACTIVE, ("b.pdf", sha(b"b")): INACTIVE,
                    ("dir/c.pdf", sha(b"c")): INACTIVE, ("moved/c.pdf", sha(b"c")): ACTIVE, ("d.pdf", sha(b"d")): ACTIVE,
                    ("e.pdf", sha(b"e")): ACTIVE}

    assert seen(W.poll(spark, root, folder, 3_000)) == set()
    put(root, "b.pdf", b"b", 1_700_000_004)          # back again
    third = W.poll(spark, root, folder, 4_000)
    assert seen(third) == {("NEW", "b.pdf", None)}
    rows = W.register_events(registry, third, "2024-06-03 00:00:00").collect()
    assert len(rows) == 7 and {r.status for r in rows if r.path == "b.pdf"} == {ACTIVE}

    for name in ("a.pdf", "b.pdf", "d.pdf", "e.pdf", "moved/c.pdf"):
        drop(root, name, away)
    put(root, "not-a-pdf.txt", b"", 1_700_000_000)
    assert seen(W.poll(spark, root, folder, 5_000)) == {("DELETED", p, None) for p in ("a.pdf", "b.pdf", "d.pdf", "e.pdf", "moved/c.pdf")}
    # only the last poll's listing is kept
    assert os.listdir(os.path.join(folder, "polls")) == ["poll-0000000000005000"]


def test_a_poll_that_died_is_finished_by_the_next(spark, tmp_path):
    root, folder, away = str(tmp_path / "tree"), str(tmp_path / "watch"), str(tmp_path / "away")
    put(root, "a.pdf", b"a", 1_700_000_000)
    put(root, "b.pdf", b"b", 1_700_000_000)
    W.poll(spark, root, folder, 1_000)
    drop(root, "b.pdf", away)
    put(root, "c.pdf", b"c", 1_700_000_000)
    W.write_poll(W.list_tree(spark, root), folder, 2_000)  # listed, then nothing
    put(root, "d.pdf", b"d", 1_700_000_000)
    W.poll(spark, root, folder, 3_000)
    got = {(r.event, r.path) for r in W.follow(spark, folder, root).collect()}
    assert got == {("NEW", p) for p in ("a.pdf", "b.pdf", "c.pdf", "d.pdf")} | {("DELETED", "b.pdf")}
    with pytest.raises(OSError):
        W.write_poll(W.list_tree(spark, root), folder, 3_000)


def test_an_unreadable_file_is_an_error_until_it_can_be_read(spark, tmp_path):
    root, folder = str(tmp_path / "tree"), str(tmp_path / "watch")
    put(root, "a.pdf", b"abc", 1_700_000_000)
    rows = spark.createDataFrame([("a.pdf", 9, 5), ("gone.pdf", 1, 5)], "path string, length long, modified long")
    W.write_poll(rows, folder, 1_000)
    got = {r.path: r for r in W.follow(spark, folder, root).collect()}
    assert {r.event for r in got.values()} == {"ERROR"} and "changed while" in got["a.pdf"].error
    put(root, "gone.pdf", b"g", 1_700_000_000)
    assert seen(W.poll(spark, root, folder, 2_000)) == {("NEW", "a.pdf", None), ("NEW", "gone.pdf", None)}


def test_equal_files_are_moved_in_order(spark):
    rows = [(f"new{i}", "NEW", "h", f"n{i}", None, None, 7, None) for i in range(3)]
    rows += [(f"old{i}", "DELETED", None, None, "h", f"o{i}", 7, None) for i in range(2)]
    rows += [("old9", "DELETED", None, None, "h", "o9", 8, None)]
    got = W.with_moves(spark.createDataFrame(rows, W.EVENTS))
    assert {(r.event, r.path, r.old_path, r.old_doc_id) for r in got.collect()} == {
        ("MOVED", "new0", "old0", "o0"), ("MOVED", "new1", "old1", "o1"), ("NEW", "new2", None, None),
        ("DELETED", "old9", None, "o9")}


def test_paths_of_a_partition_share_arrow_batches(spark, tmp_path):
    """Python gets paths by the batch: its calls follow the batches and not the paths (F1 of round 3)."""
    folder, n = str(tmp_path / "watch"), 30_000

    def listed(ids):
        return spark.range(*ids).selectExpr("concat('f', id) path", "1L length", "1L modified",
                                            "concat('h', id % 7) content_hash", "concat('d', id) doc_id")

    W.write_poll(listed((0, n)), folder, 1_000)
    assert W.follow(spark, folder).filter("event = 'NEW'").count() == n
    W.write_poll(listed((n // 2, n + 5)), folder, 2_000)
    got = {tuple(r) for r in W.follow(spark, folder).filter("seen_ms = 2000").groupBy("event").count().collect()}
    assert got == {("DELETED", n // 2), ("NEW", 5)}

    import pyarrow as pa
    watcher, calls = W.Watcher(None, 5), []
    columns = ["known", "path", "length", "modified", "content_hash", "doc_id", "seen_ms"]

    def batches():
        for k in range(3):
            calls.append(k)
            yield pa.RecordBatch.from_pylist([dict(zip(columns, (False, f"{k}-{i}", 1, 1, "h", "d", 5))) for i in range(1000)])

    out = list(watcher(batches()))
    assert calls == [0, 1, 2] and len(out) == 4 and sum(b.num_rows for b in out) == 6000


def test_a_batch_that_is_run_again_writes_the_same(spark, tmp_path):
    work, folder = str(tmp_path / "batches"), str(tmp_path / "w")
    rows = [("a", 1, 1, "ha", "da"), ("b", 1, 1, "hb", "db"), (None, 1, 1, "hn", "dn"), ("a", 1, 1, "ha", "da")]
    schema = "path string, length long, modified long, content_hash string, doc_id string"
    W.write_poll(spark.createDataFrame(rows, schema), folder, 1_000)
    W.write_poll(spark.createDataFrame([("a", 2, 1, "h2", "d2")], schema), folder, 2_000)
    W.write_poll(spark.createDataFrame([("b", 9, 9, "late", "late")], schema), folder, 500)
    one, two, late = (spark.read.schema(W.LISTING).parquet(os.path.join(folder, "polls", f"poll-{t:016d}")) for t in (1000, 2000, 500))
    write = W._work_off(work, None)

    def state(epoch):
        return sorted(map(str, spark.read.parquet(f"{work}/batch={epoch}/kind=state").collect()))

    def events():
        got = spark.read.parquet(work).filter("kind = 'event'").collect()
        return sorted((r.batch, r.event, r.path or "-", r.seen_ms) for r in got)

    write(one, 0)
    first = state(0)
    assert events() == [(0, "NEW", "-", 1000), (0, "NEW", "a", 1000), (0, "NEW", "b", 1000)]
    for _ in range(2):
        write(two, 1)
        assert events()[3:] == [(1, "DELETED", "-", 2000), (1, "DELETED", "b", 2000), (1, "MODIFIED", "a", 2000)]
        assert state(0) == first and len(state(1)) == 2
    write(late, 2)
    assert len(events()) == 6 and not os.path.exists(f"{work}/batch=2")
