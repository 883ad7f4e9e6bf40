"""Change detection: properties and the strict decision table on inline rows."""

import datetime as dt

from pyspark.sql import functions as F

from pagewright.operators import changes as D
from pagewright.operators import mutations as U
from pagewright.operators.rank import row_number_within
from pagewright.sources import fixtures as fx

TS = dt.datetime(2024, 1, 1)
NOW = "2024-06-01 00:00:00"
REG = "doc_id string, path string, content_hash string, status string, created_at timestamp_ntz, updated_at timestamp_ntz"


def scan_of(spark, rows):
    """rows: (path, content) -> scan with real hashes."""
    from pagewright.sources.files import scan_manifest
    return scan_manifest(spark.createDataFrame(rows, "path string, content string"))


def reg_of(spark, rows):
    """rows: (path, content, status)."""
    import hashlib
    out = [(hashlib.sha256((c + p).encode()).hexdigest(), p, hashlib.sha256(c.encode()).hexdigest(), s, TS, TS)
           for p, c, s in rows]
    return spark.createDataFrame(out, REG)


def classes(df):
    return sorted((r.change, r.path) for r in df.collect())


def test_compat_classes_partition_scan(spark, sf):
    scan, reg = fx.scan_f1(spark, sf), fx.registry_f2(spark, sf)
    ch = D.detect_changes(scan, reg)
    scan_side = ch.filter(F.col("change").isin("new", "moved", "unchanged"))
    assert scan_side.count() == scan.count()
    assert scan_side.select("path").distinct().count() == scan.count()


def test_strict_inplace_edit_and_edit_back(spark):
    reg = reg_of(spark, [("a.pdf", "v2", "ACTIVE"), ("a.pdf", "v1", "INACTIVE")])
    ch = D.detect_changes_strict(scan_of(spark, [("a.pdf", "v1")]), reg)
    assert classes(ch) == [("MODIFIED", "a.pdf")]
    after = U.apply_changes_strict(reg, ch, NOW)
    st = {r.content_hash[:6]: r.status for r in after.collect()}
    import hashlib
    v1, v2 = (hashlib.sha256(x.encode()).hexdigest()[:6] for x in ("v1", "v2"))
    assert st[v1] == "ACTIVE" and st[v2] == "INACTIVE"
    assert after.count() == 2


def test_strict_scan_error_is_not_deleted(spark):
    reg = reg_of(spark, [("a.pdf", "x", "ACTIVE"), ("b.pdf", "y", "ACTIVE")])
    errs = spark.createDataFrame([("b.pdf", "unreadable")], "path string, error string")
    ch = D.detect_changes_strict(scan_of(spark, [("a.pdf", "x")]), reg, errs)
    assert classes(ch) == [("ERROR", "b.pdf"), ("UNCHANGED", "a.pdf")]


def test_strict_copy_keeps_both_active_and_is_stable(spark):
    reg = reg_of(spark, [("A.pdf", "h", "ACTIVE")])
    scan = scan_of(spark, [("A.pdf", "h"), ("B.pdf", "h")])
    scan = scan.checkpoint()
    reg2 = U.apply_changes_strict(reg, D.detect_changes_strict(scan, reg), NOW).checkpoint()
    assert sorted((r.path, r.status) for r in reg2.collect()) == [("A.pdf", "ACTIVE"), ("B.pdf", "ACTIVE")]
    for _ in range(2):
        ch = D.detect_changes_strict(scan, reg2)
        assert classes(ch) == [("UNCHANGED", "A.pdf"), ("UNCHANGED", "B.pdf")]
        # each run starts from a written registry, as the pipeline does
        reg2 = U.apply_changes_strict(reg2, ch, NOW).checkpoint()
    assert reg2.count() == 2


def test_compat_copy_reports_moved_like_reference(spark):
    reg = reg_of(spark, [("A.pdf", "h", "ACTIVE")])
    scan = scan_of(spark, [("A.pdf", "h"), ("B.pdf", "h")])
    ch = D.detect_changes(scan, reg)
    assert classes(ch) == [("moved", "B.pdf"), ("unchanged", "A.pdf")]


def test_strict_move_whose_source_was_edited(spark):
    reg = reg_of(spark, [("A.pdf", "h1", "ACTIVE")])
    ch = D.detect_changes_strict(scan_of(spark, [("A.pdf", "h2"), ("B.pdf", "h1")]), reg)
    got = {r.path: (r.change, r.old_path) for r in ch.collect()}
    assert got == {"A.pdf": ("MODIFIED", None), "B.pdf": ("MOVED", "A.pdf")}


def test_strict_two_new_paths_one_holder(spark):
    reg = reg_of(spark, [("old.pdf", "h", "ACTIVE")])
    ch = D.detect_changes_strict(scan_of(spark, [("n1.pdf", "h"), ("n2.pdf", "h")]), reg)
    assert classes(ch) == [("COPIED", "n2.pdf"), ("MOVED", "n1.pdf")]


def test_strict_resurrected_orphaned_deleted(spark):
    reg = reg_of(spark, [("r.pdf", "r", "INACTIVE"), ("o.pdf", "shared", "ACTIVE"),
                         ("keep.pdf", "shared", "ACTIVE"), ("d.pdf", "gone", "ACTIVE")])
    ch = D.detect_changes_strict(scan_of(spark, [("r.pdf", "r"), ("keep.pdf", "shared")]), reg)
    assert classes(ch) == [("DELETED", "d.pdf"), ("ORPHANED", "o.pdf"),
                           ("RESURRECTED", "r.pdf"), ("UNCHANGED", "keep.pdf")]


def test_row_number_within_equals_window_with_hot_group(spark):
    from pyspark.sql import Window
    rows = [("hot", f"p{i:05d}") for i in range(3000)] + [(f"g{i % 50}", f"q{i:05d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k string")
    got = row_number_within(df, "g", "k", partitions=16)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("long"))
    assert sorted(got.collect()) == sorted(want.select("g", "k", "rn").collect())


def test_hot_hash_holding_a_third_of_all_files(spark):
    """One content shared by a third of the files: classes stay exact, no
    per-hash list is built, and pairing spreads over many partitions."""
    import hashlib
    n = 3000
    files = [(f"f{i:05d}.pdf", "HOT" if i % 3 == 0 else f"c{i}") for i in range(n)]
    # registry: the hot content held by 400 old paths that are now gone, plus the current files
    reg_rows = [(f"old{i:04d}.pdf", "HOT", "ACTIVE") for i in range(400)] + \
               [(p, c, "ACTIVE") for p, c in files[:1500]]
    reg = reg_of(spark, reg_rows)
    scan = scan_of(spark, files)
    ch = D.detect_changes_strict(scan, reg).checkpoint()
    counts = dict((r.change, r.n) for r in D.change_counts(ch).collect())
    hot_new = sum(1 for i, (p, c) in enumerate(files) if c == "HOT" and i >= 1500)
    assert counts["UNCHANGED"] == 1500
    assert counts["MOVED"] == min(400, hot_new)
    assert counts["COPIED"] == hot_new - min(400, hot_new)
    assert counts["NEW"] == sum(1 for i, (p, c) in enumerate(files) if c != "HOT" and i >= 1500)
    dup = D.duplicate_hashes(scan)
    hot = hashlib.sha256(b"HOT").hexdigest()
    assert dup.filter(F.col("content_hash") == hot).count() == n // 3
    assert dup.filter(F.col("content_hash") == hot).select("copies").distinct().first()[0] == n // 3


def test_inplace_edit_compat_unchanged_strict_modified(spark):
    """SURVEY 2.11-a: the reference calls an in-place edit unchanged."""
    reg = reg_of(spark, [("a.pdf", "v1", "ACTIVE")])
    scan = scan_of(spark, [("a.pdf", "v2")])
    assert classes(D.detect_changes(scan, reg)) == [("unchanged", "a.pdf")]
    assert classes(D.detect_changes_strict(scan, reg)) == [("MODIFIED", "a.pdf")]


def test_row_number_within_stable_on_imbalanced_input(spark):
    """Imbalanced input partitions make Spark re-sample range bounds with an
    RDD-id seed; the numbering must still be exact and complete."""
    from pyspark.sql import Window
    big = spark.range(0, 30000, numPartitions=1).selectExpr("concat('g', cast(id % 7 as string)) g",
                                                             "concat('k', lpad(cast(id as string), 6, '0')) k")
    small = spark.range(30000, 30050, numPartitions=6).selectExpr("concat('g', cast(id % 7 as string)) g",
                                                                   "concat('k', lpad(cast(id as string), 6, '0')) k")
    df = big.unionByName(small).filter("k is not null")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("long"))
    w = sorted(want.collect())
    for _ in range(2):
        assert sorted(row_number_within(df, "g", "k", partitions=8).collect()) == w


def test_strict_golden_counts_sf01(spark):
    """Golden strict classes at sf0.1 (from the DuckDB oracle). At this size
    range bounds get re-sampled, which once broke the pairing rank."""
    sf01 = "/root/testdata/sf0.1"
    scan = fx.scan_f1(spark, sf01).checkpoint()
    reg = fx.registry_f2(spark, sf01).checkpoint()
    want = {"UNCHANGED": 6000, "MOVED": 1021, "COPIED": 80, "NEW": 899, "RESURRECTED": 1000,
            "DELETED": 882, "ORPHANED": 97}
    for _ in range(3):
        got = {r.change: r.n for r in D.change_counts(D.detect_changes_strict(scan, reg)).collect()}
        assert got == want
