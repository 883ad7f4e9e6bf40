"""The page state as a table that is folded bucket by bucket."""

import os

import pytest
from pyspark.sql import functions as F

from pagewright.operators.mutations import patch_pages
from pagewright.plans.state_table import StateTable

COLUMNS = "page_id string, extracted_text string, extracted string, error_message string, updated_at timestamp_ntz"
PATCH = "page_id string, seq long, extracted_text string, extracted string, error_message string, updated_at timestamp_ntz"


def pages(spark, n):
    return spark.range(n).selectExpr("concat('p', id) page_id", "repeat(concat('old ', id, ' '), 20) extracted_text",
                                     "'PENDING' extracted", "cast(null as string) error_message",
                                     "timestamp_ntz'2024-01-01 00:00:00' updated_at")


def patches(spark, ids, seq, text):
    rows = [(f"p{i}", seq, f"{text} {i}", "SUCCESS", None) for i in ids]
    return spark.createDataFrame(rows, "page_id string, seq long, extracted_text string, extracted string, error_message string") \
        .withColumn("updated_at", F.expr("timestamp_ntz'2024-02-02 00:00:00'"))


def content(df):
    return sorted(map(repr, df.select("page_id", "extracted_text", "extracted", "updated_at").collect()))


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(os.path.join(root, "rows"))
            for f in names if f.endswith(".parquet")}


def test_only_buckets_with_many_patches_are_written(spark, tmp_path):
    root = str(tmp_path / "state")
    base = pages(spark, 1000)
    t = StateTable.create(base, PATCH, root, 16)
    where = {r.page_id: r.bucket for r in t._rows().select("page_id", "bucket").collect()}
    hot = [int(p[1:]) for p, b in where.items() if b in (3, 11)]
    few = [next(int(p[1:]) for p, b in where.items() if b == k) for k in (0, 5)]
    one, two = patches(spark, hot + few, 1, "new"), patches(spark, hot[:30], 1, "newer")
    t.append(one, 1)
    t.append(two, 2)
    want = content(patch_pages(base, one.unionByName(two.withColumn("seq", F.lit(9).cast("long")))))
    assert content(t.read()) == want
    counts = {r.bucket: (r.rows, r.patches) for r in t.patch_counts().collect()}
    assert len(counts) == 16 and counts[0][1] == 1 and counts[1][1] == 0 and sum(c[1] for c in counts.values()) == len(hot) + 32

    before = files(root)
    assert t.compact(0.5) == [3, 11]
    after = files(root)
    # the other 14 buckets have the files they had
    assert {f for f in before if "bucket=3/" not in f and "bucket=11/" not in f} == before.keys() & after.keys()
    assert all(before[f] == after[f] for f in before.keys() & after.keys())
    assert content(StateTable(spark, root).read()) == want
    left = {r.bucket: r.patches for r in t.patch_counts().collect() if r.patches}
    assert left == {0: 1, 5: 1} and t.compact(0.5) == []
    assert t.compact(0.0) == [0, 5] and content(t.read()) == want and t._log() is None


def test_a_compaction_that_died_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "state")
    base = pages(spark, 200)
    t = StateTable.create(base, PATCH, root, 4)
    one = patches(spark, range(150), 1, "new")
    t.append(one, 1)
    want = content(patch_pages(base, one))
    with monkeypatch.context() as m:
        m.setattr(StateTable, "_drop_log", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.compact()
    assert content(t.read()) == want  # folded, and the log still over it
    t.append(one, 1)  # a run appended again is there once
    assert sum(r.patches for r in t.patch_counts().collect()) == 150
    assert t.compact() == [0, 1, 2, 3] and content(t.read()) == want
    t.add(pages(spark, 210).filter("substring(page_id, 2)::int >= 200"))
    assert t.read().count() == 210 and t.read().select("page_id").distinct().count() == 210
    with pytest.raises(ValueError):
        StateTable(spark, str(tmp_path / "none"))
