"""A run that dies is started again and goes on after its last finished stage."""

import os
import uuid

import pytest

from pagewright.plans import manifest as M
from pagewright.plans import pipeline as PL
from pagewright.schemas import DOCUMENTS_STATE, PAGES_STATE

NOW = "2024-06-01 00:00:00"


def called(folder, name):
    return len([f for f in os.listdir(folder) if f.startswith(name)])


def plugin(folder, name, dies_without=None):
    """A model that leaves a file per call, and ends its worker until ``dies_without`` exists."""
    def run(pdf):
        import pandas as pd
        if dies_without and not os.path.exists(dies_without):
            os._exit(1)
        open(os.path.join(folder, f"{name}-{uuid.uuid4().hex}"), "w").close()
        value = [[1.0, 2.0]] * len(pdf) if name == "embed" else [f"{name} of {i}" for i in pdf["page_id"]]
        return pd.DataFrame({"page_id": pdf["page_id"], "value": value, "error": None})
    run.__qualname__ = name
    return run


@pytest.fixture
def tables(spark):
    files = spark.createDataFrame([(f"a/d{i}.pdf", f"Document {i} speaks. " * 60) for i in range(4)] + [("b/none.pdf", None)],
                                  "path string, content string").coalesce(2)
    return files, spark.createDataFrame([], DOCUMENTS_STATE), spark.createDataFrame([], PAGES_STATE)


def rows_of(df, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in df.collect())


def test_only_later_stages_run_again(spark, tables, tmp_path):
    files, registry, pages = tables
    folder, alive = str(tmp_path), str(tmp_path / "alive")

    def attempt(run_id, files=files, now=NOW):
        ctx = PL.RunContext.create(spark, now, run_id=run_id)
        out = PL.run_pipeline(ctx, files, registry, pages, extract_fn=plugin(folder, "extract"),
                              summary_fn=plugin(folder, "summary"), embed_fn=plugin(folder, "embed", alive))
        return ctx, out

    run = f"run-{uuid.uuid4().hex}"
    with pytest.raises(Exception):
        attempt(run)
    first = called(folder, "extract"), called(folder, "summary"), called(folder, "embed")
    assert first[0] and first[1] and not first[2]
    events = M.Manifest(spark, PL.RunContext.create(spark, NOW, run_id=run).root).events()
    assert events[-1][1] == "FAILED" and [e[2] for e in events if e[1] == "RUNNING"][-1] == "embed"

    open(alive, "w").close()
    # a later clock doesn't change what the run writes
    ctx, out = attempt(run, now="2024-07-01 00:00:00")
    assert {"scan_all", "changes", "registry", "split", "extract_results", "summary_results", "status_summary"} <= set(ctx.reused)
    assert not {"embed_results", "index_rows", "index_results"} & set(ctx.reused)
    assert (called(folder, "extract"), called(folder, "summary")) == first[:2] and called(folder, "embed")
    state = out["run_state"].first()
    assert state.status == "COMPLETED" and state.total_documents == 4 and state.processed_documents == 4

    # the same rows as a run that never died
    whole_ctx, whole = attempt(f"run-{uuid.uuid4().hex}")
    assert not whole_ctx.reused
    for name, columns in (("pages", PAGES_STATE.fieldNames()), ("registry", DOCUMENTS_STATE.fieldNames()),
                          ("index", ["page_id", "extracted_text", "summary", "embedding", "model"])):
        assert rows_of(out[name], *columns) == rows_of(whole[name], *columns)
    assert out["stats"].first() == whole["stats"].first() and out["complete"].first().complete

    # a finished run started once more does nothing, changed inputs are worked on again
    before = called(folder, "")
    ctx, _ = attempt(run)
    assert called(folder, "") == before and "index_results" in ctx.reused
    more = files.union(spark.createDataFrame([("a/new.pdf", "New words. " * 200)], files.schema))
    ctx, out = attempt(run, files=more)
    assert not ctx.reused and called(folder, "extract") > first[0]
    assert out["registry"].count() == 5


def test_half_a_table_is_made_again(spark):
    run = f"run-{uuid.uuid4().hex}"
    made = []

    def make(n):
        def f():
            made.append(n)
            return spark.range(n)
        return f

    ctx = PL.RunContext.create(spark, NOW, run_id=run)
    ctx.input("x", spark.range(3))
    assert ctx.stage("t", make(5), ["x"]).count() == 5
    again = PL.RunContext.create(spark, NOW, run_id=run)
    again.input("x", spark.range(3).repartition(3))
    assert again.stage("t", make(5), ["x"]).count() == 5 and made == [5]
    assert again.stage("t", make(6), ["x"], params="other").count() == 6
    # the marker goes before the table is written anew, so a crash leaves none
    def dies():
        raise RuntimeError("gone")
    with pytest.raises(RuntimeError):
        again.stage("t", dies, ["x"], params="third")
    assert again.manifest.committed("t") is None
    last = PL.RunContext.create(spark, NOW, run_id=run)
    last.input("x", spark.range(3))
    assert last.stage("t", make(7), ["x"], params="other").count() == 7


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    one = M.fingerprint(df)
    assert M.fingerprint(df.orderBy("i", ascending=False).repartition(4)) == one
    assert M.fingerprint(df.limit(2)) != one and M.fingerprint(df.distinct()) != one
    assert M.fingerprint(df, ["i"]) == M.fingerprint(df.withColumn("s", df.i), ["i"]) != one
    assert M.fingerprint(df.limit(0)) == M.fingerprint(df.filter("i > 9"))


def test_unnamed_runs_leave_no_markers(spark, tables):
    ctx = PL.RunContext.create(spark, NOW)
    PL.sync(ctx, *tables)
    assert not ctx.prints and not os.path.exists(os.path.join(ctx.root, "_committed"))
