"""The index sink: a run is published as a whole or not at all."""

import json
import sys
import uuid

import pytest
from pyspark import cloudpickle

from pagewright.plans import pipeline as PL
from pagewright.schemas import DOCUMENTS_STATE, PAGE_INDEX, PAGES_STATE
from pagewright.sources.index_sink import FolderIndex, write_index

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows(spark, ids, text, parts=4):
    made = [(f"p{i}", f"d{i // 3}", f"{i:05d}", "ACTIVE", "g", "pdf", f"{text} {i}", None, [0.5, float(i)], "m") for i in ids]
    return spark.createDataFrame(made, PAGE_INDEX).repartition(parts)


def texts(index, spark):
    got = index.read(spark).collect()
    assert len({r.page_id for r in got}) == len(got)
    return {r.page_id: r.extracted_text for r in got}


class Dying(FolderIndex):
    """Fails in the task that gets page ``bad``, after other tasks may have staged."""

    def __init__(self, root, bad):
        super().__init__(root)
        self.bad = bad

    def stage(self, run, part, batches):
        held = list(batches)
        if any(self.bad in b.column(0).to_pylist() for b in held):
            raise RuntimeError("service gone")
        return super().stage(run, part, iter(held))


def test_runs_replace_pages(spark, tmp_path):
    index = FolderIndex(str(tmp_path))
    assert texts(index, spark) == {}
    write_index(rows(spark, range(20), "one"), index, "run-1")
    assert texts(index, spark) == {f"p{i}": f"one {i}" for i in range(20)}
    write_index(rows(spark, range(15, 30), "two"), index, "run-2")
    want = {f"p{i}": f"{'one' if i < 15 else 'two'} {i}" for i in range(30)}
    assert texts(index, spark) == want
    # a run that is written again counts once, with the place it had
    write_index(rows(spark, range(20), "one"), index, "run-1")
    assert texts(index, spark) == want and len(index.runs()) == 2
    write_index(rows(spark, [], "none"), index, "run-3")
    assert texts(index, spark) == want


def test_a_failed_task_publishes_nothing(spark, tmp_path):
    index = FolderIndex(str(tmp_path))
    write_index(rows(spark, range(10), "one"), index, "run-1")
    with pytest.raises(Exception):
        write_index(rows(spark, range(40), "two", 8), Dying(str(tmp_path), "p33"), "run-2")
    assert texts(index, spark) == {f"p{i}": f"one {i}" for i in range(10)}
    assert [r["run"] for r in index.runs()] == ["run-1"]
    write_index(rows(spark, range(40), "two", 8), index, "run-2")
    assert texts(index, spark) == {f"p{i}": f"two {i}" for i in range(40)}


def test_files_of_lost_attempts_do_not_count(spark, tmp_path):
    index = FolderIndex(str(tmp_path))
    batch = rows(spark, range(5), "lost").toArrow().to_batches()
    index.stage("run-1", "000000-0-lost", iter(batch))
    write_index(rows(spark, range(5), "kept"), index, "run-1")
    assert texts(index, spark) == {f"p{i}": f"kept {i}" for i in range(5)}
    assert json.loads(index.stage("run-9", "000001-0-x", iter([])))["part"] is None
    index.discard("run-1")  # what is published stays
    assert len(texts(index, spark)) == 5


def test_a_run_publishes_its_index_rows(spark, tmp_path):
    files = spark.createDataFrame([(f"a/d{i}.pdf", f"Document {i} speaks. " * 60) for i in range(3)], "path string, content string")
    state = spark.createDataFrame([], DOCUMENTS_STATE), spark.createDataFrame([], PAGES_STATE)
    run, index = f"run-{uuid.uuid4().hex}", FolderIndex(str(tmp_path))

    class Refusing(FolderIndex):
        def publish(self, run, messages):
            raise RuntimeError("no alias")

    with pytest.raises(Exception):
        PL.run_pipeline(PL.RunContext.create(spark, "2024-06-01 00:00:00", run_id=run), files, *state, sink=Refusing(str(tmp_path)))
    assert texts(index, spark) == {}
    ctx = PL.RunContext.create(spark, "2024-06-01 00:00:00", run_id=run)
    out = PL.run_pipeline(ctx, files, *state, sink=index)
    assert "embed_results" in ctx.reused and "index_rows" in ctx.reused and "index_results" not in ctx.reused
    assert texts(index, spark) == {r.page_id: r.extracted_text for r in out["index"].collect()} != {}
    assert out["complete"].first().complete
