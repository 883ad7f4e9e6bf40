"""Statistics kept up to date from what runs change equal a full count."""

import random

from pyspark.sql import functions as F

from pagewright.operators import stats as A
from pagewright.plans import pipeline as PL
from pagewright.schemas import DOCUMENTS_STATE, PAGES_STATE

NOW = "2024-06-01 00:00:00"


def same(kept, full):
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, full.collect()))


def all_equal(out):
    pages = out["state"].narrow()
    same(out["counts"].select(*A.STATUSES, "n"), A.status_counts(pages))
    for f in (A.processing_stats, A.processing_complete, A.stage_progress):
        same(f(out["counts"], "n"), f(pages))
    same(A.stage_progress(out["counts"], "n"), A.stage_progress(out["pages"]))


def test_counts_follow_the_runs(spark):
    def files(texts):
        return spark.createDataFrame(list(texts.items()), "path string, content string").coalesce(2)

    texts = {f"a/d{i}.pdf": f"Document {i} speaks. " * 70 for i in range(5)}
    out = PL.run_pipeline(PL.RunContext.create(spark, NOW), files(texts), spark.createDataFrame([], DOCUMENTS_STATE),
                          spark.createDataFrame([], PAGES_STATE))
    all_equal(out)
    assert out["complete"].first().complete

    # one goes, one is edited, one is new, and a model rejects some pages; the table isn't counted again
    del texts["a/d0.pdf"]
    texts |= {"a/d1.pdf": "Other words. " * 90, "b/new.pdf": "Bad words. " * 150}

    def embed_fn(pdf):
        import pandas as pd
        bad = pdf["text"].str.contains("Bad")
        return pd.DataFrame({"page_id": pdf["page_id"], "value": [[1.0]] * len(pdf),
                             "error": [("rejected" if b else None) for b in bad]})

    ctx = PL.RunContext.create(spark, NOW)
    wrong = out["counts"].withColumn("n", F.col("n") + 1000)
    second = PL.run_pipeline(ctx, files(texts), out["registry"], out["pages"], payload=out["payload"], index=out["index"],
                             embed_fn=embed_fn, counts=wrong)
    # what is added to the counts given doesn't depend on them
    shifted = second["counts"].alias("a").join(out["counts"].alias("b"), list(A.STATUSES), "left") \
        .select(*A.STATUSES, (F.col("a.n") - F.when(F.col("b.n").isNotNull(), 1000).otherwise(0)).alias("n")).filter("n <> 0")
    same(shifted, A.status_counts(second["state"].narrow()))
    ctx = PL.RunContext.create(spark, NOW)
    second = PL.run_pipeline(ctx, files(texts), out["registry"], out["pages"], payload=out["payload"], index=out["index"],
                             embed_fn=embed_fn, counts=out["counts"])
    all_equal(second)
    assert not second["complete"].first().complete
    assert second["run_state"].first().processed_documents == 4  # all but the rejected one

    # an index of another model: pages that were done are worked on again
    old = second["index"].withColumn("model", F.lit("older"))
    third = PL.run_pipeline(PL.RunContext.create(spark, NOW), files(texts), second["registry"], second["pages"],
                            payload=second["payload"], index=old, counts=second["counts"])
    all_equal(third)
    assert third["complete"].first().complete and third["run_state"].first().processed_documents == 5


def test_changes_add_up(spark):
    rng = random.Random(0)

    def rows(n):
        pick = lambda *x: rng.choice(x)
        return [(f"p{i}", pick("ACTIVE", "INACTIVE", None), *(pick("PENDING", "SUCCESS", "FAILED", None) for _ in range(4)))
                for i in range(n)]

    schema = "page_id string, status string, extracted string, summarized string, embedded string, indexed string"
    old, new = rows(300), rows(300)
    before = spark.createDataFrame(old, schema)
    changed = spark.createDataFrame(old[:50] + new[50:120] + old[140:] + [("x", *new[0][1:])], schema)  # 120-139 removed
    some, then = (spark.createDataFrame(r, schema) for r in (old[50:140], new[50:120] + [("x", *new[0][1:])]))
    counts = A.add_counts(A.status_counts(before), A.count_change(some, then))
    same(counts, A.status_counts(changed))
    for f in (A.processing_stats, A.processing_complete, A.stage_progress):
        same(f(counts, "n"), f(changed))
    same(A.add_counts(counts, A.count_change(changed, None)), A.status_counts(before.limit(0)))
    assert A.processing_stats(A.status_counts(before.limit(0)), "n").first().total_active_pages == 0
