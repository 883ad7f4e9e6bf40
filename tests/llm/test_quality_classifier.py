import random

import numpy as np
import pytest

from pagewright.llm import quality_classifier as C
from pagewright.llm.toxicity import fold


def test_statistics():
    s = dict(zip(C.STATISTICS, C.statistics_of("Aa bb bb\nAa bb bb\ncc## 12")))
    assert s["words"] == 8 and s["longest_word"] == 4 and s["distinct_share"] == 0.5 and s["line_words"] == 8 / 3
    assert s["doubled_share"] == 2 / 8 and s["dup_line_share"] == pytest.approx(1 / 3) and s["symbol_word_share"] == 1 / 8
    assert C.statistics_of("") == C.statistics_of(" \n") == [0.0] * len(C.STATISTICS)


def sample(n=1500):
    rng = np.random.default_rng(0)
    x = rng.random((n, len(C.STATISTICS)))
    x[:, 3] = rng.integers(0, 3, n)  # ties
    y = ((x[:, 0] > 0.6) & (x[:, 1] < 0.5) | (x[:, 3] == 2)).astype(float)
    return x, y


def test_rules_recover_conjunctions():
    x, y = sample()
    e = C.fit(x[:1000], y[:1000])
    z = np.array([np.logical_and.reduce([b.of(x) for b in r]) for r in e.rules], float)
    p = 1 / (1 + np.exp(-(e.intercept + np.array(e.weights) @ z)))
    assert ((p[1000:] > 0.5) == y[1000:]).mean() > 0.97
    assert len(e.rules) < len(C.grow(x[:1000], y[:1000]))  # the penalty drops rules
    assert any(len(r) > 1 for r in e.rules)


def test_the_column_is_the_model(spark):
    x, y = sample(300)
    e = C.fit(x, y)
    z = np.array([np.logical_and.reduce([b.of(x) for b in r]) for r in e.rules], float)
    p = 1 / (1 + np.exp(-(e.intercept + np.array(e.weights) @ z)))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(C.STATISTICS)).coalesce(1)
    got = [r.score for r in df.select(e.column().alias("score")).collect()]
    assert got == pytest.approx(p.tolist(), abs=1e-9)


def test_lasso_is_at_its_optimum():
    rng = np.random.default_rng(1)
    z = (rng.random((400, 12)) > 0.5).astype(float)
    y = (z[:, 0] + z[:, 1] + rng.random(400) > 1.3).astype(float)
    w, b = C.lasso(z, y, 0.02)
    g = z.T @ (1 / (1 + np.exp(-(z @ w + b))) - y) / 400
    assert np.abs(g[w == 0]).max() <= 0.02 + 1e-4
    assert np.abs(g[w != 0] + 0.02 * np.sign(w[w != 0])).max() < 1e-4 and (w == 0).any()


def test_repeated_bounds_of_a_path_are_one():
    b = C.Bound
    assert C._simple((b(1, 5.0, False), b(1, 3.0, False), b(1, 1.0, True), b(1, 2.0, True))) == (b(1, 2.0, True), b(1, 3.0, False)) \
        or C._simple((b(1, 5.0, False), b(1, 3.0, False))) == (b(1, 3.0, False),)


def test_no_labels_or_one(odd_docs, no_docs, no_labels, spark):
    own = odd_docs.drop("score")
    got = C.classify(own, no_labels, ["doc_id", "ids"]).collect()
    assert len(got) == own.count() and {r.score for r in got} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in C.classify(own, ones, ["doc_id"]).collect())
    assert C.classify(no_docs, ones, ["doc_id"]).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = C.op9_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_are_not_used(spark, sf):
    from pyspark.sql import functions as F
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.score) for r in C.classify(docs, x, ["doc_id"]).collect()) for x in (labels, other))
    assert a == b


def test_a_smaller_sample_still_scores_every_row(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    assert C.classify(docs, labels, ["doc_id"], sample_rows=40).count() == docs.count()


def test_query_matches_brute_force(spark, sf):
    """Statistics, folds, rules and scores row by row; only the fit, tested above, is the operator's."""
    import math
    import zlib
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality is not None}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in docs}
    stats = {i: list(map(float, C.statistics_of(t or ""))) for i, t in docs}
    known = sorted(i for i, _ in docs if i in labels and not held[i])
    e = C.fit(np.array([stats[i] for i in known]), np.array([float(labels[i]) for i in known]))
    assert e.rules

    def score(x):
        margin = e.intercept
        for rule, w in zip(e.rules, e.weights):
            if all((x[b.statistic] > b.value) == b.above for b in rule):
                margin += w
        return 1 / (1 + math.exp(-margin))

    got = C.op9_quality_classifier(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.score == pytest.approx(score(stats[r.doc_id]), abs=1e-9)
        assert r.held_out == held[r.doc_id] and r.predicted == int(r.score >= 0.3)
