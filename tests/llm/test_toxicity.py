import math
import zlib

import numpy as np
import pytest

from pagewright.llm import toxicity as X


@pytest.fixture(scope="module")
def labelled(spark):
    bad, good = ["sluk", "sluko", "slukar", "grobs"], ["tree", "house", "river", "stone", "cloud", "bread", "treen"]
    rows, labels = [], []
    for i in range(300):
        words = [good[(i * 7 + k) % 7] + "aeiou"[(i + k) % 5] for k in range(12)]
        if i % 4 == 0:
            words[i % 12] = bad[i // 4 % 4]
        rows.append((i, " ".join(words).title()))
        labels.append((i, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def brute_model(rows):
    """log ratio of an expression under the two models, from dictionaries of counts."""
    n, top = X.ORDER, [{}, {}]
    for text, y in rows:
        for w in X.expressions(text):
            for g in X.ngrams(w):
                top[y][g] = top[y].get(g, 0) + 1
    types = {n: set(top[0]) | set(top[1])}
    cont = {}
    for k in range(n - 1, 0, -1):
        cont[k] = {}
        for g in types[k + 1]:
            cont[k][g[1:]] = cont[k].get(g[1:], 0) + 1
        types[k] = set(cont[k])

    def shared(g):
        k, h = len(g), g[:-1]
        if k == 0:
            return 1 / (len(types[1]) + 1)
        same = [c for x, c in cont[k].items() if x[:-1] == h]
        return max(cont[k].get(g, 0) - X.DISCOUNT, 0) / sum(same) + X.DISCOUNT * len(same) / sum(same) * shared(g[1:])

    def p(y, g):
        same = [c for x, c in top[y].items() if x[:-1] == g[:-1]]
        if not same:
            return shared(g[1:])
        return (max(top[y].get(g, 0) - X.DISCOUNT, 0) + X.DISCOUNT * len(same) * shared(g[1:])) / sum(same)

    def score(w):
        total = 0.0
        for g in X.ngrams(w):
            if g in types[n]:
                total += math.log(p(1, g) / p(0, g))
            else:  # any letter not seen after this context: the shared part cancels out
                lam = [[c for x, c in top[y].items() if x[:-1] == g[:-1]] for y in (0, 1)]
                r = [X.DISCOUNT * len(s) / sum(s) if s else 1.0 for s in lam]
                total += math.log(r[1] / r[0])
        return total / (len(w) + 1)
    return score


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def test_scores_match_plain_kneser_ney(spark, labelled):
    docs, labels = labelled
    y = {r.doc_id: r.toxic for r in labels.collect()}
    score = brute_model([(r.text, y[r.doc_id]) for r in docs.collect() if fold(r.doc_id) >= 2])
    model = X.model(X.count_ngrams(X.labelled(docs, labels, "toxic"))).toArrow()
    keys, llr = X.hash_of(model.column("g").to_pylist()), model.column("llr").to_numpy()
    order = np.argsort(keys)
    words = ["sluk", "slukos", "treea", "grobsu", "unseen", "q", "stoneo", "ñandú"]
    assert X.word_scores(words, keys[order], llr[order]) == pytest.approx([score(w) for w in words], abs=1e-9)


def test_held_out_documents_are_told_apart(spark, labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = X.toxicity(docs, labels).collect()
    assert len(got) == 300 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if fold(r.doc_id) == 0]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)


def test_a_model_too_large_to_send_is_joined(spark, labelled):
    docs, labels = labelled
    odd = docs.union(spark.createDataFrame([(None, None), (5, ""), (6, "?!"), (7, "sluk"), (7, "sluk")], docs.schema))
    sent, joined = (sorted((str(r.doc_id), round(r.score, 12)) for r in X.toxicity(odd, labels, sent=n).collect())
                    for n in (X.SENT_NGRAMS, 0))
    assert sent == joined and len(sent) == 305


def test_odd_rows_and_no_labels(odd_docs, no_docs, no_labels, labelled):
    _, labels = labelled
    docs = odd_docs.drop("raw", "score")
    assert X.toxicity(docs, no_labels).count() == docs.count()
    assert {r.predicted for r in X.toxicity(docs, no_labels).collect()} == {0}
    assert X.toxicity(no_docs.drop("raw", "score"), labels).count() == 0
    one = labels.withColumn("toxic", labels.toxic * 0)
    assert {r.predicted for r in X.toxicity(docs, one, ["doc_id"]).collect()} == {0}


def test_labels_of_the_held_out_fold_are_not_used(spark, labelled):
    docs, labels = labelled
    from pyspark.sql import functions as F
    other = labels.withColumn("toxic", F.when(X.fold() == 0, 1 - labels.toxic).otherwise(labels.toxic))
    a, b = (sorted((r.doc_id, r.score) for r in X.toxicity(docs, x).collect()) for x in (labels, other))
    assert a == b
