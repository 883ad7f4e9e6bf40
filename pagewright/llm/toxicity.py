"""Toxicity by class-conditional Kneser-Ney models of expressions.

An expression is a lower-cased word; its letters are scored by an n-gram model
of its class (toxic or ordinary documents). Only the longest n-grams have
counts of their own in each class. Everything rarer backs off to one shared
Kneser-Ney chain of continuation counts over both classes, so an expression
that neither class has seen gives the same likelihood in both and says
nothing. The difference of the two log-likelihoods is divided by the number of
n-grams of the expression; a document is as toxic as its strongest expression,
so the length of a text doesn't dilute it.

Counts take each expression once per document, over all labelled rows of three
folds of five; a fourth fold fits the scale of the score, the last is held out.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_per_input, slices, table, text_column, written

ORDER = 5
DISCOUNT = 0.75
#: n-grams that are sent to every task at most (16 bytes each); a larger model is joined instead.
SENT_NGRAMS = 4_000_000
#: Expressions a task remembers, and n-grams it counts before passing them on.
KEPT_WORDS, KEPT_NGRAMS = 150_000, 150_000
#: Width of the bins in which calibration scores are counted.
BIN = 0.02

_EXPRESSION = re.compile(r"[^\W_]+")


def expressions(text: str) -> set[str]:
    return set(_EXPRESSION.findall(text.lower()))


def ngrams(word: str, order: int = ORDER) -> list[str]:
    s = "^" * (order - 1) + word + "$"
    return [s[i:i + order] for i in range(len(word) + 1)]


def fold(doc_id="doc_id"):
    """crc32 of the id's text mod 5; a null id is in fold 0, never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)), F.lit(0)).cast("int")


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``text, y`` of the labelled rows of folds 2 to 4; repeated labels of an id count once, the larger wins.

    Labels grow with the documents, so they are merged with them at any size.
    """
    y = (labels.filter(fold() >= 2).filter(F.col(label).isNotNull())
         .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")))
    return docs.filter(fold() >= 2).select("doc_id", "text").join(y.hint("merge"), "doc_id").select("text", "y")


def count_ngrams(rows: DataFrame) -> DataFrame:
    """``g, n0, n1``: documents' expressions with the n-gram, ordinary and toxic, over all rows."""
    part = pa.schema([("g", pa.string()), ("n0", pa.int64()), ("n1", pa.int64())])

    def run(batches):
        seen: dict = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()),
                                              pa.array([v[0] for v in seen.values()], pa.int64()),
                                              pa.array([v[1] for v in seen.values()], pa.int64())], schema=part)
            seen.clear()
            return out

        for b in slices(batches):
            words: dict = {}
            for text, y in zip(text_column(b, "text"), b.column(1).to_pylist()):
                for w in expressions(text):
                    n = words.get(w)
                    if n is None:
                        n = words[w] = [0, 0]
                    n[y] += 1
            for w, (n0, n1) in words.items():
                for g in ngrams(w):
                    n = seen.get(g)
                    if n is None:
                        n = seen[g] = [0, 0]
                    n[0] += n0
                    n[1] += n1
            if len(seen) >= KEPT_NGRAMS:
                yield flush()
        yield flush()

    counted = rows.select("text", "y").mapInArrow(run, "g string, n0 long, n1 long")
    return counted.groupBy("g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _shared(top: DataFrame) -> DataFrame:
    """``g, p`` for the n-grams one shorter than the longest: the interpolated
    Kneser-Ney chain of continuation counts, both classes together."""
    types = {ORDER - 1: top.groupBy(F.substring("g", 2, ORDER - 1).alias("g")).agg(F.count(F.lit(1)).alias("c"))}
    for k in range(ORDER - 2, 0, -1):
        types[k] = types[k + 1].groupBy(F.substring("g", 2, k).alias("g")).agg(F.count(F.lit(1)).alias("c"))
    t, v = types[1].agg(F.coalesce(F.sum("c"), F.lit(1)), F.count(F.lit(1))).first()
    p = types[1].select("g", (F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) / t
                              + DISCOUNT * v / t / (v + 1)).alias("p"))
    for k in range(2, ORDER):
        of = Window.partitionBy("h")
        t = (types[k].withColumn("h", F.substring("g", 1, k - 1))
             .withColumns({"t": F.sum("c").over(of), "v": F.count(F.lit(1)).over(of)})
             .withColumn("low", F.substring("g", 2, k - 1)))
        p = t.join(p.select(F.col("g").alias("low"), F.col("p").alias("q")), "low").select(
            "g", (F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) / F.col("t")
                  + DISCOUNT * F.col("v") / F.col("t") * F.col("q")).alias("p"))
    return p


def model(grams: DataFrame) -> DataFrame:
    """``g, llr``: log ratio of the toxic and the ordinary probability of each
    n-gram, and under ``g`` without its last letter that of any other letter
    after the same context (written; empty without labels)."""
    top = written(grams, "ngrams")
    of = Window.partitionBy("h")
    t = (top.withColumn("h", F.substring("g", 1, ORDER - 1))
         .withColumns({f"t{y}": F.sum(f"n{y}").over(of) for y in (0, 1)}
                      | {f"v{y}": F.sum((F.col(f"n{y}") > 0).cast("long")).over(of) for y in (0, 1)})
         .withColumn("low", F.substring("g", 2, ORDER - 1))
         .join(_shared(top).toDF("low", "q"), "low"))

    def weight(y):
        return F.when(F.col(f"t{y}") > 0, DISCOUNT * F.col(f"v{y}") / F.col(f"t{y}")).otherwise(F.lit(1.0))

    def prob(y):
        own = F.when(F.col(f"t{y}") > 0, F.greatest(F.col(f"n{y}") - DISCOUNT, F.lit(0.0)) / F.col(f"t{y}"))
        return F.coalesce(own, F.lit(0.0)) + weight(y) * F.col("q")

    t = written(t.select("g", "h", F.log(prob(1) / prob(0)).alias("llr"),
                         F.log(weight(1) / weight(0)).alias("other")), "ngram-scores")
    return t.select("g", "llr").union(t.groupBy("h").agg(F.first("other")))


def _hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all n-grams of the words, those of their contexts, and where each word begins."""
    points = np.frombuffer("".join("^" * (ORDER - 1) + w + "$" for w in words).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(length + ORDER) - (length + ORDER)
    first = np.cumsum(length + 1) - (length + 1)
    at = np.repeat(start - first, length + 1) + np.arange(int((length + 1).sum()))
    context = np.zeros(len(at), np.uint64)
    for k in range(ORDER - 1):
        context = mix(context, points[at + k])
    return mix(context, points[at + ORDER - 1]), context, first


def mix(h: np.ndarray, point: np.ndarray) -> np.ndarray:
    h = (h ^ point.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def hash_of(grams: list[str]) -> np.ndarray:
    """The same hashes for strings of the model."""
    out = np.zeros(len(grams), np.uint64)
    for size in {len(g) for g in grams}:
        at = np.array([i for i, g in enumerate(grams) if len(g) == size])
        points = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le"), np.uint32).reshape(-1, size)
        h = np.zeros(len(at), np.uint64)
        for k in range(size):
            h = mix(h, points[:, k])
        out[at] = h
    return out


def word_scores(words: list[str], keys: np.ndarray, llr: np.ndarray) -> np.ndarray:
    """Length-normalised log-likelihood difference of each word."""
    if not len(keys):
        return np.zeros(len(words))
    gram, context, first = _hashes(words)

    def look(h):
        i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[i] == h, llr[i], np.nan)

    x = look(gram)
    miss = np.isnan(x)
    x[miss] = np.nan_to_num(look(context[miss]))
    return np.add.reduceat(x, first) / (np.diff(np.append(first, len(x))))


def strongest(docs: DataFrame, scores: DataFrame, keep: list[str], sent: int = SENT_NGRAMS) -> DataFrame:
    """``keep`` and ``raw``: the strongest expression of each text, 0 without any.

    The model goes to the tasks if its row count is at most ``sent``, else
    distinct expressions are joined with it; both give the same.
    """
    if scores.count() > sent:
        return _strongest_by_join(docs, scores, keep)
    tab = scores.toArrow()
    keys, llr = hash_of(tab.column("g").to_pylist()), tab.column("llr").to_numpy()
    order = np.argsort(keys)
    shared = docs.sparkSession.sparkContext.broadcast((keys[order], llr[order]))
    known: dict[str, float] = {}

    def of(batch):
        keys, llr = shared.value
        found = [expressions(t) for t in text_column(batch, "text")]
        new = list(set().union(*found) - known.keys())
        if len(known) + len(new) > KEPT_WORDS:
            known.clear()
            new = list(set().union(*found))
        for i in range(0, len(new), 1 << 16):
            part = new[i:i + (1 << 16)]
            known.update(zip(part, word_scores(part, keys, llr).tolist()))
        return {"raw": [max(map(known.__getitem__, ws)) if ws else 0.0 for ws in found]}

    return row_per_input(docs, of, T.StructType([T.StructField("raw", T.DoubleType())]), keep)


def _strongest_by_join(docs: DataFrame, scores: DataFrame, keep: list[str]) -> DataFrame:
    words = T.StructType([T.StructField("__words", T.ArrayType(T.StringType()))])
    rows = row_per_input(docs.withColumn("__row", F.struct(F.monotonically_increasing_id(), F.xxhash64(*keep))),
                         lambda b: {"__words": [sorted(expressions(t)) for t in text_column(b, "text")]},
                         words, [*keep, "__row"])
    rows = written(rows, "expressions")
    pairs = rows.select("__row", F.explode("__words").alias("w"))
    distinct = pairs.select("w").distinct()
    padded = F.concat(F.lit("^" * (ORDER - 1)), "w", F.lit("$"))
    grams = distinct.select("w", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") + 1),
                                                       lambda i: F.substring(padded, i, F.lit(ORDER)))).alias("g"))
    full = scores.filter(F.length("g") == ORDER).toDF("g", "x")
    ctx = scores.filter(F.length("g") == ORDER - 1).toDF("c", "o")
    value = (grams.join(full, "g", "left").withColumn("c", F.substring("g", 1, ORDER - 1)).join(ctx, "c", "left")
             .groupBy("w").agg(F.avg(F.coalesce("x", "o", F.lit(0.0))).alias("s")))
    best = pairs.join(value, "w").groupBy("__row").agg(F.max("s").alias("raw"))
    return rows.join(best, "__row", "left").select(*keep, F.coalesce("raw", F.lit(0.0)).alias("raw"))


def fit_scale(hist: list[tuple[float, int, int]]) -> tuple[float, float]:
    """``(slope, offset)`` of the logistic curve through counted scores
    ``(score, label, rows)``, with smoothed targets so that separable classes
    give a finite slope. One class or none: slope 1, offset the log odds of the
    smoothed rates, and none of the rows decides."""
    n1, n0 = sum(n for _, y, n in hist if y), sum(n for _, y, n in hist if not y)
    if not n1 or not n0:
        return 1.0, math.log((n1 + 0.5) / (n0 + 0.5)) if hist else -1.0
    x = np.array([s for s, _, _ in hist])
    w = np.array([n / (n1 if y else n0) for _, y, n in hist])  # classes weigh the same
    t = np.array([(n1 + 1) / (n1 + 2) if y else 1 / (n0 + 2) for _, y, _ in hist])
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta[0] * x + beta[1], -30, 30)))
        grad = np.array([(w * (t - p) * x).sum(), (w * (t - p)).sum()]) - 1e-3 * beta * [1, 0]
        v = w * np.maximum(p * (1 - p), 1e-6)
        hess = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sent: int = SENT_NGRAMS):
    """The n-gram scores (a written table) and the scale of the score."""
    scores = written(model(count_ngrams(labelled(docs, labels, label))), "toxicity-model")
    y = (labels.filter(fold() == 1).filter(F.col(label).isNotNull())
         .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")))
    raw = strongest(docs.filter(fold() == 1), scores, ["doc_id"], sent)
    hist = (raw.join(y, "doc_id").groupBy(F.round(F.col("raw") / BIN).alias("bin"), "y")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("bin", "y"))
    return scores, fit_scale([(r.bin * BIN, r.y, r.n) for r in hist.collect()])


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, sent: int = SENT_NGRAMS) -> DataFrame:
    """``keep`` (all columns by default), ``score`` (0 to 1) and ``predicted`` of each row of ``docs``.

    Null texts are empty; a text without expressions has the neutral raw score
    0. Repeated rows are scored alike. Without labels of both classes the score
    is flat around the smoothed base rate.
    """
    scores, (slope, offset) = fit(docs, labels, sent=sent)
    keep = keep or docs.columns
    raw = strongest(docs, scores, keep, sent)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("raw") + F.lit(offset))))
    return raw.select(*keep, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op8_toxicity(spark, sf_dir):
    """Query: the toxicity score of every document."""
    out = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")
