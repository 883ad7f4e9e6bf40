"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on the statistics of labelled documents. Every
path from a root to a node is a rule, a conjunction of bounds on statistics.
A logistic model with an L1 penalty weighs the rules and drops most of them;
what is left is one Spark column expression over the statistics.

The trees and weights are fitted on the driver on at most about
``SAMPLE_ROWS`` labelled rows, chosen by a hash of the id; the statistics and
scores cover every row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, no_clash, slices, table, text_column, written
from .quality_rules import CLASSES, character_classes, repeated_words
from .toxicity import fold

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, LEAST_ROWS, RATE = 24, 3, 32, 10, 0.3
PENALTY = 0.002

_WORD = re.compile("[^\\x20\\x09-\\x0D]+")
STATISTICS = ("words", "mean_word", "longest_word", "distinct_share", "repeated_share", "doubled_share",
              "line_words", "dup_line_share", "capital_share", "vowel_share", "symbol_share", "stop_share",
              "digit_share", "ascii_mark_share", "other_share", "symbol_word_share")
_EDGE_SYMBOL = re.compile(r"[#*$%&|<>!]{2,}$|^[#*$%&|<>]$")


def statistics_of(text: str) -> list[float]:
    """The ``STATISTICS`` of a text; all zero for an empty one."""
    words = _WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    distinct = set(words)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    c = dict(zip(CLASSES, (character_classes(text) / len(text)).tolist()))
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    odd = {w for w in distinct if _EDGE_SYMBOL.search(w)}
    return [float(n), sum(map(len, words)) / n, float(max(map(len, distinct))), len(distinct) / n,
            repeated_words(words) / n, doubled / n, n / len(lines), 1 - len(set(lines)) / len(lines),
            c["capital"], c["vowel"], c["symbol"], c["stop"], c["digit"], c["other-ascii"], c["other"],
            sum(map(odd.__contains__, words)) / n if odd else 0.0]


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and one double column per statistic; null text is empty."""
    full = T.StructType([docs.schema[c] for c in keep] + [T.StructField(s, T.DoubleType()) for s in STATISTICS])
    arrow = arrow_schema(full)

    def run(batches):
        for b in slices(batches):
            x = np.array([statistics_of(t) for t in text_column(b, "text")]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep]
                                             + [pa.array(x[:, i]) for i in range(x.shape[1])], schema=arrow)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, full)


@dataclass(frozen=True, order=True)
class Bound:
    """``statistic <= value`` or, with ``above``, ``statistic > value``."""

    statistic: int
    value: float
    above: bool

    def of(self, x: np.ndarray) -> np.ndarray:
        at = x[:, self.statistic]
        return at > self.value if self.above else at <= self.value

    def column(self) -> Column:
        at = F.col(STATISTICS[self.statistic])
        return at > self.value if self.above else at <= self.value


Rule = tuple[Bound, ...]


def _simple(path: Rule) -> Rule:
    """The path with only its tightest bound per statistic and side."""
    best: dict = {}
    for b in path:
        k = (b.statistic, b.above)
        if k not in best or (b.value > best[k].value) == b.above:
            best[k] = b
    return tuple(sorted(best.values()))


def grow(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of gradient-boosted trees on log loss, every node but the roots, without repeats."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    binned = [np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)]  # bin k: value <= edges[k]
    margin = np.full(len(y), np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        step = np.zeros(len(y))
        nodes = [((), np.arange(len(y)))]
        for depth in range(DEPTH + 1):
            below = []
            for path, rows in nodes:
                step[rows] = g[rows].sum() / (h[rows].sum() + 1.0)
                if path:
                    rules[_simple(path)] = None
                split = _best_split(binned, edges, g, h, rows) if depth < DEPTH else None
                if split:
                    j, k = split
                    low = binned[j][rows] <= k
                    v = float(edges[j][k])
                    below += [((*path, Bound(j, v, False)), rows[low]), ((*path, Bound(j, v, True)), rows[~low])]
            nodes = below
        margin += RATE * step
    return list(rules)


def _best_split(binned, edges, g, h, rows):
    best, at = 1e-6, None
    total_g, total_h = g[rows].sum(), h[rows].sum()
    for j, e in enumerate(edges):
        if not len(e):
            continue
        b = binned[j][rows]
        gs, hs, ns = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
        gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
        gain[(ns < LEAST_ROWS) | (len(rows) - ns < LEAST_ROWS)] = 0
        k = int(gain.argmax())
        if gain[k] > best:
            best, at = gain[k], (j, k)
    return at


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 2000) -> tuple[np.ndarray, float]:
    """Weights and intercept of logistic regression on 0/1 rules with an L1 penalty, by accelerated proximal steps."""
    n, k = z.shape
    a = np.hstack([z, np.ones((n, 1))])
    rate = 4 / max(1e-9, np.linalg.eigvalsh(a.T @ a / n)[-1])
    w = np.zeros(k + 1)
    w[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    v, t = w.copy(), 1.0
    for _ in range(steps):
        grad = a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -30, 30))) - y) / n
        new = v - rate * grad
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t2 * (new - w)
        if np.abs(new - w).max() < 1e-7:
            w = new
            break
        w, t = new, t2
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        """The probability of label 1 as an expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, w in zip(self.rules, self.weights):
            holds = rule[0].column()
            for b in rule[1:]:
                holds = holds & b.column()
            total = total + F.when(holds, F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """One label only, or none: the smoothed rate for every text."""
    if len(y) == 0 or y.min() == y.max():
        return Ensemble((), (), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    rules = grow(x, y)
    z = np.array([np.logical_and.reduce([b.of(x) for b in r]) for r in rules], float).reshape(len(rules), len(y)).T
    w, intercept = lasso(z, y)
    kept = np.flatnonzero(w)
    return Ensemble(tuple(rules[i] for i in kept), tuple(float(w[i]) for i in kept), intercept)


def classify(docs: DataFrame, labels: DataFrame, keep: list[str], label: str = "quality",
             threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``keep`` (with ``doc_id``), ``score`` and ``predicted`` of each row of ``docs``.

    Learns from labelled rows of folds 1 to 4; repeated labels of an id count
    once, the larger wins. Null texts are empty; repeated rows score alike.
    Columns outside ``keep`` are ignored; one in ``keep`` that has the name of a
    result or a statistic is an error.
    """
    no_clash(keep, (*STATISTICS, "__y", "score", "predicted"))
    stats = written(statistics(docs, keep), "statistics")
    y = (labels.filter(fold() != 0).filter(F.col(label).isNotNull())
         .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("__y")))
    known = written(stats.filter(fold() != 0).join(y, "doc_id").select("doc_id", *STATISTICS, "__y"), "labelled")
    share = min(1.0, sample_rows / max(1, known.count()))
    rows = (known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
            .orderBy("doc_id", *STATISTICS).drop("doc_id").toArrow())  # about sample_rows rows
    x = np.array([rows.column(s).to_numpy() for s in STATISTICS]).T.reshape(-1, len(STATISTICS))
    score = fit(x, rows.column("__y").to_numpy().astype(float)).column()
    scored = stats.select(*keep, score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_quality_classifier(spark, sf_dir):
    """Query: the quality score of every document."""
    out = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")
