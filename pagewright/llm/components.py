"""Connected components: forests inside a task, and alternating stars over an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


class Forest:
    """Groups of the numbers 0 to n - 1 that links have joined so far; a group's root is its smallest number.

    :meth:`join` gives back only the links that joined two groups, n - 1 at
    most, so what a task sends on is never more than its rows.
    """

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while True:
            above = self.up[r]
            if (above == r).all():
                break
            r = self.up[above]
        self.up[x] = r
        return r

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The positions of those links a[i], b[i] that joined two groups."""
        at = np.flatnonzero(self.roots(a) != self.roots(b))
        if not len(at):
            return at
        kept, up = [], self.up

        def root(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for i in at.tolist():
            x, y = root(a[i]), root(b[i])
            if x != y:
                up[max(x, y)] = min(x, y)
                kept.append(i)
        return np.array(kept, np.int64)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over canonical edges ``a < b``.

    Large star: every neighbour above a node is linked to the smallest of the
    node and its neighbours. Small star: the same with the neighbours below.
    """
    if large:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.filter("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        low = edges.groupBy("b").agg(F.min("a").alias("m"))
        hung = edges.join(low, "b")
        out = hung.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(
            low.select(F.col("m").alias("a"), "b"))
    return out.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for each node of an edge; ``root`` is the smallest node reachable.

    Each round writes its edges to the shared folder, so lineage stays short
    and a lost executor recomputes one round. Rounds grow with the logarithm
    of the longest chain; ends when every node hangs on a root directly.
    """
    cur = written(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                  .filter("a <> b").distinct(), "edges")
    while True:
        # done: no node is both a parent and a child, no child has two parents
        bad = (cur.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
               .join(cur.select(F.col("a").alias("p")).distinct(), F.col("b") == F.col("p"), "left")
               .filter("n > 1 or p is not null").limit(1).count())
        if not bad:
            break
        cur = written(_star(_star(cur, True), False), "edges")
    return cur.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        cur.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
