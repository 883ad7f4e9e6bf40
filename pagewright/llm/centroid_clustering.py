"""k-means on integer vectors with a progressive search in the Walsh-Hadamard domain.

Components become integers ``floor(256 * x)``, so everything below is exact.
The Walsh-Hadamard transform H of 64 integers keeps distances up to a factor:
``|Hv - Hc|^2 = 64 |v - c|^2``. Its coefficients, ordered by sequency from
coarse to fine, are compared one group after another; the sum of squared
differences so far never exceeds the whole. The centroid that is nearest so
far is finished first; those whose sum already lies above its distance are
strictly worse and go. What is left is compared on all 64 coefficients, and of
equal distances the smaller number wins.

A round is one pass over the vectors: tasks add up components per cluster,
Spark adds those sums, and only 64 sums a cluster reach the driver.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

SIZE = 64
#: Coefficients known after each step of the search; the first step is one product for all pairs.
STEPS = (32, 48, 64)
#: Below this, sums of squares of transformed differences fit 64-bit integers; larger components are Python integers.
EXACT = 1 << 21
_BATCH = 4096


def _hadamard() -> np.ndarray:
    """The Hadamard matrix of order 64, rows by number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < SIZE:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")]


HADAMARD = _hadamard()


def transform(v: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of integer rows, coarse first; exact."""
    return v @ HADAMARD.T


def quantise(values: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` of double rows, as 64-bit integers or, where these might not do, Python integers."""
    q = np.floor(values * 256.0)
    if not q.size or np.abs(q).max() < EXACT:
        return q.astype(np.int64)
    if not np.isfinite(q).all():  # 256 * x is beyond a double
        return np.array([[int(x) * 256 for x in row] for row in values.tolist()], object).reshape(values.shape)
    return np.array([[int(x) for x in row] for row in q.tolist()], object).reshape(values.shape)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each integer row; ties to the smaller number."""
    if vectors.dtype == object or centroids.dtype == object or np.abs(centroids).max(initial=0) >= EXACT:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    v, c = transform(vectors), transform(centroids)
    n, at = len(v), STEPS[0]
    # the coarse step for all pairs at once: (x - y)^2 summed is x^2 + y^2 - 2xy
    x, y = v[:, :at], c[:, :at]
    table = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    first = table.argmin(1)
    rest = v[:, at:] - c[first, at:]
    best = table[np.arange(n), first] + (rest * rest).sum(1)
    row, cen = np.nonzero((table <= best[:, None]).astype(bool))
    so_far = table[row, cen]
    for upto in STEPS[1:]:
        d = v[row, at:upto] - c[cen, at:upto]
        so_far = so_far + (d * d).sum(1)
        at = upto
        # rows are sorted: the candidate of each row that is nearest so far, finished
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        low = np.minimum.reduceat(so_far, starts)
        first = np.flatnonzero(so_far == np.repeat(low, np.diff(np.append(starts, len(row)))))
        first = first[np.unique(row[first], return_index=True)[1]]
        rest = v[row[first], upto:] - c[cen[first], upto:]
        best = np.minimum(best, so_far[first] + (rest * rest).sum(1))
        live = (so_far <= best[row]).astype(bool)
        row, cen, so_far = row[live], cen[live], so_far[live]
    # all 64 are in: what is left is each row's nearest, smaller numbers first
    one = np.unique(row, return_index=True)[1]
    return cen[one], so_far[one] // SIZE


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of numbers, 64 each, as doubles."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, SIZE)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows with exactly 64 components, none null or non-finite."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter((F.size("embedding") == SIZE) & ~bad).select("vec_id", "embedding")


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """Quantised vectors with the ``k`` smallest SHA-256 of ``seed:vec_id``, in that order.

    Rows that repeat an id are ordered by their components; a null id is empty.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).toArrow()
    return quantise(_rows(rows.column("embedding").combine_chunks()))


def _sums(kept: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of each cluster that has vectors."""
    k = len(centroids)
    schema = "cluster int, place int, total decimal(38,0), n long"

    def run(batches):
        total, n = np.zeros((k, SIZE), object), np.zeros(k, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, _BATCH):
                v = quantise(_rows(b.column(0).slice(i, _BATCH)))
                own = nearest(v, centroids)[0]
                for c in np.unique(own):
                    total[c] = total[c] + v[own == c].sum(0)
                n += np.bincount(own, minlength=k)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, SIZE), pa.int32()), pa.array(np.tile(np.arange(SIZE), len(at)), pa.int32()),
             pa.array([Decimal(int(x)) for x in total[at].ravel()], pa.decimal128(38, 0)),
             pa.array(np.repeat(n[at], SIZE), pa.int64())], ["cluster", "place", "total", "n"])

    rows = (kept.select("embedding").mapInArrow(run, schema).groupBy("cluster", "place")
            .agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r.cluster, (r.n, [0] * SIZE))[1][r.place] = int(r.total)
    return out


def fit(kept: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> np.ndarray:
    """Integer centroids after ``rounds`` rounds; a centroid is its vectors' exact ``floor(sum / count)``."""
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return centroids
    for _ in range(rounds):
        new = centroids.astype(object)
        for c, (n, total) in _sums(kept, centroids).items():
            new[c] = [x // n for x in total]
        centroids = new.astype(np.int64) if np.abs(new).max() < EXACT else new
    return centroids


RESULT = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])


def assign(kept: DataFrame, centroids: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep``, ``cluster`` and ``distance`` of each vector (null where the distance doesn't fit a long)."""
    schema = T.StructType([kept.schema[c] for c in keep] + RESULT.fields)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, _BATCH):
                part = b.slice(i, _BATCH)
                if not part.num_rows:
                    continue
                own, far = nearest(quantise(_rows(part.column(part.schema.get_field_index("embedding")))), centroids)
                far = [x if x < 1 << 63 else None for x in far.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(own, pa.int32()),
                     pa.array(far, pa.int64())], schema.fieldNames())

    return kept.select(*dict.fromkeys([*keep, "embedding"])).mapInArrow(run, schema)


def centroid_clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id, cluster, distance, cluster_inertia, inertia`` per kept vector, final centroids).

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored.
    Rows whose embedding is null, has another length or a null or non-finite
    component have no result. Repeated rows come back repeated. With fewer
    than ``k`` vectors each starts a centroid; without any the result is
    empty. Components of any finite size are exact as long as their sums have
    at most 38 digits; distances and inertias beyond a long are null.
    """
    kept = kept_vectors(vectors)
    centroids = fit(kept, k, rounds, seed)
    if not len(centroids):
        schema = T.StructType([kept.schema["vec_id"], *RESULT.fields, T.StructField("cluster_inertia", T.LongType()),
                               T.StructField("inertia", T.LongType())])
        return kept.sparkSession.createDataFrame([], schema), centroids
    rows = written(assign(kept, centroids, ["vec_id"]), "clusters")
    # a row a cluster: k rows, whatever the input
    known = F.count("distance") == F.count(F.lit(1))
    sums = rows.groupBy("cluster").agg(F.when(known, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s")).collect()
    whole = None if any(r.s is None for r in sums) else sum(r.s for r in sums)
    as_long = {r.cluster: None if r.s is None or r.s >= 1 << 63 else int(r.s) for r in sums}
    own = F.lit(None).cast("long")
    for c, s in as_long.items():
        own = F.when(F.col("cluster") == c, F.lit(s).cast("long")).otherwise(own)
    whole = None if whole is None or whole >= 1 << 63 else int(whole)
    return rows.select("vec_id", "cluster", "distance", own.alias("cluster_inertia"),
                       F.lit(whole).cast("long").alias("inertia")), centroids


def op11_centroid_clustering(spark, sf_dir):
    """Query: cluster, distance, inertias and the digest of its final centroid for every vector."""
    rows, centroids = centroid_clusters(table(spark, sf_dir, "embeddings"))
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return rows.withColumn("centroid_sha256", F.array(*map(F.lit, digests))[F.col("cluster")] if digests
                           else F.lit(None).cast("string"))


def _op11_sql(k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """The rounds written out, one after the other."""
    steps = [f"""
q as materialized (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
  where len(embedding) = {SIZE} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (select (row_number() over (order by sha256('{seed}:' || vec_id)) - 1)::int c, v from q
  order by c limit {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (select vec_id, v, min(struct_pack(d := d, c := c)) b from
  (select q.vec_id, q.v, c{r}.c, list_sum(list_transform(range(1, {SIZE + 1}),
    lambda i: (q.v[i] - c{r}.v[i]) * (q.v[i] - c{r}.v[i])))::bigint d from q, c{r})
  group by vec_id, v)""")
        if r < rounds:
            steps.append(f"""
s{r} as (select b.c c, i, sum(v[i])::bigint s, count(*) n from a{r}, range(1, {SIZE + 1}) t(i) group by b.c, i),
n{r} as (select c, list((s - ((s % n) + n) % n) // n order by i) v from s{r} group by c),
c{r + 1} as materialized (select c{r}.c, coalesce(n{r}.v, c{r}.v) v from c{r} left join n{r} using (c))""")
    last = f"a{rounds}"
    return "with" + ",".join(steps) + f"""
select vec_id, b.c::int as cluster, b.d as distance, sum(b.d) over (partition by b.c)::bigint cluster_inertia,
  sum(b.d) over ()::bigint inertia, sha256(array_to_string(c{rounds}.v, ',')) centroid_sha256
from {last} join c{rounds} on c{rounds}.c = b.c
"""


OP11_SQL = _op11_sql()
