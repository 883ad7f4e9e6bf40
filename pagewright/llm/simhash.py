"""SimHash near-duplicates: fingerprints joined on a grid of segment popcounts.

A fingerprint of 64 bits is cut into 32 segments of two bits and embedded as
the vector of their bit counts. The Manhattan distance of two vectors is never
more than the bit distance, so fingerprints at ``distance`` bits or fewer lie
at Manhattan distance ``distance`` or less. One of the two halves of the
vectors then differs by half of that at most; a fingerprint enters, for each
half, the grid points within half of that again (a quarter of ``distance``,
rounded up), and two such halves always share a point. Fingerprints of one
grid point are compared by Manhattan distance, then exactly by bits.

Rows with equal fingerprints are one class from the start, so copies never
meet each other in the join. A grid point with more than ``HOT_POINT``
fingerprints is dealt over pairs of blocks in a second pass, as many as keep a
pair of blocks at ``HOT_POINT`` fingerprints. A task joins what it compares
into a forest and sends only the links that joined two of its groups.
"""

from __future__ import annotations

import re
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_column, row_per_input, table, written
from .components import Forest, components

SEED = 42
#: Fingerprints of a grid point that one task compares; more go to the second pass.
HOT_POINT = 20_000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, repeats included.

    A-Z count as a-z. A text of fewer words than ``shingle`` is one shingle;
    a text without words has fingerprint zero.
    """
    words = _WORD.findall(text.lower())
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    for i in range(0, n, 1 << 16):
        h = np.array([digest(joined[a:z], SEED) for a, z in zip(starts[i:min(n, i + (1 << 16))].tolist(),
                                                                last[i:i + (1 << 16)].tolist())], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fp`` (the 64 bits as a signed long) of each row; null text is empty."""

    def of(batch):
        fps = np.array([fingerprint(t, shingle) for t in byte_column(batch, "text")], np.uint64)
        return {"fp": pa.array(fps.view(np.int64))}

    return row_per_input(docs.select(*keep, "text"), of,
                         T.StructType([T.StructField("fp", T.LongType())]), list(keep))


def popcounts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, one row per fingerprint."""
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1)
    return bits[:, 0::2] + bits[:, 1::2]


def _grid_points(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, index of the fingerprint) for the grid points within ``radius`` of each half vector."""
    vec = popcounts(fp).astype(np.int64)
    weight = 3 ** np.arange(16, dtype=np.int64)
    moves = [(i, s) for i in range(16) for s in (1, -1)]
    keys, owner = [], []
    for half in (0, 1):
        v = vec[:, 16 * half:16 * half + 16]
        base = v @ weight
        for r in range(radius + 1):
            for step in combinations_with_replacement(moves, r):
                shift = np.zeros(16, np.int64)
                for i, s in step:
                    shift[i] += s
                if np.abs(shift).sum() < r:
                    continue
                to = v[:, shift != 0] + shift[shift != 0]
                ok = np.flatnonzero(((to >= 0) & (to <= 2)).all(1))
                keys.append((base[ok] + shift @ weight) * 2 + half)
                owner.append(ok)
    return np.concatenate(keys), np.concatenate(owner)


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Whether a[i], b[i] are within ``distance`` bits: the Manhattan bound first, then exactly."""
    ok = np.zeros(len(a), bool)
    for i in range(0, len(a), 1 << 16):
        x, y = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
        bound = np.abs(popcounts(x).astype(np.int8) - popcounts(y).astype(np.int8)).sum(1) <= distance
        left = np.flatnonzero(bound)
        ok[i + left] = np.bitwise_count(x[left] ^ y[left]) <= distance
    return ok


def _links_in(points: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of equal grid point that join all that are near each other; ``points`` is sorted.

    Pairs that earlier links have joined aren't compared, and no more links
    come out than there are different fingerprints.
    """
    own, at = np.unique(fp, return_inverse=True)
    forest, out = Forest(len(own)), []
    live, lag = np.arange(len(fp) - 1), 1
    while len(live):
        live = live[live + lag < len(fp)]
        live = live[points[live] == points[live + lag]]
        a, b = at[live], at[live + lag]
        apart = np.flatnonzero(forest.roots(a) != forest.roots(b))
        a, b = a[apart], b[apart]
        ok = near(own[a], own[b], distance)
        a, b = a[ok], b[ok]
        out.append(np.stack([a, b])[:, forest.join(a, b)])
        lag += 1
    a, b = np.concatenate([*out, np.empty((2, 0), np.int64)], axis=1)
    return own[a].view(np.int64), own[b].view(np.int64)


_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                      T.StructField("point", T.LongType())])


def _compare(distance: int, hot: int):
    """Links of the sorted rows ``point, fp``; those of a point with over ``hot`` rows come back with the point set."""
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("point", pa.int64())])

    def done(points, fp):
        a, b = _links_in(points, fp, distance)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                           pa.nulls(len(a), pa.int64())], schema=fields)

    def set_aside(point, fp):
        x = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(x), pa.array(np.full(len(x), point))], schema=fields)

    def run(batches):
        points, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        flood = None  # the hot point whose rows pass straight through
        for batch in batches:
            p = batch.column(0).to_numpy(zero_copy_only=False)
            points = np.concatenate([points, p])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if flood is not None:
                n = int(np.searchsorted(points, flood, "right"))
                yield set_aside(flood, fp[:n])
                points, fp = points[n:], fp[n:]
                if not len(points):
                    continue
                flood = None
            cut = int(np.searchsorted(points, points[-1])) if len(points) else 0
            head, tail = (points[:cut], fp[:cut]), (points[cut:], fp[cut:])
            points, fp = tail
            yield from of_whole(*head)
            if len(points) > hot:
                flood = int(points[0])
                yield set_aside(flood, fp)
                points, fp = points[:0], fp[:0]
        if len(points):
            yield from of_whole(points, fp)

    def of_whole(points, fp):
        if not len(points):
            return
        at = np.flatnonzero(np.concatenate(([True], points[1:] != points[:-1])))
        size = np.diff(np.append(at, len(points)))
        for i in np.flatnonzero(size > hot):
            yield set_aside(int(points[at[i]]), fp[at[i]:at[i] + size[i]])
        keep = np.repeat((size > 1) & (size <= hot), size)
        if keep.any():
            yield done(points[keep], fp[keep])

    return run


def _compare_blocks(distance: int):
    """Links of one hot point between two blocks of its fingerprints (or within one) that join all that are near."""

    def run(key, tab):
        fp = tab.column("fp").to_numpy().view(np.uint64)
        block = tab.column("block").to_numpy()
        left, right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        forest, out = Forest(len(fp)), []
        for x in left:
            hit = right[np.bitwise_count(fp[right] ^ fp[x]) <= distance]
            a = np.full(len(hit), x)
            out.append(np.stack([a, hit])[:, forest.join(a, hit)])
        a, b = np.concatenate([*out, np.empty((2, 0), np.int64)], axis=1)
        return pa.table({"a": pa.array(fp[a].view(np.int64)), "b": pa.array(fp[b].view(np.int64))})

    return run


def links(fps: DataFrame, distance: int = 4, hot: int = HOT_POINT) -> DataFrame:
    """``a, b``: pairs of different fingerprints ``fp`` at ``distance`` bits or fewer, such that every
    two fingerprints that near are joined by a chain of pairs.

    ``fps`` has distinct fingerprints. A task sends at most as many pairs as
    it has fingerprints; pairs may repeat.
    """
    radius = -(-(distance // 2) // 2)
    grid = pa.schema([("point", pa.int64()), ("fp", pa.int64())])

    def embed(batches):
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(x), 4096):
                part = x[i:i + 4096]
                point, at = _grid_points(part.view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(point), pa.array(part[at])], schema=grid)

    points = fps.select("fp").mapInArrow(embed, "point long, fp long")
    found = written(points.repartition("point").sortWithinPartitions("point")
                    .mapInArrow(_compare(distance, hot), _LINK), "links")
    near_pairs = found.filter("point is null").select("a", "b")
    aside = found.filter("point is not null")
    if aside.limit(1).count() == 0:
        return near_pairs
    size = aside.groupBy("point").agg(F.ceil(F.count(F.lit(1)) / (hot / 2)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")
    dealt = (aside.join(size, "point").select("point", F.col("a").alias("fp"), block.alias("block"), "blocks")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))
    blocks = dealt.groupBy("point", "lo", "hi").applyInArrow(_compare_blocks(distance), "a long, b long")
    return near_pairs.union(blocks)


def _grouped(fps: DataFrame, distance: int, hot: int) -> DataFrame:
    """``fps`` (written rows with ``doc_id, fp``) with ``root, component_id``."""
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(classes, distance, hot), "a", "b")
    named = written(classes.join(roots, F.col("fp") == F.col("node"), "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "classes")
    groups = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(named.join(groups, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, hot: int = HOT_POINT) -> DataFrame:
    """``doc_id, fp, component_id`` per row of ``docs`` (``doc_id, text``; other columns are ignored).

    ``component_id`` is the smallest doc_id reachable over links of
    ``distance`` bits or fewer. Null and empty texts share fingerprint zero
    and are linked like any other. Repeated rows come back repeated; a null
    doc_id belongs to its group, and names it only if all its ids are null.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    return _grouped(fps, distance, hot).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = 4, distance: int = 4, hot: int = HOT_POINT) -> DataFrame:
    """One row of ``docs`` per near-duplicate group, all columns kept: the smallest doc_id stays.

    Null ids come after all others; of rows that repeat an id in one group,
    one stays. Rows are found again by two hashes of id and text, so texts
    are shuffled once, and only here.
    """
    h1, h2 = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "text", "doc_id")
    fps = written(fingerprints(docs.select("doc_id", "text", h1.alias("h1"), h2.alias("h2")), shingle,
                               ("doc_id", "h1", "h2")), "fingerprints")
    kept = (_grouped(fps, distance, hot)
            .groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h1", "h2")).alias("k"))
            .select(F.col("k.h1").alias("__k1"), F.col("k.h2").alias("__k2")))
    rows = docs.withColumns({"__h1": h1, "__h2": h2}).join(
        kept, [F.col("__h1") == F.col("__k1"), F.col("__h2") == F.col("__k2")], "left_semi")
    first = F.row_number().over(Window.partitionBy("__h1", "__h2").orderBy(F.lit(0)))
    return rows.withColumn("__n", first).filter("__n = 1").select(*docs.columns)


def op2_simhash(spark, sf_dir):
    """Query: the fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
