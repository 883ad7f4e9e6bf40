"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

A sketch has ``SIZE`` coordinates. In each of the first ``SIZE`` rounds every
shingle of a document's set is hashed to one coordinate and a value, and a
coordinate that is still empty keeps the smallest value it gets, marked with
the round. Round ``SIZE + i`` sends all shingles to coordinate ``i``, so after
``2 * SIZE`` rounds every coordinate of every set that isn't empty is filled.
Large sets are done after one or two rounds. The share of equal coordinates of
two sketches is concentrated around the similarity of the sets as if each
coordinate were drawn alone.

Candidates share a band of ``ROWS`` coordinates. At the similarity of 0.85 a
pair shares none of the 32 bands with probability (1 - 0.85 ** 5) ** 32, under
1e-8. All that follows is exact: no candidate counts before 100 times the
intersection of the whole sets has been compared with 85 times their union.

Documents with equal sets are one class from the start. In each bucket the
classes are first compared with the bucket's smallest one, which needs a row
per member. Only buckets whose classes are still apart then compare all
classes that earlier links haven't joined, in blocks of bounded size, and a
task sends no more links than it has classes. Sets are built for classes in
shared buckets only.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_column, per_slice, slices, table, written
from .components import Forest, components

#: Coordinates of a sketch and of a band.
SIZE, ROWS = 160, 5
BANDS = SIZE // ROWS
#: Shingles of a bucket's block; a task compares two blocks at a time.
BLOCK = 1 << 20
#: Bits (by logarithm) of the bitmaps of live buckets and rows: 8 MiB whatever their number.
BITMAP_BITS = 26

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_EMPTY = np.uint64(2**64 - 1)


def shingle_set(text: bytes, words: int = 3) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of a UTF-8 text, A-Z as a-z.

    Fewer words than ``words`` are one shingle; no words, no shingles.
    """
    found = _WORD.findall(text.lower())
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[words - 1:] if len(found) >= words else ends[-1:]
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(joined[a:z]) for a, z in zip(starts.tolist(), last.tolist())], np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """A row of ``size`` filled coordinates for each set that isn't empty (empty sets stay unfilled)."""
    out = np.full(len(sets) * size, _EMPTY)
    h = np.concatenate([*sets, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for r in range(2 * size):
        z = _mixed(h + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % 2**64))
        if r < size:
            at = ((z >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            at = np.full(len(h), r - size)
        cell = owner * size + at
        free = out[cell] == _EMPTY
        np.minimum.at(out, cell[free], np.uint64(r << 32) | (z[free] & np.uint64(0xFFFFFFFF)))
        open_ = (out.reshape(-1, size) == _EMPTY).any(1)[owner]
        h, owner = h[open_], owner[open_]
        if not len(h):
            break
    return out.reshape(-1, size)


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of each sketch."""
    parts = sketch.reshape(len(sketch), -1, rows)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _class_of(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _row_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def sketched(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, key, n, cls, bands`` of each row: size and class (128-bit digest) of its set, and band keys.

    A row without words has n 0 and neither class nor bands.
    """
    rows = _row_key(docs)
    schema = T.StructType([rows.schema["doc_id"], rows.schema["key"], T.StructField("n", T.LongType()),
                           T.StructField("cls", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def of(b):
        sets = [shingle_set(t, words) for t in byte_column(b, "text")]
        keys = bands(sketches(sets))
        none = np.array([not len(s) for s in sets], bool)
        offsets = pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()), mask=pa.array(none))
        return {"doc_id": b.column(b.schema.get_field_index("doc_id")), "key": b.column(b.schema.get_field_index("key")),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "cls": pa.array([_class_of(s) for s in sets], pa.binary()), "bands": lists}

    return per_slice(rows, of, schema)


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """64-bit words of a bitmap of the leading bits of a long column; as large for any number of rows."""
    at = F.shiftrightunsigned(column, 64 - BITMAP_BITS)
    words = (keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("bits")).toArrow())
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``band, cls``: members of the buckets that hold two classes or more, each class once (written).

    ``rows`` as :func:`sketched` gives them. Which buckets these are is an
    aggregate of two longs; a bitmap of them keeps the other rows out of the
    shuffle.
    """
    each = rows.filter("n > 0").select(F.xxhash64("cls").alias("c"), F.explode("bands").alias("band"))
    live = written(each.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                   .filter("lo <> hi").select("band"), "live-buckets")
    bits = rows.sparkSession.sparkContext.broadcast(bitmap(live, "band"))

    def members(batches):
        for b in batches:
            keys = b.column(1).flatten().to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(_in_bitmap(bits.value, keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), b.column(0).take(pa.array(hit // BANDS))], ["band", "cls"])

    found = rows.filter("n > 0").select("cls", "bands").mapInArrow(members, "band long, cls binary").distinct()
    return written(found.join(live, "band", "left_semi"), "members")


def class_sets(docs: DataFrame, classes: DataFrame, words: int = 3) -> DataFrame:
    """``cls, n, hashes`` of ``classes`` (``cls, key`` of a row that has the set), written once each."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(classes, "key"))

    def built(batches):
        for b in slices(batches):
            keys = b.column(b.schema.get_field_index("key"))
            b = b.filter(pa.array(_in_bitmap(bits.value, keys.to_numpy(zero_copy_only=False))))
            if not b.num_rows:
                continue
            sets = [shingle_set(t, words) for t in byte_column(b, "text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class_of(s) for s in sets], pa.binary()), b.column(b.schema.get_field_index("key")),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["cls", "key", "n", "hashes"])

    rows = _row_key(docs).mapInArrow(built, "cls binary, key long, n long, hashes binary")
    wanted = classes.select("cls", "key")
    once = rows.groupBy("cls", "key").agg(F.any_value("n").alias("n"), F.any_value("hashes").alias("hashes"))
    return written(once.join(wanted, ["cls", "key"], "left_semi").select("cls", "n", "hashes"), "sets")


def enough(n1, n2, both, percent: int):
    """Whether the intersection is ``percent`` of the union or more, in whole numbers."""
    return 100 * both >= percent * (n1 + n2 - both)


def _verified(percent: int):
    """Of rows ``a, z, ha, hz`` those whose whole sets are similar enough, as ``a, z``."""

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                n1, n2 = len(x), len(y)
                ok.append(enough(n1, n2, min(n1, n2), percent)
                          and enough(n1, n2, len(np.intersect1d(x, y, assume_unique=True)), percent))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "z"]).filter(pa.array(ok, pa.bool_()))

    return run


def group_links(sets: list[np.ndarray], roots: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join all similar sets of one group.

    ``roots`` numbers the sets' groups so far; sets of one group aren't
    compared. ``side``: -1 compares all sets with each other, else those of
    side 0 with those of side 1.
    """
    n = np.array([len(s) for s in sets], np.int64)
    own = np.unique(roots, return_inverse=True)[1]
    forest, out = Forest(len(own)), []
    right = np.flatnonzero(side != 0)
    values = np.concatenate([*(sets[i] for i in right), np.empty(0, np.uint64)])
    owners = np.repeat(right, n[right])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    for x in np.flatnonzero(side != 1).tolist():
        with_ = right[right > x] if side[x] == -1 else right
        with_ = with_[enough(n[x], n[with_], np.minimum(n[x], n[with_]), percent)]
        with_ = with_[forest.roots(own[with_]) != forest.roots(own[[x]])]
        if not len(with_):
            continue
        lo, hi = np.searchsorted(values, sets[x]), np.searchsorted(values, sets[x], "right")
        size = hi - lo
        at = np.arange(size.sum()) + np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        both = np.bincount(owners[at], minlength=len(sets))[with_]
        near = with_[enough(n[x], n[with_], both, percent)]
        for k in forest.join(np.full(len(near), own[x]), own[near]).tolist():
            out.append((x, int(near[k])))
    return out


def _grouped(percent: int):
    """Links ``a, z`` of the sorted rows ``band, lo, hi, block, cls, root, hashes``, group by group."""

    def done(group: pa.Table):
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        block = group.column("block").to_numpy()
        side = np.full(len(block), -1) if lo == hi else (block == hi).astype(np.int64)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in group.column("hashes").chunks for x in c]
        roots = np.unique(np.array(group.column("root").to_pylist(), object), return_inverse=True)[1]
        cls = group.column("cls").to_pylist()
        found = group_links(sets, roots, side, percent)
        return [cls[a] for a, _ in found], [cls[z] for _, z in found]

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            keys = np.stack([held.column(c).to_numpy() for c in ("band", "lo", "hi")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            start = 0
            for cut in cuts.tolist():
                a, z = done(held.slice(start, cut - start))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(z, pa.binary())], ["a", "z"])
                start = cut
            held = held.slice(start)
        if held is not None and len(held):
            a, z = done(held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(z, pa.binary())], ["a", "z"])

    return run


def class_roots(docs: DataFrame, rows: DataFrame, classes: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """``node, root`` of the classes that are linked with another one."""
    members = shared_buckets(rows)
    alive = members.select("cls").distinct()
    sets = class_sets(docs, written(classes.join(alive, "cls", "left_semi").select("cls", "key"), "live-classes"), words)

    def with_sets(pairs, node, name):
        return pairs.join(sets.select(F.col("cls").alias(node), F.col("hashes").alias(name)), node)

    centre = members.groupBy("band").agg(F.min("cls").alias("a"))
    star = members.join(centre, "band").filter("cls <> a").select("a", F.col("cls").alias("z")).distinct()
    pairs = with_sets(with_sets(star, "z", "hz"), "a", "ha").select("a", "z", "ha", "hz")
    first = components(written(pairs.mapInArrow(_verified(percent), "a binary, z binary"), "star-links"), "a", "z")
    first = written(first, "star-roots")

    # buckets whose classes are still apart; one of those with the same members is enough
    named = written(members.join(first, F.col("cls") == F.col("node"), "left")
                    .select("band", "cls", F.coalesce("root", "cls").alias("root")), "named-members")
    sign = (F.count(F.lit(1)), F.sum(F.xxhash64("cls").cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(1), "cls")))
    short = F.xxhash64("root")
    apart = written(named.groupBy("band").agg(F.min(short).alias("lo"), F.max(short).alias("hi"),
                                              *(s.alias(f"s{i}") for i, s in enumerate(sign)))
                    .filter("lo <> hi").groupBy("s0", "s1", "s2").agg(F.min("band").alias("band")).select("band"), "apart")
    rest = named.join(apart, "band").join(sets, "cls")
    # a short row a bucket, written so that Spark can split a large bucket's rows in the joins
    weight = written(named.join(apart, "band").join(sets.select("cls", "n"), "cls").groupBy("band")
                     .agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks")), "weights")
    own = F.pmod(F.xxhash64(F.lit(2), "cls"), F.col("blocks")).cast("int")
    dealt = (rest.join(weight, "band").select("band", own.alias("block"), "blocks", "cls", "root", "hashes")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                     "block", "cls", "root", "hashes"))
    more = written(dealt.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi", "cls")
                   .mapInArrow(_grouped(percent), "a binary, z binary"), "bucket-links")
    if not more.limit(1).count():
        return first
    return components(first.select(F.col("node").alias("a"), F.col("root").alias("z")).union(more), "a", "z")


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs`` (``doc_id, text``; other columns are ignored).

    Documents are linked if the intersection of their sets of distinct
    ``words``-word shingles is ``percent`` of the union or more;
    ``component_id`` is the smallest doc_id reachable. Null, empty and blank
    texts have no shingles and are linked with nothing: their component is
    their own id. Repeated rows come back repeated, and are kept or not
    alike. A null doc_id belongs to its group and names it only if all its ids
    are null; it is kept only then.
    """
    rows = written(sketched(docs, words), "sketches")
    classes = written(rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("first"), F.min("key").alias("key")),
                      "classes")
    roots = class_roots(docs, rows, classes, words, percent, block)
    named = written(classes.join(roots, F.col("cls") == F.col("node"), "left")
                    .select("cls", "first", F.coalesce("root", "cls").alias("root")), "roots")
    groups = named.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = rows.filter("n > 0").join(named.join(groups, "root").select("cls", "component_id"), "cls")
    alone = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (linked.select("doc_id", "n", "component_id").union(alone)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def op13_minhash(spark, sf_dir):
    """Query: set size, component and whether it is kept for every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with recursive w as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
g as materialized (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) s from w),
n as materialized (select doc_id, count(*) n from g group by doc_id),
p as materialized (select a.doc_id a, b.doc_id b, count(*) i from g a join g b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 85 * (x.n + y.n - i)),
e as materialized (select a, b from l union all select b, a from l),
r as (select doc_id d, doc_id c from documents union select e.b, r.c from r join e on e.a = r.d)
select w.doc_id, coalesce(n, 0)::bigint n_shingles, min(c) component_id, w.doc_id = min(c) kept
from w left join n using (doc_id) join r on r.d = w.doc_id group by w.doc_id, n
"""
