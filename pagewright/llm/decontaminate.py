"""Benchmark decontamination by greedy string tiling.

Three words in a row, the least tile, are a seed. A document is a candidate for
an item if the seeds they share hold 80 % of the item's words; no tiling covers
more. A candidate's words are tiled: the longest common run that is not
covered yet, on either side, is marked again and again until none of three
words or more is left. Karp-Rabin hashes of runs of one length find the
matches, each is compared word by word before it counts, and the length goes
down from the longest. An item whose words are covered to 80 % is leaked, in
whatever order the pieces stand. Items of one or two words are looked for whole.

The benchmark goes to the tasks in blocks of bounded size; documents pass the
blocks one after the other, so no document is shuffled. Equal items are one with
a count, and items are dealt by a hash of id and text, so that neither repeated
items nor a repeated id make a block larger. Between two blocks the documents are
written, and the driver lets go of a block before it takes the next.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, slices, table, text_column, written

TILE_WORDS, COVERAGE = 3, 0.8
#: Letters of benchmark text sent to the tasks at a time.
BLOCK_LETTERS = 32 << 20

_WORD = re.compile(r"\w+")
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _runs(ids: list[int], covered: bytearray, size: int):
    """``(start, hash)`` of each uncovered run of ``size`` ids, by a rolling hash; negative ids end a run."""
    lead = pow(_BASE, size - 1, _PRIME)
    h = n = 0
    for i, x in enumerate(ids):
        if x < 0 or covered[i]:
            h = n = 0
            continue
        if n == size:
            h = (h - (ids[i - size] + 1) * lead) % _PRIME
            n -= 1
        h = (h * _BASE + x + 1) % _PRIME
        n += 1
        if n == size:
            yield i - size + 1, h


def tiles(item: list[int], doc: list[int], least: int = TILE_WORDS) -> list[tuple[int, int, int]]:
    """``(length, start in item, start in document)`` of the greedy tiling: longest runs first,
    then by place in the item, then in the document. Negative ids match nothing."""
    in_item, in_doc, out = bytearray(len(item)), bytearray(len(doc)), []
    size = min(len(item), len(doc))
    while size >= least:
        places: dict[int, list[int]] = {}
        for a, h in _runs(item, in_item, size):
            places.setdefault(h, []).append(a)
        found = [(a, d) for d, h in _runs(doc, in_doc, size) for a in places.get(h, ())
                 if item[a:a + size] == doc[d:d + size]] if places else []
        for a, d in sorted(found):
            if not any(in_item[a:a + size]) and not any(in_doc[d:d + size]):
                in_item[a:a + size] = in_doc[d:d + size] = b"\x01" * size
                out.append((size, a, d))
        size -= 1
        if not found and size >= least:  # no run of this length: go on with the longest one there is
            size = min(size, _longest(item, in_item, doc, in_doc, least, size))
    return out


def _longest(item, in_item, doc, in_doc, least: int, most: int) -> int:
    """The longest common uncovered run of ``least`` to ``most`` ids, by bisection on its length; 0 if none."""
    low, high = 0, most
    size = least
    while low < high:
        hashes = {h for _, h in _runs(item, in_item, size)}
        if hashes and any(h in hashes for _, h in _runs(doc, in_doc, size)):
            low = size
        elif size == least:
            return 0
        else:
            high = size - 1
        size = (low + high + 1) // 2
    return low


class Block:
    """Some items of the benchmark, ready to be searched: rows of ``item_id, text`` and how often they stand there."""

    def __init__(self, rows: list[tuple]):
        self.times = [n for *_, n in rows]
        self.items = [(i, words_of(t)) for i, t, _ in rows]
        names = {w for _, ws in self.items for w in ws}
        self.number = {w: n for n, w in enumerate(sorted(names))}
        self.items = [(i, [self.number[w] for w in ws]) for i, ws in self.items]
        self.size = np.array([len(ids) for _, ids in self.items], np.int64)
        # all items in a row, a -1 after each
        row = np.array([x for _, ids in self.items for x in (*ids, -1)], np.int64)
        self.owner = np.repeat(np.arange(len(self.items)), self.size + 1)
        place, h = self.seeds(row)
        order = np.argsort(h, kind="stable")
        self.hash, self.place = h[order], place[order]
        # items too short for a seed are looked for whole
        self.short = {}
        for n, (_, ids) in enumerate(self.items):
            if 0 < len(ids) < TILE_WORDS:
                self.short.setdefault(tuple(ids), []).append(n)

    @staticmethod
    def seeds(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the seeds made of known words only."""
        n = len(ids) - TILE_WORDS + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        at = np.flatnonzero(known[TILE_WORDS:] - known[:-TILE_WORDS] == TILE_WORDS)
        h = np.zeros(len(at), np.uint64)
        for k in range(TILE_WORDS):
            h = (h ^ ids[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        return at, h

    def candidates(self, ids: np.ndarray) -> list[int]:
        """Items whose words are covered by the seeds of ``ids`` as far as a leak needs."""
        _, h = self.seeds(ids)
        h = np.unique(h)
        a, z = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, "right")
        n = (z - a)[a < z]
        if not len(n):
            return []
        at = np.repeat(a[a < z] - np.cumsum(n) + n, n) + np.arange(n.sum())
        words = np.unique(self.place[at][:, None] + np.arange(TILE_WORDS))
        items, covered = np.unique(self.owner[words], return_counts=True)
        return items[covered / self.size[items] >= COVERAGE].tolist()

    def whole(self, ids: np.ndarray) -> list[int]:
        """Items shorter than a seed that stand in ``ids``."""
        if not self.short:
            return []
        known = ids.tolist()
        return sorted(n for size in {len(k) for k in self.short}
                      for part in set(zip(*(known[i:] for i in range(size)))) for n in self.short.get(part, ()))

    def leaks(self, text: str) -> list[tuple]:
        """``(item_id, coverage)`` of each item that ``text`` covers."""
        get = self.number.get
        ids = np.array([get(w, -1) for w in words_of(text)], np.int64)
        out = [(self.items[n][0], 1.0) for n in self.whole(ids) for _ in range(self.times[n])]
        for n in self.candidates(ids):
            key, item = self.items[n]
            share = sum(t[0] for t in tiles(item, _shared_only(ids, item))) / len(item)
            if share >= COVERAGE:
                out += [(key, share)] * self.times[n]
        return out


def _shared_only(ids: np.ndarray, item: list[int]) -> list[int]:
    """The document's runs of ``TILE_WORDS`` or more words of the item, with a -1 between them."""
    own = np.isin(ids, item)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], own.astype(np.int8), [0]))))
    out: list[int] = []
    for a, z in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if z - a >= TILE_WORDS:
            out += [*ids[a:z].tolist(), -1]
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """``keep`` and ``leaks`` (array of ``item_id, coverage``, by item_id) of each row of ``docs``.

    Null and empty texts leak nothing; items with null text or no word are in
    no document, items of fewer than ``TILE_WORDS`` words are where their words
    stand in a row. Repeated rows and items come back
    repeated. An empty benchmark leaves every array empty. Columns not kept may
    have any name; a kept one named ``leaks`` or ``__leaks`` is an error.
    """
    if clash := {"leaks", "__leaks"}.intersection(keep):
        raise ValueError(f"kept columns with the name of a result: {sorted(clash)}")
    found = T.StructType([T.StructField("item_id", benchmark.schema["item_id"].dataType),
                          T.StructField("coverage", T.DoubleType())])
    bench = benchmark.filter(F.length("text") > 0).groupBy("item_id", "text").agg(F.count("*").alias("times"))
    blocks = bench.agg((F.sum(F.length("text")) / block_letters).cast("int")).first()[0]
    blocks = (blocks or 0) + 1
    cols = list(dict.fromkeys([*keep, "text"]))
    out = docs.select(*cols).withColumn("__leaks", F.array().cast(T.ArrayType(found)))
    for k in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        block = docs.sparkSession.sparkContext.broadcast(Block([tuple(r) for r in part.collect()]))
        if k + 1 == blocks:
            out = _through(out, block, keep, found)
        else:
            out = written(_through(out, block, cols, found), f"leaks-{k}")
            block.destroy()
    return out.withColumn("leaks", F.array_sort("__leaks")).select(*keep, "leaks")


def _through(df: DataFrame, block, cols: list[str], found: T.StructType) -> DataFrame:
    full = T.StructType([df.schema[c] for c in cols] + [T.StructField("__leaks", T.ArrayType(found))])
    arrow = arrow_schema(full)

    def run(batches):
        search = block.value.leaks
        for b in slices(batches):
            old = b.column(b.schema.get_field_index("__leaks")).to_pylist()
            new = [o + [{"item_id": i, "coverage": c} for i, c in search(t)]
                   for o, t in zip(old, text_column(b, "text"))]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in cols]
                                             + [pa.array(new, arrow.field("__leaks").type)], schema=arrow)

    return df.mapInArrow(run, full)


def op7_decontaminate(spark, sf_dir):
    """Query: every document that leaks a benchmark item, with the item and its coverage."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.item_id", "l.coverage")
