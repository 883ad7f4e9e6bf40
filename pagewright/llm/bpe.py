"""BPE encoding and decoding with chunks that documents share.

A text is cut where a rolling hash of its last letters has zeros, so equal
passages fall into equal chunks wherever they stand. A chunk is encoded once
per executor process and remembered while there is room; memory is bounded and
forgetting costs time only. Cuts may fall inside a word, so every join of two
chunks is repaired: the letters around it are encoded again in a window that
grows, over whole chunks if need be, until both its ends lie where the
tokenizer never joins letters, that is between a visible character and a
plain blank. There the ids of the window and of the chunks agree exactly.

Nothing is shuffled. Sharing chunks across processes too would need all
distinct chunks and their ids in a shuffle, several times the input.
"""

from __future__ import annotations

import base64
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, no_clash, slices, table, text_column

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
#: A cut needs this many zero bits of the rolling hash: chunks of 512 letters on average.
CUT_BITS = 9
WINDOW = 8
#: Letters a text is hashed in at a time.
BLOCK = 1 << 20
#: Letters of remembered chunks per process (two generations of half of it).
REMEMBERED = 12 << 20

#: A visible character before a plain blank.
_EDGE = re.compile("[^\\s\\x00-\\x1f\\x7f-\\xa0\\xad\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u206f\\u3000\\ufeff]"
                   "(?=[ \\n\\t\\r])")
#: Texts in which both implementations of the vocabulary agree letter by letter (tested).
_PLAIN = re.compile("[\\t\\n\\r -~\\xa1-\\xac\\xae-\\u024f]*")


def cuts(text: str) -> np.ndarray:
    """Places inside ``text`` where the hash of the ``WINDOW`` letters before them ends in zeros."""
    out = [np.zeros(0, np.int64)]
    for at in range(0, len(text), BLOCK):
        lead = max(0, at - WINDOW + 1)
        points = np.frombuffer(text[lead:at + BLOCK].encode("utf-32-le"), np.uint32)
        if len(points) < WINDOW:
            continue
        g = points * np.uint32(0x9E3779B1)
        g ^= g >> np.uint32(15)
        g *= np.uint32(0x85EBCA77)
        h = g[WINDOW - 1:].copy()
        for k in range(1, WINDOW):
            h += g[WINDOW - 1 - k:len(g) - k] << np.uint32(k)
        h ^= h >> np.uint32(16)
        out.append(np.flatnonzero((h & np.uint32((1 << CUT_BITS) - 1)) == 0) + lead + WINDOW)
    places = np.concatenate(out)
    return places[(places > 0) & (places < len(text))]


class Codec:
    """A vocabulary file and the chunks encoded so far."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        self.path = vocabulary if vocabulary.endswith(".json") else public_tokenizers.path(f"{vocabulary}.json")
        with open(self.path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = len(ranks)  # the first id after them
        self.young, self.old, self.room = {}, {}, REMEMBERED // 2

    @cached_property
    def tokenizer(self):
        """The library itself, loaded when a text needs it."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    def ids(self, text: str) -> list[int]:
        """Ids of a text on its own."""
        if SPECIAL not in text and _PLAIN.fullmatch(text):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def chunk(self, text: str) -> tuple[str, np.ndarray | None, str]:
        """Letters before the first edge, ids between the edges, letters after the last; no ids without two edges."""
        got = self.young.get(text)
        if got is None:
            got = self.old.get(text)
            if got is None:
                first = _EDGE.search(text)
                a = first.end() if first else 0
                z = next((m.end() for m in _last_edges(text)), 0)
                got = (text[:a], np.array(self.ids(text[a:z]), np.int32), text[z:]) if 0 < a < z else (text, None, "")
            self.room -= len(text)
            if self.room < 0:
                self.old, self.young, self.room = self.young, {}, REMEMBERED // 2 - len(text)
            self.young[text] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        parts, window, begin = [], "", 0
        for end in [*cuts(text).tolist(), len(text)]:
            head, ids, tail = self.chunk(text[begin:end])
            begin = end
            window += head
            if ids is not None:
                parts.append(np.array(self.ids(window), np.int32))
                parts.append(ids)
                window = tail
        if window:
            parts.append(np.array(self.ids(window), np.int32))
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def decode(self, ids: list[int]) -> str:
        if self.special in ids:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return self.fast.decode_bytes(ids).decode("utf-8", "replace")


def _last_edges(text: str):
    """Matches of the last edge, looked for from the end in windows that double."""
    size = 64
    while True:
        lead = max(0, len(text) - size)
        found = None
        for found in _EDGE.finditer(text, lead):
            pass
        if found or not lead:
            return [found] if found else []
        size *= 2


@lru_cache(maxsize=1)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def encode(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` and ``ids`` (array of int) of each row's ``text``.

    Equal to the tokenizers library's ``encode(text, add_special_tokens=False)``
    over the whole text. Null and empty texts have no ids; the text of the
    special token becomes its id. Repeated rows come back repeated; columns
    outside ``keep`` are ignored, one in ``keep`` named ``ids`` is an error.
    """
    no_clash(keep, ["ids"])
    full = T.StructType([docs.schema[c] for c in keep]
                        + [T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    arrow = arrow_schema(full)

    def run(batches):
        c = codec(vocabulary)
        for b in slices(batches):
            ids = [c.encode(t) for t in text_column(b, "text")]
            ends = np.cumsum([0, *map(len, ids)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(k)) for k in keep] + [lists.cast(arrow.field("ids").type)], schema=arrow)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, full)


def decode(rows: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` and ``decoded``: the text of ``ids``, special tokens included; null ids give an empty text.

    A column in ``keep`` named ``decoded`` is an error.
    """
    no_clash(keep, ["decoded"])
    full = T.StructType([rows.schema[c] for c in keep] + [T.StructField("decoded", T.StringType())])
    arrow = arrow_schema(full)

    def run(batches):
        c = codec(vocabulary)
        for b in slices(batches):
            texts = [c.decode(x or []) for x in b.column(b.schema.get_field_index("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(k)) for k in keep] + [pa.array(texts, pa.string())], schema=arrow)

    return rows.select(*dict.fromkeys([*keep, "ids"])).mapInArrow(run, full)


def digest_columns() -> list:
    """``ids_sha256, decoded_sha256`` of rows with ``ids`` and ``decoded``."""
    return [F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]


def op6_bpe(spark, sf_dir):
    """Query: every document encoded and decoded."""
    both = decode(encode(table(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id", "ids"])
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), *digest_columns())
