"""Tokens, sentences and hashed buckets (shared by situate and embed)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EMBED_DIM

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
SENTENCE_SPLIT = r"[.!?]+\s+|\n+"
HAS_TOKEN = r"[\p{L}\p{N}]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits, empties dropped."""
    return F.array_remove(F.split(F.lower(F.coalesce(_c(text), F.lit(""))), TOKEN_SPLIT, -1), "")


def sentences(text: Column | str) -> Column:
    """Sentence candidates (split on end punctuation + space, or line breaks)."""
    return F.split(F.coalesce(_c(text), F.lit("")), SENTENCE_SPLIT, -1)


def bucket(token: Column) -> Column:
    """Token to one of ``EMBED_DIM`` buckets: first 32 bits of its md5."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % EMBED_DIM).cast("int")


def bucket_counts(text: Column | str) -> Column:
    """Dense ``array<int>`` of ``EMBED_DIM`` token counts for one text.

    Folded inside the row (no shuffle). The lambdas reference only their own
    variables: Spark evaluates an outer expression inside a lambda once per
    element, so nothing heavy may appear there.
    """
    b = F.transform(tokens(text), bucket)
    return F.aggregate(b, F.array_repeat(F.lit(0), EMBED_DIM),
                       lambda acc, x: F.transform(acc, lambda c, i: F.when(i == x, c + 1).otherwise(c)))


def sparse_counts(dense: Column | str) -> Column:
    """Dense counts to ``array<struct<bucket:int, n:int>>`` of non-zero buckets."""
    return F.filter(F.transform(_c(dense), lambda c, i: F.struct(i.alias("bucket"), c.alias("n"))),
                    lambda e: e["n"] > 0)


def unit_vector(dense: Column | str, dim: int = EMBED_DIM) -> Column:
    """Dense counts to an L2-normalised ``array<float>``; no token gives zeros."""
    d = _c(dense)
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, c: a + c * c))
    return F.zip_with(d, F.array_repeat(norm, dim),
                      lambda c, n: F.when(n > 0, c / n).otherwise(F.lit(0.0)).cast("float"))


def token_buckets(text: Column | str) -> Column:
    """``array<int>``: the bucket of every token, in text order."""
    return F.transform(tokens(text), bucket)


#: Rows of an Arrow batch that are counted at once; only these have dense doubles.
_DENSE_ROWS = 256


def _unit_vectors_arrow(dim: int):
    @F.arrow_udf("array<float>")
    def unit_vectors(buckets: pa.Array) -> pa.Array:
        # a few rows at a time: count every (row, bucket) pair, then
        # L2-normalise each row; no Python loop over tokens, no Python object
        # per row, and nothing but the result is as long as the batch
        import numpy as np
        n, ends, flat = len(buckets), buckets.offsets.to_numpy(), buckets.values.to_numpy(zero_copy_only=False)
        out = np.zeros((n, dim), dtype=np.float32)
        for at in range(0, n, _DENSE_ROWS):
            to = min(at + _DENSE_ROWS, n)
            rows = np.repeat(np.arange(to - at), np.diff(ends[at:to + 1]))
            pairs = rows * dim + flat[ends[at]:ends[to]]
            dense = np.bincount(pairs, minlength=(to - at) * dim).reshape(-1, dim).astype(np.float64)
            norm = np.sqrt((dense * dense).sum(axis=1, keepdims=True))
            out[at:to] = np.divide(dense, norm, out=np.zeros_like(dense), where=norm > 0)
        return pa.ListArray.from_arrays(np.arange(0, (n + 1) * dim, dim, dtype=np.int32), pa.array(out.reshape(-1)))

    return unit_vectors


_UNIT = {}


def unit_vector_arrow(buckets: Column | str, dim: int = EMBED_DIM) -> Column:
    """Bucket ids to an L2-normalised ``array<float>`` in Arrow batches.

    Spark evaluates higher-order-function lambdas without code generation,
    so counting into 768 slots per row natively costs tokens x 768 lambda
    calls; the vectorised scatter-add does the same arithmetic per batch.
    """
    if dim not in _UNIT:
        _UNIT[dim] = _unit_vectors_arrow(dim)
    return _UNIT[dim](_c(buckets))
