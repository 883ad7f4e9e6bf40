"""P4 situate: a short context for a page from its document's first pages.

Native default (SURVEY 2.9.2, extractive): the context of a document is the
text of its first ``n`` pages; a token weighs as many as the context pages
that contain it. The page's best sentence (highest total weight of its
distinct tokens, then the earliest) follows the file name and the path
description.

Plan: the first pages are picked with ``WindowGroupLimit`` and gathered per
document, a row of ``n`` texts at most. Target pages are joined to it by
``doc_id`` (AQE splits a document that holds a large share of the pages), and
each page picks its sentence in the same task, from Arrow batches. No token
ever becomes a row, so nothing but pages and contexts is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import path_description
from ..schemas import CONTEXT_PAGES, FAILED, SUCCESS
from .pages import first_n_pages
from .plugins import run_plugin


def _target_docs(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Distinct doc ids of the targets (narrow ``page_id, doc_id`` join)."""
    return targets.select("page_id").join(pages.select("page_id", "doc_id"), "page_id") \
        .select("doc_id").distinct()


def _context_pages(targets: DataFrame, pages: DataFrame, n: int = CONTEXT_PAGES) -> DataFrame:
    """First ``n`` pages of the documents that have a target. The window's
    partial top-k runs before its shuffle, and the semi-join on ``doc_id``
    reuses that partitioning (AQE broadcasts the ids when few), so pages
    of documents without targets are never tokenized."""
    first = first_n_pages(pages.select("doc_id", "page_id", "page_number", "text"), n)
    return first.join(_target_docs(targets, pages), "doc_id", "left_semi")


def context_header(path, descriptions: dict | None = None):
    """H9: what a model is told about the document: its file name and the
    description of its folders."""
    return F.format_string("file_name: %s\ndescription: %s", F.col(path),
                           path_description(path, descriptions))


# Java's reading of the patterns in functions/tokens.py
_SENTENCE_END = re.compile("[.!?]+[ \\t\\n\\x0b\\f\\r]+|\\n+")
_TOKEN = re.compile(r"[^\W_]+")


def token_weights(texts) -> Counter:
    """In how many of the (lower-cased) texts each token occurs."""
    weights: Counter = Counter()
    for t in texts:
        weights.update(set(_TOKEN.findall(t or "")))
    return weights


def best_sentence(text: str, low: str, weights: Counter) -> str | None:
    """The sentence whose distinct tokens weigh most, the earliest of equal
    ones; None without a token. ``low`` is ``text`` in lower case."""
    best, score = None, -1
    for sentence, words in zip(_SENTENCE_END.split(text), _SENTENCE_END.split(low)):
        found = set(_TOKEN.findall(words))
        if found:
            total = sum(map(weights.__getitem__, found))
            if total > score:
                best, score = sentence, total
    return best


@F.arrow_udf(T.StringType())
def _best_sentences(doc_id: pa.Array, text: pa.Array, low: pa.Array, context: pa.Array) -> pa.Array:
    """A document of the batch at a time: Python holds the weights of one, and of its rows one text."""
    out, doc, weights = [None] * len(doc_id), None, None
    for i in pc.sort_indices(doc_id).to_pylist():
        if weights is None or doc_id[i] != doc:
            doc, weights = doc_id[i], token_weights(context[i].as_py() or [])
        out[i] = best_sentence(text[i].as_py(), low[i].as_py(), weights)
    return pa.array(out, pa.string())


def situate(targets: DataFrame, pages: DataFrame, n: int = CONTEXT_PAGES,
            descriptions: dict | None = None, summary_fn=None, **plugin_opts) -> DataFrame:
    """``targets``: ``page_id`` to summarise.
    ``pages``: ``page_id, doc_id, page_number, gcs_pdf_path, text`` of all pages.

    Output ``page_id, value, error, status``. A target with no page row is
    FAILED; a page without a sentence gives ``""`` and SUCCESS.
    """
    known = targets.select("page_id").distinct().join(
        pages.select("page_id", "doc_id", "gcs_pdf_path", "text"), "page_id", "left")
    missing = known.filter(F.col("doc_id").isNull()).select(
        "page_id", F.lit(None).cast("string").alias("value"),
        F.concat(F.lit("no page row for "), F.col("page_id")).alias("error"),
        F.lit(FAILED).alias("status"))
    found = known.filter(F.col("doc_id").isNotNull())
    ctx = _context_pages(targets, pages, n) \
        .groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_number", "text"))).alias("_c"))
    batch = found.join(ctx, "doc_id", "left")
    if summary_fn is not None:
        batch = batch.select(
            "page_id", "gcs_pdf_path", "text",
            context_header("gcs_pdf_path", descriptions).alias("header"),
            F.transform("_c", lambda c: c["text"]).alias("context"))
        out = run_plugin(batch, summary_fn, T.StringType(), **plugin_opts)
        out = out.select("page_id", F.when(F.col("status") == FAILED, F.lit(""))
                         .otherwise(F.coalesce("value", F.lit(""))).alias("value"),
                         "error", "status")
        return out.unionByName(missing)

    text = F.coalesce("text", F.lit(""))
    sentence = _best_sentences("doc_id", text, F.lower(text), F.transform("_c", lambda c: F.lower(c["text"])))
    picked = batch.select("page_id", "gcs_pdf_path", sentence.alias("sentence"))
    # pages without any sentence get "" and SUCCESS
    summary = F.concat_ws("\n", "gcs_pdf_path", path_description("gcs_pdf_path", descriptions), "sentence")
    out = picked.select(
        "page_id", F.when(F.col("sentence").isNull(), F.lit("")).otherwise(summary).alias("value"),
        F.lit(None).cast("string").alias("error"), F.lit(SUCCESS).alias("status"))
    return out.unionByName(missing)
