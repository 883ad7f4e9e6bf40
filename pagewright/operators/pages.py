"""Pagination (P2), first pages per document (K1) and page registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import page_id, page_path_from_prefix, page_path_prefix
from ..schemas import ACTIVE, CONTEXT_PAGES, PENDING, STAGES

PAGE_CHARS = 1000


def page_texts(content: Column | str, page_chars: int = PAGE_CHARS) -> Column:
    """The text cut into pieces of ``page_chars`` characters; an empty or NULL text is one page."""
    c = F.col(content) if isinstance(content, str) else content
    pieces = F.regexp_extract_all(c, F.lit(f"(?s).{{1,{page_chars}}}"), F.lit(0))
    return F.when(F.length(c) > 0, pieces).otherwise(F.array(c))


def paginate(docs: DataFrame, page_chars: int = PAGE_CHARS, mode: str = "chars") -> DataFrame:
    """Cut each document into pages numbered from 1.

    ``docs``: ``doc_id, path, content`` (text). ``mode="chars"`` makes pages
    of ``page_chars`` characters (an empty document still has page 1);
    ``mode="formfeed"`` splits on form feeds. Output ``page_id, doc_id,
    page_number, gcs_path, gcs_pdf_path, text``. Rows are generated inside
    the task that holds the document; nothing is shuffled. Everything of the
    object path but the page number is computed once per document, and the
    text is cut in one pass over it.
    """
    if mode == "chars":
        parts = page_texts("content", page_chars)
    elif mode == "formfeed":
        parts = F.split("content", "\f", -1)
    else:
        raise ValueError(f"unknown pagination mode {mode}")
    pages = docs.select("doc_id", "path", page_path_prefix("path").alias("_pp"),
                        F.posexplode(parts).alias("i", "text")) \
        .select("doc_id", "path", "_pp", (F.col("i") + 1).alias("n"), "text")
    return pages.select(
        page_id("doc_id", "n").alias("page_id"), "doc_id",
        F.col("n").cast("int").alias("page_number"),
        page_path_from_prefix("_pp", "n").alias("gcs_path"),
        F.col("path").alias("gcs_pdf_path"), "text")


def first_n_pages(pages: DataFrame, n: int = CONTEXT_PAGES) -> DataFrame:
    """K1: the first ``n`` pages of every document by page number.

    ``row_number() <= n`` is planned as ``WindowGroupLimit`` on both sides of
    the shuffle, so even a document with millions of pages sends at most
    ``n`` rows per map task. Page numbers are ordered as integers.
    """
    w = Window.partitionBy("doc_id").orderBy(F.col("page_number").asc(), F.col("page_id").asc())
    return pages.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def new_page_rows(split: DataFrame, now) -> DataFrame:
    """Page-state rows for freshly split pages: every stage PENDING, ACTIVE."""
    if not isinstance(now, Column):
        now = F.lit(now).cast("timestamp_ntz")
    return split.select(
        "page_id", "doc_id", "page_number", "gcs_path", "gcs_pdf_path",
        F.lit(None).cast("string").alias("extracted_text"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("array<float>").alias("embedding"),
        *[F.lit(PENDING).alias(s) for s in STAGES],
        F.lit(None).cast("string").alias("error_message"),
        F.lit(ACTIVE).alias("status"),
        now.alias("created_at"), now.alias("updated_at"))


def register_pages(pages: DataFrame, split: DataFrame, now) -> DataFrame:
    """Append page rows whose page_id is not there yet (idempotent)."""
    fresh = new_page_rows(split.join(pages.select("page_id"), "page_id", "left_anti"), now)
    return pages.unionByName(fresh)
