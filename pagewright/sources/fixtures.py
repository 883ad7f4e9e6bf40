"""Test inputs derived from the driver tables (FIXTURES.md F1-F3).

Each derivation has a DuckDB twin in :mod:`pagewright.plans.oracle`, written
the same way, so both engines see equal input. The ``doc_id % 10`` rules
below do not pick a cheaper subset: every row of ``documents`` is read, and
the remainder only decides which documents were moved, deleted, deactivated
or left without a hash in the simulated history.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import content_hash, doc_hash
from ..functions.paths import DESCRIPTIONS, page_id, page_path_from_prefix, page_path_prefix
from ..operators.pages import page_texts as cut_pages
from ..schemas import ACTIVE, INACTIVE, PENDING, FAILED, SUCCESS, STAGES

# Fixed value: timestamp of the simulated earlier runs.
FIXED_TS = "2024-01-01 00:00:00"
# Fixed value: characters per page when a document is paginated.
PAGE_CHARS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fixed_ts() -> Column:
    return F.lit(FIXED_TS).cast("timestamp_ntz")


def base_path(d: DataFrame) -> Column:
    return F.concat(d["source"], F.lit("/"), d["lang"], F.lit("/doc-"),
                    d["doc_id"].cast("string"), F.lit(".pdf"))


def storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object store as it is now: ``path, content`` (content = document text)."""
    d = table(spark, sf_dir, "documents")
    bp = base_path(d)
    path = F.when(d["doc_id"] % 10 == 1, F.concat(F.lit("moved/"), bp)).otherwise(bp)
    return (d.filter(d["doc_id"] % 10 != 2)
            .select(path.alias("path"), d["text"].alias("content"), d["n_chars"].alias("length")))


def present_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file, a tenth of them moved and none deleted: ``path, content``."""
    d = table(spark, sf_dir, "documents")
    bp = base_path(d)
    path = F.when(d["doc_id"] % 10 == 1, F.concat(F.lit("moved/"), bp)).otherwise(bp)
    return d.select(path.alias("path"), d["text"].alias("content"))


def all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file, none deleted: ``path, content, length``."""
    d = table(spark, sf_dir, "documents")
    return d.select(base_path(d).alias("path"), d["text"].alias("content"), d["n_chars"].alias("length"))


def described_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document filed below two of the described folders: ``path``."""
    d = table(spark, sf_dir, "documents")
    names = F.array(*[F.lit(k) for k in DESCRIPTIONS])
    folder = lambda k: F.element_at(names, (F.pmod(k, F.lit(len(DESCRIPTIONS))) + 1).cast("int"))
    return d.select(F.concat(folder(d["doc_id"]), F.lit("/"), folder(d["doc_id"] * 7 + 3), F.lit("/"), base_path(d)).alias("path"))


def marked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as they are, each followed by a table, images and a code fence
    made of its own columns: ``page_id, html``."""
    p = table(spark, sf_dir, "pages")
    i = p["page_id"].cast("string")
    html = F.concat(
        p["html"], F.lit("\n<table class=\"t\"><caption>page "), i, F.lit("</caption><tr><th>url</th><th>n</th></tr><tr><td>"),
        p["url"], F.lit("</td><td>"), i, F.lit("</td></tr></table>\n<figure><img src='a.png' alt='photo "), i,
        F.lit("'><figcaption>from "), p["url"], F.lit("</figcaption></figure><img alt=\"plan "), i,
        F.lit("\" src=b.png><img src=c.png>\n```html\ncode "), i, F.lit("\n```\nend"))
    return p.select("page_id", html.alias("html"))


def scan_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, content_hash, doc_id, length`` of the current files."""
    s = storage(spark, sf_dir)
    return s.select("path", content_hash("content").alias("content_hash"),
                    doc_hash("content", "path").alias("doc_id"), "length")


def registry_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the document registry left by earlier runs."""
    d = table(spark, sf_dir, "documents")
    bp = base_path(d)
    return (d.filter(d["doc_id"] % 10 != 0)
            .select(doc_hash(d["text"], bp).alias("doc_id"),
                    bp.alias("path"),
                    F.when(d["doc_id"] % 10 == 4, F.lit("")).otherwise(content_hash(d["text"]))
                    .alias("content_hash"),
                    F.when(d["doc_id"] % 10 == 3, F.lit(INACTIVE)).otherwise(F.lit(ACTIVE))
                    .alias("status"),
                    fixed_ts().alias("created_at"), fixed_ts().alias("updated_at")))


def _stage_status(src_id: Column, n: Column, m: int) -> Column:
    r = (src_id * m + n) % 5
    return F.when(r == 0, F.lit(PENDING)).when(r == 1, F.lit(FAILED)).otherwise(F.lit(SUCCESS))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into 1,000-character pages:
    ``src_id, doc_id, n, pdf_path, path_prefix, text``."""
    d = table(spark, sf_dir, "documents")
    bp = base_path(d)
    return (d.select(d["doc_id"].alias("src_id"), doc_hash(d["text"], bp).alias("doc_id"),
                     bp.alias("pdf_path"), page_path_prefix(bp).alias("path_prefix"),
                     F.posexplode(cut_pages("text", PAGE_CHARS)).alias("i", "text"))
            .select("src_id", "doc_id", (F.col("i") + 1).alias("n"), "pdf_path", "path_prefix", "text"))


def pages_f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page state of earlier runs, with mixed stage statuses."""
    p = page_texts(spark, sf_dir)
    src, n = p["src_id"], p["n"]
    st = {s: _stage_status(src, n, m) for m, s in enumerate(STAGES, start=1)}
    text_by = lambda s, v: F.when(st[s] == SUCCESS, v).when(st[s] == FAILED, F.lit(""))
    error = (F.when(st["extracted"] == FAILED, F.lit("extract error"))
             .when(st["summarized"] == FAILED, F.lit("summary error"))
             .when(st["embedded"] == FAILED, F.lit("embedding error"))
             .when(st["indexed"] == FAILED, F.lit("indexing error")))
    return p.select(
        page_id(p["doc_id"], n).alias("page_id"),
        p["doc_id"],
        n.cast("int").alias("page_number"),
        page_path_from_prefix(p["path_prefix"], n).alias("gcs_path"),
        p["pdf_path"].alias("gcs_pdf_path"),
        text_by("extracted", p["text"]).alias("extracted_text"),
        text_by("summarized", p["text"]).alias("summary"),
        F.lit(None).cast("array<float>").alias("embedding"),
        *[st[s].alias(s) for s in STAGES],
        error.alias("error_message"),
        F.when(src % 10 == 3, F.lit(INACTIVE)).otherwise(F.lit(ACTIVE)).alias("status"),
        fixed_ts().alias("created_at"), fixed_ts().alias("updated_at"),
    )


def page_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored vectors keyed by page: the ``embeddings`` row whose ``vec_id``
    equals the page's source document id, for pages embedded with SUCCESS."""
    p = page_texts(spark, sf_dir)
    e = table(spark, sf_dir, "embeddings")
    emb = _stage_status(p["src_id"], p["n"], 3)
    pv = p.filter(emb == SUCCESS).select(page_id("doc_id", "n").alias("page_id"), "src_id")
    return pv.join(e, pv["src_id"] == e["vec_id"], "inner").select("page_id", "embedding")


# Fixed value: time stamp given to rows written by the simulated current run.
RUN_TS = "2024-06-01 00:00:00"


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw object listing: every document's PDF plus a ``.txt`` sidecar per file."""
    s = all_files(spark, sf_dir).select("path")
    return s.unionByName(s.select(F.concat("path", F.lit(".txt")).alias("path")))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page objects written at split time: ``page_id, doc_id, page_number,
    gcs_pdf_path, text``."""
    p = page_texts(spark, sf_dir)
    return p.select(page_id("doc_id", "n").alias("page_id"), "doc_id",
                    F.col("n").cast("int").alias("page_number"),
                    F.col("pdf_path").alias("gcs_pdf_path"), "text")


def polls(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three listings of one tree, ``path, length, modified, content_hash, doc_id``.

    Every document is in them. Between the first and the second, of ten ids
    one is added, one moved, one edited, one deleted and one touched without
    a change of content; before the third, the deleted one is back and
    another one gone. ``doc_id % 10`` only says what happens to a file.
    """
    d = table(spark, sf_dir, "documents")
    r, bp = d["doc_id"] % 10, base_path(d)

    def listed(there: Column, path: Column, text: Column, modified: Column) -> DataFrame:
        return (d.filter(there).select(path.alias("path"), text.alias("content"), modified.alias("modified"))
                .select("path", F.octet_length("content").cast("long").alias("length"), "modified",
                        content_hash("content").alias("content_hash"), doc_hash("content", "path").alias("doc_id")))

    moved = F.when(r == 1, F.concat(F.lit("moved/"), bp)).otherwise(bp)
    edited = F.when(r == 3, F.concat(d["text"], F.lit(" edited"))).otherwise(d["text"])
    at = F.when(r.isin(3, 5), F.lit(2)).otherwise(F.lit(1)).cast("long")
    return [listed(r != 2, bp, d["text"], F.lit(1).cast("long")), listed(r != 4, moved, edited, at),
            listed(r != 6, moved, edited, at)]
