"""P5 embed: a vector per page from its summary and extracted text.

Native default (SURVEY 2.9.3): tokens hashed into 768 buckets, counted and
L2-normalised, all inside the row (no shuffle). With ``embed_fn`` a model
is called through :func:`run_plugin`. Blank combined text is FAILED.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import combined_text, is_blank
from ..functions.tokens import bucket_counts, token_buckets, unit_vector, unit_vector_arrow
from ..schemas import FAILED, SUCCESS
from .plugins import run_plugin

MODEL = "hashed-bow-768"


def embed_buckets(pages: DataFrame) -> DataFrame:
    """Integer bucket counts ``page_id, bucket, n`` of non-blank combined text.

    Exploded and counted by ``(page_id, bucket)`` with a partial aggregate:
    the integer form of the vector, compared with the oracle.
    """
    txt = combined_text("summary", "extracted_text")
    return (pages.filter(~is_blank(txt))
            .select("page_id", F.explode(token_buckets(txt)).alias("bucket"))
            .groupBy("page_id", "bucket").agg(F.count(F.lit(1)).cast("int").alias("n")))


def embed(pages: DataFrame, embed_fn=None, vectorized: bool = True, **plugin_opts) -> DataFrame:
    """``pages``: ``page_id, summary, extracted_text``.
    Output ``page_id, value array<float>, error, status``.

    Tokens are split and hashed to buckets in the JVM; ``vectorized`` counts
    and normalises them in Arrow batches (default), otherwise with native
    higher-order functions (no Python worker, slower per row).
    """
    txt = combined_text("summary", "extracted_text")
    blank = pages.filter(is_blank(txt)).select(
        "page_id", F.lit(None).cast("array<float>").alias("value"),
        F.lit("text to embed is empty").alias("error"), F.lit(FAILED).alias("status"))
    ok = pages.filter(~is_blank(txt))
    if embed_fn is not None:
        batch = ok.select("page_id", txt.alias("text"))
        vec = run_plugin(batch, embed_fn, T.ArrayType(T.FloatType()), **plugin_opts)
    elif vectorized:
        vec = ok.select("page_id", token_buckets(txt).alias("_b")).select(
            "page_id", unit_vector_arrow("_b").alias("value"),
            F.lit(None).cast("string").alias("error"), F.lit(SUCCESS).alias("status"))
    else:
        vec = ok.select("page_id", bucket_counts(txt).alias("_d")).select(
            "page_id", unit_vector("_d").alias("value"),
            F.lit(None).cast("string").alias("error"), F.lit(SUCCESS).alias("status"))
    return vec.unionByName(blank)
