"""P3 extract: page payload to Markdown text.

Default: the native regex chain of :func:`html_to_markdown`. With
``extract_fn`` a model is called through :func:`run_plugin` instead.
Output ``page_id, value, error, status``; no text (NULL) becomes ``""`` and
is still SUCCESS, and a failure is ``""`` with FAILED.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import html_to_markdown
from ..schemas import SUCCESS, FAILED
from .plugins import run_plugin


def extract(payload: DataFrame, extract_fn=None, **plugin_opts) -> DataFrame:
    """``payload``: ``page_id, payload`` (HTML or text of the page)."""
    if extract_fn is None:
        return payload.select("page_id", html_to_markdown("payload").alias("value"),
                              F.lit(None).cast("string").alias("error"),
                              F.lit(SUCCESS).alias("status"))
    out = run_plugin(payload.select("page_id", "payload"), extract_fn, T.StringType(),
                     **plugin_opts)
    return out.select("page_id",
                      F.when(F.col("status") == FAILED, F.lit(""))
                      .otherwise(F.coalesce("value", F.lit(""))).alias("value"),
                      "error", "status")
