"""Plug-in batch functions for external models.

A plug-in is ``fn(pandas.DataFrame) -> pandas.DataFrame``: it receives a
batch of input rows (always with ``page_id``) and returns ``page_id, value,
error``. It runs through ``mapInPandas`` (Arrow batches, one Python worker
per task). Failures become values: if a batch raises, each row is retried
alone, and a row that still raises is returned with its error text, so one
bad page never stops a stage. A page that the plug-in leaves out is FAILED; a
page it returns twice, or was never given, is an error of its batch. Results are keyed by ``page_id``, so a task
retried after a lost executor writes the same keys again.

Calls of a slow service can overlap: a task keeps up to ``in_flight`` of them
open and passes results on as they come, in any order. It holds no more input
than the open calls and one Arrow batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.text import status_from_error


def run_plugin(df: DataFrame, fn: Callable, value_type: T.DataType,
               retry_wait_s: float = 0.0, max_concurrency: int | None = None, in_flight: int = 1,
               call_rows: int | None = None, attempts: int = 1) -> DataFrame:
    """Apply ``fn`` to ``df`` batch-wise; output ``page_id, value, error, status``.

    ``retry_wait_s``: pause before a failed call is retried row by row (the
    reference waits 60 s after a failed page), and before each further try.
    ``attempts``: tries of a row on its own; the last error is its result.
    ``max_concurrency`` caps how many tasks call the service at once,
    ``in_flight`` how many calls one task has open (their product is the
    service's load). ``call_rows``: rows of one call, by default an Arrow
    batch. With ``in_flight`` above 1, ``fn`` runs in threads.
    """
    if in_flight < 1 or attempts < 1 or (call_rows is not None and call_rows < 1):
        raise ValueError("in_flight, attempts and call_rows are 1 or more")
    schema = T.StructType([T.StructField("page_id", T.StringType(), False),
                           T.StructField("value", value_type, True),
                           T.StructField("error", T.StringType(), True)])

    def apply(batches):
        import pandas as pd

        def call(pdf):
            out = fn(pdf)[["page_id", "value", "error"]]
            if out["page_id"].duplicated().any() or not out["page_id"].isin(pdf["page_id"]).all():
                raise ValueError("the plug-in returned repeated or unknown pages")
            left = pdf.loc[~pdf["page_id"].isin(out["page_id"]), "page_id"].drop_duplicates()
            if len(left):
                lost = pd.DataFrame({"page_id": left.values, "value": [None] * len(left),
                                     "error": ["the plug-in returned no row for this page"] * len(left)})
                out = lost if out.empty else pd.concat([out, lost], ignore_index=True)
            return out

        def alone(one):
            """One row, tried again until it succeeds or ``attempts`` are used up."""
            for _ in range(attempts):
                if retry_wait_s:
                    time.sleep(retry_wait_s)
                try:
                    return call(one)
                except Exception as e:  # noqa: BLE001 - errors become values
                    error = f"{type(e).__name__}: {e}"
            return pd.DataFrame({"page_id": one["page_id"].values, "value": [None], "error": [error]})

        def work(pdf):
            try:
                return call(pdf)
            except Exception:  # noqa: BLE001 - errors become values
                return pd.concat([alone(pdf.iloc[i:i + 1]) for i in range(len(pdf))], ignore_index=True)

        def parts():
            for pdf in batches:
                step = call_rows or max(1, len(pdf))
                for i in range(0, len(pdf), step):
                    yield pdf.iloc[i:i + step].reset_index(drop=True)

        if in_flight == 1:
            yield from map(work, parts())
            return
        with ThreadPoolExecutor(in_flight) as pool:
            open_calls = set()
            for part in parts():
                if len(open_calls) >= in_flight:
                    ended, open_calls = wait(open_calls, return_when=FIRST_COMPLETED)
                    yield from (c.result() for c in ended)
                open_calls.add(pool.submit(work, part))
            while open_calls:
                ended, open_calls = wait(open_calls, return_when=FIRST_COMPLETED)
                yield from (c.result() for c in ended)

    src = df.repartition(max_concurrency) if max_concurrency else df
    out = src.mapInPandas(apply, schema)
    return out.withColumn("status", status_from_error("error"))
