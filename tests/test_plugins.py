"""Plug-in calls in flight: overlap, limits, retries."""

import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

from pagewright.operators.plugins import run_plugin

# workers cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pages(spark, n, parts=1):
    return spark.createDataFrame([(f"p{i}", f"text {i}") for i in range(n)], "page_id string, text string").coalesce(parts)


def slow(seconds):
    """A model that says how many of its calls were open, and when it began."""
    lock, state = threading.Lock(), {"open": 0}

    def fn(pdf):
        import pandas as pd
        with lock:
            state["open"] += 1
            now = state["open"]
        time.sleep(seconds)
        with lock:
            state["open"] -= 1
        return pd.DataFrame({"page_id": pdf["page_id"], "value": [float(now)] * len(pdf), "error": None})

    return fn


class Model:
    """``slow`` made inside the worker: a lock isn't sent there."""

    def __init__(self, seconds):
        self.seconds, self.fn = seconds, None

    def __call__(self, pdf):
        if self.fn is None:
            self.fn = slow(self.seconds)
        return self.fn(pdf)


def test_slow_calls_overlap_up_to_the_limit(spark):
    run_plugin(pages(spark, 2), Model(0.0), T.DoubleType(), in_flight=2, call_rows=1).collect()  # warm worker
    for n in (1, 4, 10):
        began = time.time()
        got = run_plugin(pages(spark, 20), Model(0.2), T.DoubleType(), in_flight=n, call_rows=1).collect()
        took = time.time() - began
        assert sorted(r.page_id for r in got) == sorted(f"p{i}" for i in range(20))
        assert all(r.status == "SUCCESS" and r.value <= n for r in got) and max(r.value for r in got) == n
        assert 0.2 * 20 / n <= took < 0.2 * 20 / n + 2.5


def test_rows_of_a_failed_call_are_tried_alone(spark):
    def fn(pdf):
        import pandas as pd
        if len(pdf) > 1 and pdf["page_id"].isin(["p3"]).any():
            raise RuntimeError("batch rejected")
        if pdf["page_id"].iloc[0] == "p3":
            raise RuntimeError("page rejected")
        return pd.DataFrame({"page_id": pdf["page_id"], "value": pdf["text"], "error": None})

    for n in (1, 3):
        got = {r.page_id: r for r in run_plugin(pages(spark, 10, 2), fn, T.StringType(), in_flight=n, call_rows=4).collect()}
        assert len(got) == 10 and got["p3"].status == "FAILED" and "page rejected" in got["p3"].error
        assert all(r.status == "SUCCESS" and r.value == "text " + k[1:] for k, r in got.items() if k != "p3")


class Flaky:
    """Fails ``times`` times for each page, then answers with the number of calls it took."""

    def __init__(self, times):
        self.times, self.calls = times, {}

    def __call__(self, pdf):
        import pandas as pd
        page = pdf["page_id"].iloc[0]
        self.calls[page] = self.calls.get(page, 0) + 1
        if self.calls[page] <= self.times:
            raise RuntimeError(f"try {self.calls[page]}")
        return pd.DataFrame({"page_id": pdf["page_id"], "value": [float(self.calls[page])], "error": None})


def test_a_page_has_its_attempts_and_waits(spark):
    got = run_plugin(pages(spark, 6), Flaky(2), T.DoubleType(), in_flight=3, call_rows=1, attempts=2).collect()
    assert [r.value for r in got] == [3.0] * 6
    began = time.time()
    got = run_plugin(pages(spark, 4), Flaky(9), T.DoubleType(), in_flight=4, call_rows=1, attempts=3, retry_wait_s=0.3).collect()
    assert all(r.status == "FAILED" and r.error == "RuntimeError: try 4" for r in got)
    assert 0.9 <= time.time() - began < 4 * 0.9 + 2


def test_limits_are_checked(spark):
    for bad in ({"in_flight": 0}, {"attempts": 0}, {"call_rows": 0}):
        with pytest.raises(ValueError):
            run_plugin(pages(spark, 1), Model(0), T.DoubleType(), **bad)
    assert run_plugin(pages(spark, 3).limit(0), Model(0), T.DoubleType(), in_flight=4).count() == 0
