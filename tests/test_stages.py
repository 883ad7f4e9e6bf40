"""Page jobs: situate, embed, plug-ins, pagination."""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators import embed as EM
from pagewright.operators import extract as EX
from pagewright.operators import pages as PG
from pagewright.operators import situate as SI
from pagewright.operators.plugins import run_plugin
from pagewright.sources import fixtures as fx


def test_paginate_counts_and_empty_doc(spark):
    docs = spark.createDataFrame([("d1", "a/x.pdf", "x" * 2500), ("d2", "y.pdf", "")],
                                 "doc_id string, path string, content string")
    got = sorted((r.doc_id, r.page_number, len(r.text), r.gcs_path) for r in PG.paginate(docs, 1000).collect())
    assert got == [("d1", 1, 1000, "a/x/x-page-00001.png"), ("d1", 2, 1000, "a/x/x-page-00002.png"),
                   ("d1", 3, 500, "a/x/x-page-00003.png"), ("d2", 1, 0, "y/y-page-00001.png")]
    ff = spark.createDataFrame([("d", "p.pdf", "one\ftwo")], "doc_id string, path string, content string")
    assert [r.text for r in PG.paginate(ff, mode="formfeed").orderBy("page_number").collect()] == ["one", "two"]


def test_situate_missing_page_and_no_sentence(spark):
    pages = spark.createDataFrame(
        [("p1", "d", 1, "s/doc.pdf", "Alpha beta gamma. Beta only here.\nGamma beta"),
         ("p2", "d", 2, "s/doc.pdf", "... !!! ")],
        "page_id string, doc_id string, page_number int, gcs_pdf_path string, text string")
    targets = spark.createDataFrame([("p1",), ("p2",), ("nope",)], "page_id string")
    got = {r.page_id: (r.value, r.status) for r in SI.situate(targets, pages).collect()}
    assert got["nope"][1] == "FAILED"
    assert got["p2"] == ("", "SUCCESS")
    assert got["p1"] == ("s/doc.pdf\n\n\nAlpha beta gamma", "SUCCESS")


def test_embed_unit_norm_and_blank(spark, sf):
    from pagewright.operators.queues import queue
    q = queue(fx.pages_f3(spark, sf), "embed").select("page_id", "summary", "extracted_text")
    extra = spark.createDataFrame([("blank", "　", None), ("punct", "...", None)],
                                  "page_id string, summary string, extracted_text string")
    out = EM.embed(q.unionByName(extra)).collect()
    by = {r.page_id: r for r in out}
    assert by["blank"].status == "FAILED" and by["blank"].value is None
    assert by["punct"].status == "SUCCESS" and all(x == 0 for x in by["punct"].value)
    for r in out:
        if r.status == "SUCCESS" and r.page_id != "punct":
            assert len(r.value) == 768
            assert math.isclose(math.sqrt(sum(x * x for x in r.value)), 1.0, rel_tol=1e-5)


def test_plugin_errors_become_values(spark):
    def fn(pdf):
        if (pdf["payload"] == "bad").any():
            raise ValueError("model refused")
        return pdf.assign(value=pdf["payload"].str.upper(), error=None)

    df = spark.createDataFrame([("1", "ok"), ("2", "bad"), ("3", "fine")], "page_id string, payload string") \
        .coalesce(1)
    got = {r.page_id: (r.value, r.status) for r in EX.extract(df, extract_fn=fn).collect()}
    assert got == {"1": ("OK", "SUCCESS"), "2": ("", "FAILED"), "3": ("FINE", "SUCCESS")}


def test_plugin_output_schema(spark):
    df = spark.createDataFrame([("1", "x")], "page_id string, text string")
    out = run_plugin(df, lambda p: p.assign(value=[[1.0, 2.0]] * len(p), error=None), T.ArrayType(T.FloatType()))
    r = out.first()
    assert r.value == [1.0, 2.0] and r.status == "SUCCESS"


def test_vectorized_embed_equals_native(spark, sf):
    from pagewright.operators.queues import queue
    q = queue(fx.pages_f3(spark, sf), "embed").select("page_id", "summary", "extracted_text")
    a = {r.page_id: r.value for r in EM.embed(q).collect()}
    b = {r.page_id: r.value for r in EM.embed(q, vectorized=False).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or all(math.isclose(x, y, abs_tol=1e-6) for x, y in zip(a[k], b[k]))


def test_summary_plugin_gets_ordered_context(spark):
    pages = spark.createDataFrame(
        [(f"p{i}", "d", i, "s/doc.pdf", f"text{i}") for i in range(1, 8)],
        "page_id string, doc_id string, page_number int, gcs_pdf_path string, text string")
    targets = spark.createDataFrame([("p7",), ("p2",)], "page_id string")

    def summary_fn(pdf):
        import pandas as pd
        assert all(h.startswith("file_name: s/doc.pdf\ndescription: ") for h in pdf["header"])
        return pd.DataFrame({"page_id": pdf["page_id"],
                             "value": ["|".join(c) + ">" + t for c, t in zip(pdf["context"], pdf["text"])],
                             "error": None})

    got = {r.page_id: r.value for r in SI.situate(targets, pages, summary_fn=summary_fn).collect()}
    ctx = "|".join(f"text{i}" for i in range(1, 6))
    assert got == {"p7": ctx + ">text7", "p2": ctx + ">text2"}


def test_plugin_concurrency_cap(spark):
    df = spark.range(100).selectExpr("cast(id as string) page_id", "cast(id as string) text")

    def fn(pdf):
        return pdf.assign(value=pdf["text"], error=None)

    out = run_plugin(df, fn, T.StringType(), max_concurrency=3)
    assert out.rdd.getNumPartitions() == 3
    assert out.count() == 100 and out.filter("status = 'SUCCESS'").count() == 100
