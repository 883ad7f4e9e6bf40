import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from pagewright.llm import decontaminate as D
from pagewright.llm import secrets as S
from pagewright.llm.common import written
from pagewright.llm.toxicity import toxicity

from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage over the whole table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in P.STAGES:
        new = written(stage(spark, docs, SF), name)
        out[name] = (docs, new)
        docs = new
    return out


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]
    for name, (docs, new) in list(stages.items())[:-1]:
        assert new.dtypes == docs.dtypes, name


def test_toxic_documents_go(spark, stages):
    docs, new = stages["toxicity"]
    scored = toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 0")
    assert sorted(r.doc_id for r in new.collect()) == sorted(r.doc_id for r in scored.collect())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in new.collect()}
    assert all(i in kept for i, y in labels.items() if not y)
    assert sum(i not in kept for i, y in labels.items() if y) > 0.6 * sum(labels.values())


def test_one_document_of_each_group_stays(stages):
    docs, new = stages["near_duplicates"]
    group = brute_components({r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}, 4)
    assert sorted(r.doc_id for r in new.collect()) == sorted({g for g in group.values()})


def test_leaking_documents_go(spark, stages):
    docs, new = stages["decontamination"]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    block = D.Block(bench)
    assert sorted(r.doc_id for r in new.collect()) == sorted(r.doc_id for r in docs.collect() if not block.leaks(r.text or ""))
    whole = [" ".join(D.words_of(t)) for _, t in bench]
    assert not any(t in " ".join(D.words_of(r.text or "")) for r in new.collect() for t in whole)


def test_secrets_are_masked(stages):
    docs, new = stages["secrets"]
    before = {r.doc_id: r for r in docs.collect()}
    rows = new.collect()
    assert len(rows) == len(before)
    for r in rows:
        old = before[r.doc_id]
        assert r.text == S.masked(old.text, S.scan(old.text)[1]) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (old.lang, old.source)
    assert any("[SECRET]" in r.text for r in rows)


def test_tokens_are_the_text(stages):
    docs, new = stages["bpe"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = new.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_all_stages(spark, stages):
    assert sorted(map(tuple, P.run(spark, SF).drop("ids").collect())) == sorted(map(tuple, stages["bpe"][1].drop("ids").collect()))


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs.withColumn("n_chars", F.length("text").cast("long")), no_docs):
        n = docs.count()
        for name, stage in P.STAGES:
            new = written(stage(spark, docs, SF), name)
            assert new.count() <= n and (name == "bpe" or new.columns == docs.columns)
            docs = new
