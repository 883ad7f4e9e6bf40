"""A training corpus from ``documents``, in five stages.

Every stage works on all rows its predecessor kept and is written as Parquet
before the next reads it. All but the last return the columns of
``documents``; the last returns the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import bpe, decontaminate, secrets, simhash, toxicity
from pagewright.llm.common import table, written


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with neutral names for all columns but ``doc_id`` and ``text``, so that none clashes with a result."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"__{i}" for i, c in enumerate(docs.columns)))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't predict to be toxic."""
    own = _plain(docs)
    kept = toxicity.toxicity(own, table(spark, sf_dir, "labels")).filter("predicted = 0")
    return kept.select(*own.columns).toDF(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.representatives(_plain(docs)).toDF(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    own = _plain(docs)
    kept = decontaminate.leaks(own, table(spark, sf_dir, "benchmark"), own.columns).filter(F.size("leaks") == 0)
    return kept.select(*own.columns).toDF(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` follows the text (null for a null text)."""
    own = _plain(docs)
    new = secrets.secrets(own, [c for c in own.columns if c != "text"], mask=True)
    changed = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    return new.select(*(changed.get(c, F.col(o)).alias(c) for c, o in zip(docs.columns, own.columns)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of the text, and digests of ids and decoded text."""
    encoded = bpe.decode(bpe.encode(docs, ["doc_id"]), ["doc_id", "ids"])
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), *bpe.digest_columns())


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", tokens),
]

#: The stages' scores, searches and decoders have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
