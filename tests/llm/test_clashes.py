import pytest
from pyspark.sql import functions as F

from pagewright.llm import bpe, decontaminate, fill_in_middle, quality_classifier, quality_rules, secrets, token_counts


@pytest.fixture()
def calls(odd_docs, spark):
    bench = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    return {"base": secrets.secrets, "n_tokens": token_counts.token_counts, "kept": quality_rules.quality, "ids": bpe.encode,
            "leaks": lambda d, keep: decontaminate.leaks(d, bench, keep),
            "words": lambda d, keep: quality_classifier.classify(d, labels, keep),
            "score": lambda d, keep: quality_classifier.classify(d, labels, keep),
            "form": fill_in_middle.fill_in_middle,
            "decoded": lambda d, keep: bpe.decode(d.withColumn("ids", F.array(F.lit(5))), keep)}


def test_a_kept_column_with_a_results_name_is_an_error(odd_docs, calls):
    """The clashing column is there in every call; only keeping it is an error."""
    for name, call in calls.items():
        docs = odd_docs.withColumn(name, F.lit("clash"))
        with pytest.raises(ValueError, match=name):
            call(docs, ["doc_id", name])


def test_the_same_columns_are_ignored_when_not_kept(odd_docs, calls):
    n = odd_docs.count()
    for name, call in calls.items():
        if name in ("n_tokens", "ids", "leaks", "base"):
            assert call(odd_docs.withColumn(name, F.lit("clash")), ["doc_id"]).count() == n, name


def test_names_are_compared_in_any_case(odd_docs):
    with pytest.raises(ValueError, match="ids"):
        bpe.encode(odd_docs.withColumnRenamed("ids", "IDS"), ["IDS"])
