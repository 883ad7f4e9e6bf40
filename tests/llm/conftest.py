import pytest

#: Documents with what operators must bear: nulls, empty and long texts, copies, ties, clashing column names.
EXTRA = "fp string, raw string, score string, ids string, leaks string, base string, spans string, lang string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    texts = [None, "", " \t\n", "one", "the cat sat on the mat and looked at the dog",
             "the cat sat on the mat and looked at the dog", "password=abcdef123 \U0001f600 é", long, "x" * 70_000, "a\x00b\x1f c"]
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)]
    rows += [rows[4], (None, None, None), (None, "no id here", "en")]
    return spark.createDataFrame([(i, t, *["clash"] * 7, g) for i, t, g in rows], f"doc_id long, text string, {EXTRA}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {EXTRA}")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
