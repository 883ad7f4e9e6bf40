import hashlib
import random
import string

import pytest
from pyspark.sql import functions as F

from pagewright.llm import fill_in_middle as M


def units(text):
    """Runs of letters and single other characters, one character after the other."""
    out = []
    for c in text:
        letter = c in string.ascii_letters
        if letter and out and out[-1][1]:
            out[-1][0] += c
        else:
            out.append([c, letter])
    return [u for u, _ in out]


def brute(text, doc_id, seed=1):
    u = units(text)
    h = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return len(u), "plain", None, None, text
    lo, hi = sorted([h1 % (len(u) + 1), h2 % (len(u) + 1)])
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if h4 % 100 < 20:
        return len(u), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(u), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def test_cuts_match_brute_force():
    rng = random.Random(0)
    alphabet = "abZ 1é\n😀<>PSM/"
    for i in range(3000):
        t = "".join(rng.choices(alphabet, k=rng.randrange(0, 30)))
        assert M.cut(t, i) == brute(t, i)
        assert M.cut(t, i, 7) == brute(t, i, 7)
    assert {M.cut("a b", i)[1] for i in range(200)} == {"plain", "psm", "spm"}


def test_a_long_text_is_cut_whole():
    t = "word, " * 200_000 + "x" * 300_000
    assert M.cut(t, 3) == brute(t, 3)


@pytest.mark.parametrize("texts", [["<", "<S", "<P", "S>", "a<", "<<", "<M", ">", "P>x<S"], ["é<😀", "\n\n", "a\x00b"]])
def test_texts_are_restored(spark, texts):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices(texts, k=rng.randrange(0, 6)))) for i in range(400)]
    got = M.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"])
    got = got.withColumn("back", M.restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == 400 and all(r.back == r.text for r in got)
    assert all((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.text, r.doc_id) for r in got)


def test_odd_rows(spark, odd_docs, no_docs):
    got = M.fill_in_middle(odd_docs, ["doc_id", "text", "base", "lang"]).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.text or "", "" if r.doc_id is None else r.doc_id)
    assert all(r.form == "plain" and r.n == 0 and r.output == "" for r in got if not r.text)
    assert M.fill_in_middle(no_docs, ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="form"):
        M.fill_in_middle(odd_docs.withColumn("form", F.lit(1)), ["doc_id", "form"])
    assert M.fill_in_middle(odd_docs.withColumn("form", F.lit(1)), ["doc_id"]).count() == len(got)
