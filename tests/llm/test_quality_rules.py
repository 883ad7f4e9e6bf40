import math
import random
from collections import Counter

import numpy as np
import pytest

from pagewright.llm import quality_rules as Q


def brute_counts(text):
    for c in "\t\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.replace(" ", "")]
    return (len(words), sum(len(w) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_match_brute_force():
    rng = random.Random(0)
    for _ in range(1500):
        t = "".join(rng.choices(["a ", "b ", "é x ", "\n", " ", "# ", "c\t"], k=rng.randrange(80)))
        assert Q.counts(t, Q._WORD.findall(t)) == brute_counts(t.replace("\t", " ")), t


def test_repeats_among_many_distinct_words():
    rng = random.Random(1)
    words = [str(rng.randrange(40_000)) for _ in range(60_000)]
    words += words[100:140]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    assert Q.repeated_words(words) == len(covered) >= 80


def test_divergence():
    p, q = np.array([[1.0, 0.0], [0.5, 0.5], [0.0, 1.0]]), np.array([1.0, 0.0])
    assert Q.divergence(p, q) == pytest.approx([0, 1 - 0.75 * math.log2(3) + 0.5, 1], abs=1e-9)


def test_class_blocks():
    assert Q.character_classes("aB 1#.\né\U0001f600'").tolist() == [1, 0, 1, 1, 1, 1, 1, 1, 1, 1, 1]


def sentence(rng, words, common):
    return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choices(words, k=3)) for _ in range(120))


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(4)
    two = {"en": (["tha", "ing", "ber"], ["the", "of", "and"]), "xx": (["zók", "éro", "uíl"], ["ol", "et", "un"])}
    rows = [(i, sentence(rng, *two[g]) + ".", g) for i in range(80) for g in two]
    rows = [(k, t, g) for k, (_, t, g) in enumerate(rows)]
    odd = [(1000, " ".join("QX9#%$&|"[rng.randrange(8)] * 4 + str(rng.random()) for _ in range(100)), "en"),
           (1001, "Short but fine text of more than ten plain words in all.", "en"), (1002, "too short", "en"),
           (1003, "say it " * 60, "en"), (1004, None, "en"), (1005, "", None), (1006, sentence(rng, *two["xx"]), None)]
    docs = spark.createDataFrame(rows + odd + [rows[0]], "doc_id long, text string, lang string")
    return docs, {r.doc_id: r for r in Q.quality(docs, ["doc_id"]).collect()}


def test_verdicts(judged):
    docs, got = judged
    assert all(got[i].kept and got[i].language == ("en" if i % 2 == 0 else "xx") for i in range(160))
    assert {i: (got[i].base_failed, got[i].kept) for i in range(1000, 1007)} == {
        1000: (False, False), 1001: (False, True), 1002: (True, False), 1003: (True, False), 1004: (True, False),
        1005: (True, False), 1006: (False, True)}
    assert got[1006].language == "xx" and got[1001].char_distance is None


def test_verdicts_match_plain_distances(judged):
    """Distances of one document recomputed with dictionaries."""
    docs, got = judged
    rows = {r.doc_id: r for r in docs.dropDuplicates(["doc_id"]).collect()}
    # repeated rows count in the references as often as they stand
    good = [r for r in docs.collect() if r.lang and r.doc_id < 1000] + [rows[1000]]
    en = [r for r in good if r.lang == "en"]
    bare = {r.doc_id: Q._bare(Q._WORD.findall(r.text)) for r in en}
    total = Counter(w for r in en for w in bare[r.doc_id])
    common = sorted(total, key=lambda w: (-total[w], w))[:Q.COMMON_WORDS]
    cut = {w for w in total if total[w] == total[common[-1]]}

    def shares(ws):
        c = Counter(ws)
        h = [c[w] / len(ws) for w in common]
        return np.array([*h, 1 - sum(h)])
    if len(cut & set(common)) == len(cut) or True:
        ref = np.mean([shares(bare[r.doc_id]) for r in en], axis=0)
        mine = math.sqrt(Q.divergence(shares(bare[0])[None], ref)[0])
        assert got[0].word_distance == pytest.approx(mine, abs=0.02)
    cls = [Q.character_classes(r.text) / len(r.text) for r in en]
    ref = np.mean(cls, axis=0)
    mine = math.sqrt(Q.divergence((Q.character_classes(rows[0].text) / len(rows[0].text))[None], ref)[0])
    assert got[0].char_distance == pytest.approx(mine, abs=1e-9)


def test_common_words_of_a_flat_language_are_counted_exactly(spark):
    """Every word is rare, and rows fall into tasks in different ways."""
    rng = random.Random(5)
    common = [f"c{k:02}" for k in range(Q.COMMON_WORDS)]
    words = [w for w in common for _ in range(5)] + [f"u{k}" for k in range(300_000)] + [f"d{k}" for k in range(2_000)] * 4
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::300]), "xx") for i in range(300)]
    rows += [(1000 + i, "short c00", "xx") for i in range(50)] + [(2000, "again and " * 500, "xx"), (2001, "other " * 300, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(Q.common_candidates(Q.common_words(docs.repartition(n))) == common for n in (1, 5))


def test_odd_rows(odd_docs, no_docs, spark):
    own = odd_docs.toDF(*[f"c{i}" if c == "lang" and i < 9 else c for i, c in enumerate(odd_docs.columns)])
    got = Q.quality(own, ["doc_id"])
    assert got.count() == own.count()
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert Q.quality(empty, ["doc_id"]).count() == 0


def rows_of(df, but=()):
    return {r.doc_id: tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect() if r.doc_id not in but}


@pytest.mark.parametrize("languages", [1, 2])
def test_blocks_of_languages_change_nothing(judged, spark, monkeypatch, languages):
    docs, _ = judged
    rng = random.Random(3)
    more = []
    for k in range(6):  # six more languages, of few words each
        words = [f"{'qzjxkv'[k]}{'aeiou'[i % 5]}{i}" for i in range(30 + 20 * k)]
        more += [(5000 + 100 * k + i, " ".join(rng.choices(words, k=120)), f"l{k}") for i in range(8)]
    docs = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    want = rows_of(Q.quality(docs, ["doc_id"]))
    monkeypatch.setattr(Q, "LANGUAGES", languages)
    got = Q.quality(docs, ["doc_id"])
    assert rows_of(got) == want and got.count() == docs.count()
    assert {r[-3] for r in want.values()} >= {"en", "xx", "l0", "l5"}


def test_foreign_rows_change_no_verdict(judged, spark):
    docs, got = judged
    docs = docs.select("doc_id", "text", "lang")
    strange = spark.range(9000, 10_001).selectExpr("id doc_id", "if(id % 2 = 0, '', 'a few words') text", "concat('v', id) lang")
    new = rows_of(Q.quality(docs.union(strange), ["doc_id"]), range(9000, 10_001))
    assert new == rows_of(Q.quality(docs, ["doc_id"]))


def test_query(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op5_quality_rules(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(docs[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.kept == bool(labels[r.doc_id]) for r in got if r.doc_id in labels and r.n_words >= 50)
