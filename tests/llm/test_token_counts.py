import random

import pyarrow as pa
import pytest

from pagewright.llm import token_counts as C


def brute(word, scores, byte):
    """Tokens of the best split by plain dynamic programming over the whole word; ``byte`` is the score of a byte."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        ways = [(best[end - 1][0] + n * byte, -(best[end - 1][1] + n))]
        ways += [(best[b][0] + scores[word[b:end]], -(best[b][1] + 1)) for b in range(end) if word[b:end] in scores]
        score, tokens = max(ways)
        best.append((score, -tokens))
    return best[-1][1]


def test_counts_match_plain_dynamic_programming(monkeypatch):
    rng = random.Random(0)
    scores = {"".join(rng.choices("abc", k=rng.randrange(1, 5))): -float(rng.randrange(1, 9)) for _ in range(25)}
    words = ["".join(rng.choices("abcé", k=rng.randrange(0, 20))) for _ in range(800)] + ["ab" * 60, "aéb" * 40]
    t = C.Trie(scores)
    assert [t.count(w) for w in words] == [brute(w, scores, t.byte) for w in words]
    monkeypatch.setattr(C, "NODES", 30)
    t = C.Trie(scores)
    assert [t.count(w) for w in words] == [brute(w, scores, t.byte) for w in words]


def test_shared_prefixes_are_computed_once():
    t, steps = C.Trie({"a": -1.0, "ab": -1.5}), []
    step = t._step
    t._step = lambda w, b: steps.append(w) or step(w, b)
    assert [t.count(w) for w in ("abc", "abd", "abc", "ab")] == [2, 2, 2, 1]
    assert len(steps) == 4  # a, ab, abc, abd


@pytest.mark.parametrize("nodes, words", [(500_000, 1 << 14), (200, 50)])
def test_new_pretokens_are_inserted_a_depth_at_a_time(monkeypatch, nodes, words):
    monkeypatch.setattr(C, "NODES", nodes)
    monkeypatch.setattr(C, "WORDS", words)
    rng = random.Random(1)
    letters = "abc\x00é\u2581漢\U0001f600"
    scores = {"".join(rng.choices(letters, k=rng.randrange(1, 6))): -float(rng.randrange(1, 9)) for _ in range(60)}
    new = ["".join(rng.choices(letters, k=rng.randrange(0, 12))) for _ in range(2000)] + ["ab漢" * n for n in range(18, 30)]
    t, steps = C.Trie(scores), []
    step = t._step
    t._step = lambda w, b: steps.append(w) or step(w, b)
    for _ in range(2):
        assert t.counts(pa.array(new, pa.large_string())).tolist() == [brute(w, scores, t.byte) for w in new]
    if nodes > 200:
        assert len(steps) == C.LONGEST_KEPT // 3 * 3  # not one for every prefix, nor any in the second round


def test_no_pieces():
    t = C.Trie({})
    assert t.counts(pa.array(["", "a", "é漢", "x" * 70], pa.large_string())).tolist() == [0, 1, 5, 70]


def test_pretokens_are_the_words_of_each_text():
    blanks = "\x20\t\n\x0b\x0c\r"
    texts = ["x", None, "", blanks, "a b", "c", " d\t\te ", f"é{blanks}漢", "\xa0\x85\x1c\u2028 \x08\x0e\x00", "a", "", "b "]
    for column in (pa.array(texts), pa.array(texts)[3:9], pa.array(texts, pa.large_string())[1:], pa.array(texts)[:0],
                   pa.array([None, ""], pa.string())):
        words, rows = C.pretokens(column)
        words = words.to_pylist()
        assert [words[a:z] for a, z in zip(rows[:-1], rows[1:])] == [C._WORD.findall(x or "") for x in column.to_pylist()]


def test_rows(spark, odd_docs, no_docs, sf):
    scores = C.pieces(C.VOCABULARY)
    byte = C.Trie(scores).byte
    got = C.token_counts(odd_docs, ["doc_id", "ids", "text"]).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if not r.text or len(r.text) < 1000:
            words = C._WORD.findall(r.text or "")
            assert (r.n_pretokens, r.n_tokens) == (len(words), sum(brute(C.MARK + w, scores, byte) for w in words))
    assert C.token_counts(no_docs, ["doc_id"]).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(30).collect()}
    query = {r.doc_id: r for r in C.op3_token_counts(spark, sf).collect()}
    assert all(query[i].n_tokens == sum(brute(C.MARK + w, scores, byte) for w in C._WORD.findall(t)) for i, t in docs.items())
