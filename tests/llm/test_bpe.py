import hashlib
import random

import pytest

from pagewright.llm import bpe as B


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.VOCABULARY)


def library(codec, text):
    return codec.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 2, 4, 9])
def test_any_cuts_give_the_library_s_ids(codec, monkeypatch, bits):
    monkeypatch.setattr(B, "CUT_BITS", bits)
    codec.young.clear(), codec.old.clear()
    rng = random.Random(bits)
    letters = [*"ab  \n\t.'s　  ​日本語é%1 2<|endoftext|> \x1c\x85\U0001f600́", B.SPECIAL, "  ", "don't ", "   x"]
    for _ in range(700):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(160)))
        ids = codec.encode(t).tolist()
        assert ids == library(codec, t), t
        assert codec.decode(ids) == codec.tokenizer.decode(ids, skip_special_tokens=False)


def test_both_vocabularies_agree_on_plain_letters(codec):
    for p in range(9, 0x250):
        for around in ("a%sb", "1%s1", " %s ", "!%s?", "\n%s\n", "'%s'", "%s%s"):
            t = around.replace("%s", chr(p))
            if B._PLAIN.fullmatch(t):
                assert codec.fast.encode_ordinary(t) == library(codec, t), t


def test_equal_passages_have_equal_cuts():
    rng = random.Random(0)
    passage = " ".join(f"{rng.getrandbits(40):x}" for _ in range(2000))
    a, b = (B.cuts(lead + passage) - len(lead) for lead in ("x" * 10, "other start " * 50))
    assert set(a[a > 20]) == set(b[b > 20]) and len(a) > 10


def test_blocks_don_t_move_cuts(monkeypatch):
    t = " ".join(str(i * i) for i in range(5000))
    whole = B.cuts(t)
    monkeypatch.setattr(B, "BLOCK", 1000)
    assert B.cuts(t).tolist() == whole.tolist()


def test_forgetting_chunks_changes_nothing(codec, monkeypatch):
    t = " ".join(f"w{i % 300}" for i in range(4000))
    monkeypatch.setattr(B, "REMEMBERED", 1000)
    codec.young, codec.old, codec.room = {}, {}, 500
    assert codec.encode(t * 3).tolist() == library(codec, t * 3)
    assert sum(map(len, codec.young)) + sum(map(len, codec.old)) < 20_000


def test_rows(odd_docs, no_docs):
    own = odd_docs.drop("ids")
    got = B.decode(B.encode(own, ["doc_id", "raw", "text"]), ["doc_id", "raw", "text", "ids"]).collect()
    assert len(got) == own.count() and all(r.decoded == (r.text or "") for r in got)
    assert B.encode(no_docs.drop("ids"), ["doc_id"]).count() == 0
    assert {len(r.ids) for r in got if not r.text} == {0}


def test_query(spark, sf, codec):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = B.op6_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library(codec, docs[r.doc_id])
        text = codec.tokenizer.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
