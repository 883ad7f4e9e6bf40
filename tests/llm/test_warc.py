import base64
import hashlib
import random

import pytest

from pagewright.llm import warc as W


def b32(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def in_blocks(raw, size):
    return [raw[i:i + size] for i in range(0, len(raw), size)]


def archive(records):
    out = b"".join(r + W.END for r in records)
    return out + W.padding(len(out)) + W.END


@pytest.mark.parametrize("block,chunk", [(7, 5), (64, 1000), (W.BLOCK, 3)])
def test_records_come_back_from_any_blocks(monkeypatch, block, chunk):
    monkeypatch.setattr(W, "CHUNK", chunk)
    monkeypatch.setattr(W, "BLOCK", 4096)
    nasty = [b"", b"\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"x" * 50, "é\U0001f600".encode() * 9, b"\r\n\r\n" * 20]
    records = [W.record(i, f"http://h/{i}\r\nWARC-Type: no", p, hashlib.sha1(p).hexdigest(), None) for i, p in enumerate(nasty)]
    records.append(W.record(99, None, b"abc", hashlib.sha1(b"abc").hexdigest(), 3))
    raw = archive(records)
    assert len(raw) % 4096 == 0
    rows = list(W.chunks(in_blocks(raw, block)))
    for i, p in enumerate(nasty):
        own = [r for r in rows if r[0] == i]
        assert b"".join(r[10] for r in own) == p and [r[6] for r in own] == list(range(len(own)))
        assert all(len(r[10]) <= chunk for r in own) and [r[9] for r in own] == [False] * (len(own) - 1) + [True]
        done = 0
        for r in own:
            done += len(r[10])
            assert r[7] == done and r[8] == b32(p[:done])  # size and digest so far
        assert own[0][1] == "response" and own[0][4:6] == (len(p), b32(p)) and own[0][2].startswith(f"http://h/{i}%0D")
    last = rows[-1]
    assert last[:2] == (99, "revisit") and last[2] is None and last[3] == 3 and last[4:6] == (3, b32(b"abc"))


def test_memory_is_a_chunk_and_a_block():
    size = 40 << 20
    head = W._head("response", 1, "u", "X", None, size + 4 + 15) + b"HTTP/1.1 200 OK" + W.END

    def blocks():
        yield head
        for _ in range(size // W.BLOCK):
            yield b"z" * W.BLOCK
        yield W.END
    s = W.Stream(blocks())
    held = 0
    import unittest.mock as mock
    with mock.patch.object(W, "Stream", lambda b: s):
        for r in W.chunks(None, data=False):
            held = max(held, len(s.held))
    assert r[7] == size and r[9] and held <= 2 * W.BLOCK + W.CHUNK


def test_a_broken_archive_is_an_error():
    raw = archive([W.record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None)])
    for bad in (raw[:-4], raw[:60], b"no" + raw, raw.replace(b"abc\r\n", b"abcd\r\n", 1)):
        with pytest.raises(ValueError):
            list(W.chunks([bad]))


def expected(rows, least=0):
    """page_id -> (bytes, digest, type, refers_to) by dictionaries."""
    first = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= least and i is not None:
            first[raw] = max(i, first.get(raw, i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        f = first.get(raw)
        same = f is None or f == i
        out.append((i, len(raw), b32(raw), "response" if same else "revisit", None if same else f, True))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_pages_round_trip(spark, tmp_path, least):
    rng = random.Random(1)
    texts = [None, "", "é", "copy", "copy", "copy", "\r\n\r\n", "WARC/1.1\r\n\r\n", "long " * 70_000]
    rows = [(i, f"http://h/{i}" if i % 3 else None, t) for i, t in enumerate(texts)]
    rows += [(100 + i, "u", rng.choice(texts)) for i in range(60)] + [(5, "u", "copy"), (None, None, "copy"), (None, "u", "only null")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, sha1 string, first int")
    path = str(tmp_path / "a")
    W.write(pages.repartition(5), path, least)
    got = W.payloads(W.read_chunks(spark, path))
    want = expected(rows, least)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    bodies = W.read_chunks(spark, path).filter("record_type = 'response' and page_id = 8 or declared_bytes > 300000").collect()
    assert any(r.chunk for r in bodies)


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "a")
    W.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert W.read_chunks(spark, path).count() == 0
