import random

import numpy as np
import pytest

from pagewright.llm import minhash as M


def brute_set(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    return {" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent=85):
    """[(doc_id, size, component)] by comparing all pairs of whole sets."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[top(i)] = min(d, ids.get(top(i), d))
    return [(d, len(sets[i]), ids.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def by_row(out):
    return sorted(out, key=lambda r: (r[0] is None, r))


def changed(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def corpus(rng):
    """Groups around the threshold, chains, one large group, and documents that share a long passage."""
    texts = []
    for size in (3, 4, 20, 60, 300):
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        texts += [" ".join(changed(rng, base, rng.randrange(0, 1 + size // 12))) for _ in range(12)]
        chain = base
        for _ in range(6):
            chain = changed(rng, chain, max(1, size // 50))
            texts.append(" ".join(chain))
    big = [f"v{i}" for i in range(80)]
    texts += [" ".join(changed(rng, big, rng.randrange(0, 5))).upper() for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(100))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(60)]
    texts += [None, "", " \n\t", "one", "One", "one two", "a b c", "A B\tC", texts[0], texts[0]]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_set_is_the_defined_one():
    for t in ("", " \n", "One", "A b", "A b C", "a B c d", "x y z x y z x y", "Ünï É Z z \x1f q", "a\x00b c d e"):
        assert len(M.shingle_set(t.encode())) == len(brute_set(t))
    assert (M.shingle_set(b"A  b\nC") == M.shingle_set(b"a b c")).all()


def test_every_coordinate_is_filled_and_depends_on_the_set_only():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 2**64, n, np.uint64)) for n in (1, 2, 3, 10, 100, 159, 1000, 5000)]
    got = M.sketches([*sets, np.empty(0, np.uint64)])
    assert (got[:-1] != M._EMPTY).all() and (got[-1] == M._EMPTY).all()
    assert all((M.sketches([s]) == got[i]).all() for i, s in enumerate(sets))
    assert len(M.sketches([])) == 0


@pytest.mark.parametrize("n", [3, 30, 2000])
def test_agreement_is_concentrated_around_the_similarity(n):
    rng = np.random.default_rng(n)
    shares, want = [], []
    for _ in range(150):
        common = rng.integers(0, 2**64, n, np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**64, max(1, n // 10), np.uint64)])) for _ in range(2))
        x, y = M.sketches([a, b])
        shares.append((x == y).mean())
        want.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(shares) - np.mean(want)) < 0.02
    # drawn one by one, the deviation would be sqrt(p (1 - p) / 160)
    p = np.mean(want)
    assert np.std(np.array(shares) - np.array(want)) < 1.3 * (p * (1 - p) / M.SIZE) ** 0.5


def test_group_links_join_what_all_pairs_join():
    rng = random.Random(2)
    rows = corpus(rng)[:150]
    sets = [M.shingle_set((t or "").encode()) for _, t in rows]
    sets = [s for s in {s.tobytes(): s for s in sets if len(s)}.values()]
    near = {(a, b) for b in range(len(sets)) for a in range(b)
            if M.enough(len(sets[a]), len(sets[b]), len(np.intersect1d(sets[a], sets[b])), 85)}

    def groups(pairs):
        forest = M.Forest(len(sets))
        x = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        forest.join(x[:, 0], x[:, 1])
        return forest.roots(np.arange(len(sets))).tolist()
    alone, side = np.arange(len(sets)), np.array([rng.randrange(2) for _ in sets])
    got = M.group_links(sets, alone, np.full(len(sets), -1), 85)
    assert {tuple(sorted(p)) for p in got} <= near and groups(got) == groups(near) and len(got) < len(sets)
    across = {p for p in near if side[p[0]] != side[p[1]]}
    assert groups(M.group_links(sets, alone, side, 85)) == groups(across)
    # what is joined already is not linked again
    assert M.group_links(sets, np.array(groups(near)), np.full(len(sets), -1), 85) == []


@pytest.mark.parametrize("block", [M.BLOCK, 400])
def test_components_match_brute_force(spark, block):
    rows = corpus(random.Random(7))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = M.near_duplicates(df, block=block).collect()
    assert by_row((r.doc_id, r.n_shingles, r.component_id) for r in got) == by_row(brute(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_threshold_is_met_exactly(spark):
    # 17 of 20 shingles are 85 percent; 16 of 19 and 169 of 199 are just less
    def pair(both, one, two):
        a = [f"c{both}x{i}" for i in range(both + 2)]
        return [" ".join(a + [f"l{both}y{i}" for i in range(one)]), " ".join([f"r{both}z{i}" for i in range(two)] + a)]
    texts = pair(17, 2, 1) + pair(16, 2, 1) + pair(169, 15, 15) + pair(170, 15, 15)
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = M.near_duplicates(odd_docs.withColumnRenamed("raw", "kept")).collect()
    assert by_row((r.doc_id, r.n_shingles, r.component_id) for r in got) == by_row(brute(rows))
    assert M.near_duplicates(no_docs).count() == 0
    only = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, None)], "doc_id long, text string")
    assert [(r.component_id, r.kept) for r in M.near_duplicates(only).collect()] == [(None, True)] * 3


def test_documents_match_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = M.op13_minhash(spark, sf).collect()
    assert by_row((r.doc_id, r.n_shingles, r.component_id) for r in got) == by_row(brute(rows))
