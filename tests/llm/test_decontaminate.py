import random

import pytest
from pyspark.sql import functions as F

from pagewright.llm import decontaminate as D


def brute_tiles(item, doc, least):
    a, b, out = [0] * len(item), [0] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while (i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] >= 0
                       and not a[i + k] and not b[j + k]):
                    k += 1
                if k >= least and (best is None or k > best[0]):
                    best = (k, i, j)
        if not best:
            return out
        out.append(best)
        k, i, j = best
        a[i:i + k], b[j:j + k] = [1] * k, [1] * k


def test_tiles_match_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 14))]
        doc = [rng.randrange(-1, 4) for _ in range(rng.randrange(1, 30))]
        assert D.tiles(item, doc, 2) == brute_tiles(item, doc, 2)
        assert D.tiles(item, doc) == brute_tiles(item, doc, 3)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def coverages(spark, texts, items, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: [(x.item_id, round(x.coverage, 3)) for x in r.leaks] for r in D.leaks(docs, bench, ["doc_id"], **kw).collect()}


def test_reordered_and_edited_passages(spark):
    w = ITEM.split()
    texts = [
        "start. " + ITEM.upper() + ", end",
        " ".join(w[12:] + ["between"] + w[6:12] + ["x"] + w[:6]),  # reordered pieces
        " ".join(w[:9] + ["changed"] + w[10:]),  # one word changed
        " ".join(w[:10]),  # half of it
        " ".join(w[::-1]),  # backwards
        "nothing of it", None, "",
    ]
    got = coverages(spark, texts, [(1, ITEM), (2, None), (3, ""), (4, "two words"), (5, "a b c d")])
    assert got == {0: [(1, 1.0)], 1: [(1, 1.0)], 2: [(1, 0.95)], 3: [], 4: [], 5: [], 6: [], 7: []}
    assert coverages(spark, ["q a b c d q"], [(5, "a b c d"), (5, "a b c d")]) == {0: [(5, 1.0), (5, 1.0)]}


def test_blocks_and_repeats(spark):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choices([f"w{k}" for k in range(60)], k=20))) for i in range(40)] + [(None, ITEM)]
    texts = [f"x {items[i][1]} y {items[(i * 3) % 40][1]}" for i in range(40)] + [f"{ITEM} {ITEM}"] * 2
    one = coverages(spark, texts, items)
    assert coverages(spark, texts, items, block_letters=300) == one
    assert one[40] == one[41] == [(None, 1.0)]
    assert all({i, i * 3 % 40} <= {k for k, _ in one[i]} for i in range(40))


def test_repeated_ids_and_items_spread_over_blocks(spark, monkeypatch):
    rng = random.Random(6)
    items = [(None, " ".join(rng.choices([f"w{k}" for k in range(80)], k=20))) for _ in range(60)] + [(7, ITEM)] * 500
    texts = [f"x {t} y" for _, t in items[:60]] + [ITEM]
    sizes, init = [], D.Block.__init__
    monkeypatch.setattr(D.Block, "__init__", lambda block, rows: (sizes.append(sum(len(t) for _, t, _ in rows)), init(block, rows))[1])
    got = coverages(spark, texts, items, block_letters=1000)
    assert len(sizes) > 3 and max(sizes) < 3000
    assert got[60] == [(7, 1.0)] * 500 and all(got[i] == [(None, 1.0)] for i in range(60))


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")
    for name in ("leaks", "__leaks"):
        with pytest.raises(ValueError, match="leaks"):
            D.leaks(odd_docs.withColumn(name, F.lit(1)), bench, ["doc_id", name])
    got = D.leaks(odd_docs, bench, ["doc_id", "ids"])
    assert got.count() == odd_docs.count()
    assert sorted(r.doc_id for r in got.collect() if r.leaks) == [4, 4, 5]
    assert D.leaks(no_docs, bench, ["doc_id"]).count() == 0
    assert not any(r.leaks for r in D.leaks(odd_docs, bench.limit(0), ["doc_id"]).collect())


def test_documents_match_brute_force(spark, sf):
    bench = [(r.item_id, D.words_of(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = D.words_of(r.text or "")
        grams = {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in (1, 2, 3)}
        for i, item in bench:
            # a tile is made of shared grams of three words (of all words in a shorter item), so tiles cover no more than these
            n = min(3, len(item))
            covered = {k + j for k in range(len(item) - n + 1) if tuple(item[k:k + n]) in grams[max(1, n)] for j in range(n)}
            if item and n < 3 and len(covered) == len(item):
                want.add((r.doc_id, i, 1.0))
            elif n == 3 and len(covered) >= 0.8 * len(item):
                names = {w: n for n, w in enumerate(item)}
                near = [names.get(w, -1) for w in words]
                share = sum(t[0] for t in brute_tiles([names[w] for w in item], near, 3)) / len(item)
                if share >= 0.8:
                    want.add((r.doc_id, i, round(share, 9)))
    got = {(r.doc_id, r.item_id, round(r.coverage, 9)) for r in D.op7_decontaminate(spark, sf).collect()}
    assert got == want and want


def test_short_pieces_match_brute_force_without_seeds():
    """Every item is tiled against every document; no candidate filter."""
    rng = random.Random(3)
    names = range(400)
    text = lambda words: " ".join(f"w{w}" for w in words)
    items = [rng.choices(names, k=rng.randrange(1, 30)) for _ in range(40)]
    docs = []
    for item in items:
        at, pieces = 0, []
        while at < len(item):
            n = rng.choice([3, 3, 4])
            pieces.append(item[at:at + n])
            at += n
        rng.shuffle(pieces)
        docs.append([w for p in pieces for w in [*p, rng.choice(names)]])
        docs.append([rng.choice(names) if i % 5 == 4 else w for i, w in enumerate(item)])  # coverage 0.8 at least
        docs.append(rng.choices(names, k=20))
    block = D.Block([(n, text(item), 1) for n, item in enumerate(items)])
    gated = found = 0
    for doc in docs:
        want = []
        for n, item in enumerate(items):
            least = min(3, len(item))
            share = sum(t[0] for t in brute_tiles(item, doc, least)) / len(item) if len(item) > 2 else float(
                any(doc[i:i + len(item)] == item for i in range(len(doc))))
            if share >= 0.8:
                want.append((n, share))
                grams = {tuple(doc[i:i + 5]) for i in range(len(doc) - 4)}
                gated += len(item) >= 5 and not any(tuple(item[k:k + 5]) in grams for k in range(len(item) - 4))
        assert sorted(block.leaks(text(doc))) == want
        found += len(want)
    assert gated > 20 and found > gated


def test_items_of_one_or_two_words(spark):
    got = coverages(spark, ["say Two words here", "words two", "alone", None], [(1, "two words"), (2, "alone"), (2, "alone"), (3, "?")])
    assert got == {0: [(1, 1.0)], 1: [], 2: [(2, 1.0), (2, 1.0)], 3: []}
