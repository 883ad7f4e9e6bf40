"""The Python of embed and situate holds a small part of an Arrow batch as objects or doubles."""

import resource

import numpy as np
import pyarrow as pa

from pagewright.functions.tokens import _unit_vectors_arrow
from pagewright.operators import situate as SI
from pagewright.schemas import EMBED_DIM


def test_vectors_of_a_full_batch_take_little_more_than_themselves(spark):
    """F3 of round 3: before, a batch had three dense arrays of doubles."""
    rows, rng = 40_000, np.random.default_rng(1)
    buckets = pa.ListArray.from_arrays(np.arange(0, rows * 20 + 1, 20, dtype=np.int32),
                                       pa.array(rng.integers(0, EMBED_DIM, rows * 20), pa.int32()))
    fn = _unit_vectors_arrow(EMBED_DIM).func
    fn(buckets.slice(0, 10))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = fn(buckets)
    more_mb = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    assert more_mb < 2 * rows * EMBED_DIM * 4 / 1e6
    for i in (0, 255, 256, rows - 1):  # chunk ends
        dense = np.bincount(buckets[i].as_py(), minlength=EMBED_DIM).astype(float)
        assert got[i].as_py() == (dense / np.sqrt((dense * dense).sum())).astype(np.float32).tolist()
    # a slice of a longer array, with an empty row
    part = pa.array([[1], [2, 2, 3], [], [0]], pa.list_(pa.int32())).slice(1)
    out = fn(part)
    assert out[0][2].as_py() == np.float32(2 / np.sqrt(5.0)) and out[0][1].as_py() == 0 and not any(out[1].as_py())
    assert out[2][0].as_py() == 1 and len(fn(part.slice(0, 0))) == 0


def test_a_batch_has_the_weights_of_one_document_at_a_time(spark, monkeypatch):
    """F4 of round 3: before, a batch held the texts of all rows and the weights of all its documents."""
    made, alive = [], []
    weigh = SI.token_weights

    class Weights(dict):
        def __missing__(self, key):
            return 0

        def __del__(self):
            alive.remove(id(self))

    def counted(texts):
        w = Weights(weigh(texts))
        alive.append(id(w))
        made.append(len(alive))
        return w

    monkeypatch.setattr(SI, "token_weights", counted)
    docs = [f"d{i % 50}" for i in range(500)]
    texts = [f"Other words here. Word{i % 50} is it." for i in range(500)]
    out = SI._best_sentences.func(pa.array(docs), pa.array(texts), pa.array([t.lower() for t in texts]),
                                  pa.array([[f"word{d[1:]} is", "it is"] if d != "d7" else None for d in docs]))
    # each document is weighed once; the old weights go as the new ones come
    assert len(made) == 50 and max(made) <= 2
    assert out.to_pylist() == [f"Word{i % 50} is it." if i % 50 != 7 else "Other words here" for i in range(500)]
