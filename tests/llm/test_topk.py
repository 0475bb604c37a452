import math
import random

import numpy as np
import pytest

from rillmark.llm import topk
from tests.llm.helpers import rows

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(vectors, k=5, every=50):
    sound = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, _ in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, v in sound:
        if i % every == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in sound if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def test_awkward_vectors(spark):
    draw = random.Random(1)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(6)], 0) for i in range(400)]
    vectors += [(i, [0.5] * 6, 0) for i in range(400, 520)]
    vectors += [(50, [0.25] * 6, 0), (60, [0.5] * 6, 0), (60, [0.5] * 6, 0), (-100, [1.0] * 6, None)]
    vectors += [(600, None, 0), (650, [None] * 6, 0), (700, [float("nan")] * 6, 0), (750, [float("inf")] * 6, 0), (None, [9.0] * 6, 0)]
    vectors += [(800, [1.0, 2.0], 0), (801, [1.0, 3.0], 0), (850, [], 0), (900, [], 0), (950, [4.0], 0)]
    frame = spark.createDataFrame(vectors, SCHEMA)
    assert rows(topk.top_k(frame)) == plain(vectors)
    assert topk.top_k(frame.limit(0)).collect() == []


@pytest.mark.parametrize("block", [4096, 3])
def test_blocks_and_many_batches(spark, monkeypatch, block):
    draw = random.Random(2)
    vectors = [(i, [draw.choice([-0.5, 0.0, 0.25]) for _ in range(4)], 0) for i in range(700)]
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    assert rows(topk.top_k(spark.createDataFrame(vectors, SCHEMA))) == plain(vectors)


def test_huge_components_stay_exact():
    vectors = np.array([[2.0**31, 1.0], [2.0**31, 2.0], [2.0**40, 0.0]])
    assert topk._products(vectors, np.array([2.0**31, 1.0])).tolist() == [2**62 + 1, 2**62 + 2, 2**63 - 1]


def test_elimination_evaluates_few(monkeypatch):
    """Candidates near the query are found without evaluating the rest."""
    draw = np.random.default_rng(3)
    centres = draw.integers(-200, 200, (40, 16))
    vectors = (centres[draw.integers(0, 40, 4000)] + draw.integers(-3, 4, (4000, 16))).astype(float)
    ids = np.arange(4000)
    known = topk.prepare([(int(i), (vectors[i] / 256).tolist()) for i in range(0, 4000, 50)])[16]
    seen = []
    products = topk._products
    monkeypatch.setattr(topk, "_products", lambda v, q: (seen.append(len(v)), products(v, q))[1])
    best = topk.Best(len(known.ids), 5)
    topk.search_block(known, ids, vectors, best)
    for q, (scores, found) in enumerate(best.found):
        exact = (vectors @ known.vectors[q]).astype(int)
        exact[known.ids[q]] = -(10**9)
        order = np.lexsort((ids, -exact))[:5]
        assert found.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    assert sum(seen) < 0.5 * 4000 * len(known.ids)


def test_many_blocks_and_one_broadcast_at_a_time(spark, monkeypatch):
    draw = random.Random(5)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(3)], 0) for i in range(0, 400, 10)] + [(0, [1.0], 0), (7, [2.0], 0)]
    alive, most = set(), []
    broadcast = spark.sparkContext.broadcast

    def counted(value):
        shared = broadcast(value)
        alive.add(id(shared))
        most.append(len(alive))
        destroy = shared.destroy
        shared.destroy = lambda: (alive.discard(id(shared)), destroy())
        return shared

    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    assert rows(topk.top_k(spark.createDataFrame(vectors, SCHEMA))) == plain(vectors)
    assert len(most) >= 4 and max(most) == 1 and not alive


def test_components_beyond_every_product(spark):
    vectors = [(0, [1e306, 1.0], 0), (1, [1e306, 0.0], 0), (2, [-1e306, 0.0], 0), (3, [0.0, 2.0], 0)]
    got = rows(topk.top_k(spark.createDataFrame(vectors, SCHEMA)))
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 2 * 256 * 256), (0, 3, 2, -(2**63))]
