import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.llm import centroids
from tests.llm.helpers import rows

SCHEMA = "vec_id bigint, embedding array<double>"


def plain(vectors, width=64, k=16, rounds=3):
    kept = [(i, [min(max(int(np.floor(min(max(x, -1e15), 1e15) * 64)), -(1 << 27)), 1 << 27) for x in v]) for i, v in vectors if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centres = [v for _, v in start]
    if not centres:
        return []

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = nearest()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, m) in zip(kept, found, strict=True) if m == n]
            if mine:
                centres[n] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = nearest()
    most = 2**63 - 1
    own = [min(sum(d for d, m in found if m == n), most) for n in range(len(centres))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    total = min(sum(d for d, _ in found), most)
    return sorted(((i, n, d, own[n], total, shas[n]) for (i, _), (d, n) in zip(kept, found, strict=True)), key=repr)


def drawn(n, width, seed=1):
    draw = np.random.default_rng(seed)
    return [(int(i), (draw.normal(0, 1, width) + 3 * (i % 5)).tolist()) for i in range(n)]


@pytest.mark.parametrize("width, shards", [(64, 4), (8, 3), (5, 1), (3, 3)])
def test_any_number_of_shards_gives_the_same(spark, width, shards):
    vectors = drawn(200, width)
    frame = spark.createDataFrame(vectors, SCHEMA).repartition(3)
    found = centroids.cluster(frame, width=width, shards=shards)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows(found) == plain(vectors, width)


def test_odd_vectors(spark):
    vectors = drawn(30, 4)
    vectors += [(None, [1.0, 2.0, 3.0, 4.0]), (1, None), (2, []), (3, [1.0, 2.0, 3.0]), (4, [1.0, None, 3.0, 4.0])]
    vectors += [(5, [float("nan")] * 4), (6, [float("inf"), 0.0, 0.0, 0.0]), (7, [1e300, -1e300, 0.0, 0.0])]
    vectors += [(8, [0.0] * 4)] * 40 + [(8, [9.0] * 4)] + [(100 + i, [0.0] * 4) for i in range(40)]
    frame = spark.createDataFrame(vectors, SCHEMA).withColumns({"cluster": F.lit("clash"), "id": F.lit(0), "chunk": F.lit(1)})
    assert rows(centroids.cluster(frame, width=4)) == plain(vectors, 4)
    assert centroids.cluster(frame.limit(0), width=4).collect() == []
    assert centroids.cluster(frame.where("vec_id IS NULL"), width=4).collect() == []


def test_fewer_vectors_than_clusters_and_ties(spark):
    vectors = [(i, [float(i % 2)] * 2) for i in range(6)]
    assert rows(centroids.cluster(spark.createDataFrame(vectors, SCHEMA), width=2)) == plain(vectors, 2)


def test_many_chunks(spark):
    vectors = drawn(centroids.CHUNK * 2 + 17, 2)
    frame = spark.createDataFrame(vectors, SCHEMA).coalesce(1)
    blocks = centroids._blocks(centroids._sound(frame, "vec_id", "embedding", 2), 2, 64, 2)
    assert blocks.select("chunk").distinct().count() >= 3 and blocks.count() >= 6
    assert rows(centroids.cluster(frame, width=2, shards=2)) == plain(vectors, 2)


def test_each_shard_is_stored_apart(spark):
    frame = spark.createDataFrame(drawn(50, 8), SCHEMA)
    blocks = centroids._blocks(centroids._sound(frame, "vec_id", "embedding", 8), 8, 64, 4)
    plan = blocks.where("shard = 2").select("cells")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan
