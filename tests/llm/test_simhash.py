import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rillmark.llm import simhash
from rillmark.llm.base import table
from rillmark.llm.components import smallest_reachable
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward, components, rows


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_result(docs):
    """Fingerprint and component of each (doc_id, text), comparing all pairs."""
    prints = [plain_fingerprint(text) for _, text in docs]
    v = np.array(prints, np.uint64)
    pairs = [(i, int(j)) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 2) if j > i]
    root = components(len(v), pairs)
    least = {}
    for (doc_id, _), r in zip(docs, root, strict=True):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return sorted(
        [(d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(docs, prints, root, strict=True)], key=repr
    )


def test_all_documents_against_all_pairs(spark):
    docs = table(spark, SF_CHECK, "documents")
    plain = plain_result([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows(simhash.near_duplicates(docs)) == plain


def test_awkward_rows(spark):
    docs = awkward(spark, "fingerprint", "component_id", "fp")
    plain = plain_result([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(simhash.near_duplicates(docs)) == plain
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def _linked(spark, values):
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp bigint")
    roots = {r.node: r.root for r in smallest_reachable(simhash.links(frame), "a", "b").collect()}
    signed = [r.fp for r in frame.collect()]
    return [roots.get(v, v) for v in signed], signed


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_lose_nothing(spark, monkeypatch, bucket):
    """Clouds around centres, on both sides of the bucket bound."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    draw = random.Random(bucket)
    values = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        values.add(centre)
        for _ in range(25):
            spot = centre
            for bit in draw.sample(range(64), draw.choice([1, 2, 3, 4])):
                spot ^= 1 << bit
            values.add(spot)
    got, signed = _linked(spark, sorted(values))
    unsigned = np.array(signed, np.int64).view(np.uint64)
    order = np.argsort(signed)
    pairs = [
        (i, j)
        for i in range(len(order))
        for j in range(i + 1, len(order))
        if np.bitwise_count(unsigned[order[i]] ^ unsigned[order[j]]) <= 2
    ]
    root = components(len(order), pairs)
    assert [got[i] for i in order] == [signed[order[r]] for r in root]


def test_words_one_bit_apart_share_an_index():
    words = np.random.default_rng(1).integers(0, 1 << 23, 300)
    for bit in range(23):
        both = np.concatenate([words, words ^ (1 << bit)])
        keys = [set() for _ in both]
        for row, index in zip(*simhash.golay_indices(both), strict=True):
            keys[row].add(int(index))
        assert all(keys[i] & keys[i + len(words)] for i in range(len(words)))
        assert {len(k) for k in keys} <= {1, 6}


def test_long_chain_is_one_component(spark):
    chain = spark.range(0, 300).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    assert {r.root for r in smallest_reachable(chain, "x", "y").collect()} == {0}
