import re

import pytest
from pyspark.sql import functions as F

from rillmark.llm import mixing
from rillmark.llm.base import table
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward


def plain_targets(sizes):
    """Water-filling round by round: share by weight, stop at the caps, reshare what is left over."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: unit * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def _check(docs, mixed):
    sizes = {}
    for r in docs.select("source", "text").collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    target = plain_targets(sizes)
    by_target = {}
    for r in mixed:
        assert 0 <= r.taken <= 2 * r.size
        assert len(r.positions) == (r.taken > 0) + (r.taken > r.size)
        assert all(0 <= p <= 1 for p in r.positions)
        by_target[r.target] = by_target.get(r.target, 0) + r.taken
    assert sorted(by_target) == pytest.approx(sorted(set(target.values())))
    for value, taken in by_target.items():
        shared = [v for v in target.values() if v == pytest.approx(value)]
        assert taken == pytest.approx(sum(shared), abs=len(shared))


def test_targets_are_met(spark):
    docs = table(spark, SF_CHECK, "documents")
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == docs.count()
    _check(docs, rows)
    again = mixing.mix(docs.repartition(7))
    assert again.exceptAll(mixed).isEmpty() and mixed.exceptAll(again).isEmpty()


def test_awkward_rows(spark):
    docs = awkward(spark, "taken", "size", "target", "rank")
    _check(docs, mixing.mix(docs).collect())
    assert mixing.mix(docs.limit(0)).collect() == []
    assert [r.taken for r in mixing.mix(docs.where("text is null or trim(text) = ''")).collect()] == [0, 0]


def test_one_source_and_caps(spark):
    docs = spark.createDataFrame([(i, "a b c", "x" if i else "y") for i in range(100)], "doc_id bigint, text string, source string")
    _check(docs, mixing.mix(docs).collect())


def test_moments_invert_the_integral(spark):
    shares = spark.range(0, 101).select((F.col("id") / 100).alias("u"))
    for start, end in [(1.5, 0.5), (1.0, 1.0), (0.5, 1.5), (0.0, 2.0), (2.0, 0.0)]:
        for r in shares.select("u", mixing._moment(F.col("u"), F.lit(start), F.lit(end)).alias("t")).collect():
            demand = (start * r.t + (end - start) * r.t**2 / 2) / ((start + end) / 2)
            assert demand == pytest.approx(r.u, abs=1e-7)


def test_order_is_by_position(spark):
    rows = mixing.in_training_order(mixing.mix(table(spark, SF_CHECK, "documents"))).collect()
    first = [r.positions[0] if r.positions else 2.0 for r in rows]
    assert first == sorted(first)


def test_a_third_of_the_ids_may_be_null(spark):
    """Rows without an id, or under one id, are cut into windows by their texts."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 1, F.col("id")).when(F.col("id") % 3 == 2, F.lit(7)).alias("doc_id"),
        F.repeat(F.concat(F.lit("w "), F.lit("x")), (F.col("id") % 50).cast("int")).alias("text"), F.lit("s").alias("source"),
    )
    docs = docs.withColumn("text", F.concat("text", F.lit(" "), F.monotonically_increasing_id().cast("string")))
    seen = []
    cumulative = mixing._cumulative
    mixing._cumulative = lambda rows: seen.append(rows) or cumulative(rows)
    try:
        mixed = mixing.mix(docs)
        _check(docs, mixed.collect())
    finally:
        mixing._cumulative = cumulative
    assert seen[0].groupBy("rank", "part").count().agg(F.max("count")).first()[0] < 10
