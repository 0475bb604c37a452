import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rillmark.llm import contentsort
from tests.llm.helpers import awkward, rows

SCHEMA = "doc_id bigint, text string"


def plain(docs):
    groups = {}
    for d, t in docs:
        norm = re.sub("[\x20\x09-\x0d]+", "", t or "")
        groups.setdefault(norm, []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), i == 0, sha) for i, m in enumerate(members)]
    return sorted(out, key=repr)


@pytest.fixture(params=[1, 4, 60])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_groups_that_span_partitions(spark, partitions):
    draw = random.Random(4)
    docs = [(i, draw.choice(["", " ", "a b", "ab", "a  b ", "\ta\nb", "é x", "éx", None, "other"])) for i in range(300)]
    docs += [(1000 + i, "hot copy of a text") for i in range(200)] + [(i, f"single {i}") for i in range(50)]
    docs += [(None, "hot copy of a text"), (None, "ab"), (7, "same row"), (7, "same row"), (7, "same  row")]
    found = contentsort.report(spark.createDataFrame(docs, SCHEMA).repartition(5))
    assert rows(found) == plain(docs)


def test_a_hot_group_is_dealt_to_many_partitions(spark, partitions):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("one text for all").alias("text"))
    runs = contentsort._runs(docs, "doc_id", "text", [], False)
    sizes = {r["count"] for r in runs.groupBy(F.spark_partition_id()).count().collect()}
    assert max(sizes) <= 2 * 2000 / min(partitions, 60) + 20
    done = contentsort.report(docs)
    assert done.select("keep_id", "group_size").distinct().collect() == [(0, 2000)]
    assert [r.doc_id for r in done.where("kept").collect()] == [0]


def test_rows_that_are_all_alike_are_dealt_too(spark, partitions):
    docs = spark.createDataFrame([(None, "alike")] * 500, SCHEMA)
    assert rows(contentsort.report(docs)) == plain([(None, "alike")] * 500)
    assert rows(contentsort.dedup(docs)) == [(None, "alike")]


def test_awkward_rows_and_columns(spark):
    docs = awkward(spark, "norm", "keep", "size", "row", "digest", "part", "piece", "edge", "kept", "nth")
    assert rows(contentsort.report(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])
    kept = contentsort.dedup(docs)
    assert kept.columns == docs.columns
    # null, empty and blank texts are equal, the blank one is the longest
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 4, 5, 7, None]
    assert {r.doc_id: (r.lang, r.norm) for r in kept.collect()}[4] == ("de", "clash")
    assert contentsort.report(docs.limit(0)).collect() == [] and contentsort.dedup(docs.limit(0)).collect() == []


def test_texts_that_share_long_beginnings_differ(spark, partitions):
    docs = [(i, "same beginning " * 500 + str(i % 40)) for i in range(200)]
    assert rows(contentsort.report(spark.createDataFrame(docs, SCHEMA))) == plain(docs)
