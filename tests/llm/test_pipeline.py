"""Every stage on its own input, and the whole run."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from rillmark.llm import simhash, toxicity
from rillmark.llm.base import stored, table
from tests.conftest import SF_TINY
from tests.llm import test_linededup, test_mixing
from tests.llm.helpers import awkward, components, rows
from tests.llm.test_decontaminate import plain_report
from tests.llm.test_simhash import plain_fingerprint


def _kept_by_plain_dedup(docs):
    prints = [plain_fingerprint(t) for _, t in docs]
    v = np.array(prints, np.uint64)
    pairs = [(i, int(j)) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 2) if j > i]
    least = {}
    for (doc_id, _), root in zip(docs, components(len(v), pairs), strict=True):
        least[root] = min(doc_id, least.get(root, doc_id))
    return sorted(least.values())


def test_stages_in_turn(spark):
    docs = table(spark, SF_TINY, "documents")
    named = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES][2:] == ["simhash_near_dedup", "benchmark_decontamination", "mixing"]
    scores = {r.doc_id: r.predicted for r in toxicity.report(docs, table(spark, SF_TINY, "labels")).collect()}
    calm = stored(named["toxicity"](spark, docs, SF_TINY), "test")
    assert rows(calm) == [r for r in rows(docs) if not scores[r[0]]]
    plain = [(r.doc_id, r.text) for r in calm.collect()]
    lines = stored(named["line_dedup"](spark, calm, SF_TINY), "test")
    assert lines.columns == docs.columns
    assert rows(lines.select("doc_id", "text")) == test_linededup.plain(plain)
    single = stored(named["simhash_near_dedup"](spark, lines, SF_TINY), "test")
    assert single.columns == docs.columns and single.exceptAll(lines).isEmpty()
    assert sorted(r.doc_id for r in single.collect()) == _kept_by_plain_dedup([(r.doc_id, r.text) for r in lines.collect()])
    clean = stored(named["benchmark_decontamination"](spark, single, SF_TINY), "test")
    assert clean.columns == docs.columns and clean.count() == single.count()
    items = [(r.item_id, r.text) for r in table(spark, SF_TINY, "benchmark").collect()]
    before = {r[0]: r[-1] for r in plain_report([(r.doc_id, r.text) for r in single.collect()], items)}
    after = plain_report([(r.doc_id, r.text) for r in clean.collect()], items)
    assert not any(r[-1] for r in after)
    texts = {r.doc_id: r.text for r in single.collect()}
    assert all(before[r.doc_id] or r.text == texts[r.doc_id] for r in clean.collect())
    test_mixing._check(clean, named["mixing"](spark, clean, SF_TINY).collect())


def test_run_agrees_with_itself(spark):
    first, second = (rows(corpus_pipeline.run(spark, SF_TINY)) for _ in range(2))
    assert first == second and first


def test_awkward_documents_pass_all_stages(spark):
    docs = awkward(spark, "copy", "text_print", "score", "fp", "n_words", "hit_spans", "Hit_Items", "shard_text", "covered_lines", "key", "mix")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_TINY), "test")
    ids = Counter(r.doc_id for r in docs.collect())
    # blank and null texts are one group, repeated rows one document
    assert max(ids.values()) == 1 and ids[2] == 1 and not ids[3] and not ids[4]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_TINY).count() == docs.count()
    empty = table(spark, SF_TINY, "documents").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF_TINY), "test")
    assert empty.collect() == []


def test_one_of_each_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "e f g h i"), (5, "e f g h i")], "doc_id bigint, text string")
    assert rows(simhash.one_of_each(docs)) == [(5, "e f g h i"), (None, "a b c d")]
