import random
import re

import numpy as np
from pyspark.sql import functions as F

from rillmark.llm import decontaminate
from rillmark.llm.base import table
from rillmark.llm.fmindex import FMIndex, suffix_array
from tests.conftest import SF_TINY
from tests.llm.helpers import awkward, rows

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain_report(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).update([] if item is None else [str(item)])
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                ids = windows.get(tuple(w[i : i + size]))
                if ids is not None:
                    hit.update(range(i, i + size))
                    found |= ids
        out.append((doc_id, len(w), len(hit), len(found), decontaminate.digest(list(found)), bool(hit)))
    return sorted(out, key=repr)


def test_tables(spark):
    docs, items = table(spark, SF_TINY, "documents"), table(spark, SF_TINY, "benchmark")
    plain = plain_report(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert rows(decontaminate.report(docs, items)) == plain
    assert any(r[-1] for r in plain)


ITEMS = [
    (1, "Plain words stand here"),
    (2, "ß 😀 ñ"),
    (2, "ß 😀 ñ"),
    (3, None),
    (4, "..."),
    (None, "zweite"),
    (5, "word " * 12),
    (6, "words stand here one after another in a row but longer"),
]


def test_awkward_rows_and_short_items(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = awkward(spark, "item_id", "n_hit", "n_words")
    plain = plain_report([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    assert rows(decontaminate.report(docs, items)) == plain
    assert decontaminate.report(docs.limit(0), items).collect() == []
    assert not any(r.contaminated for r in decontaminate.report(docs, items.limit(0)).collect())


def test_blocks_of_items_add_up(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    whole = rows(decontaminate.report(awkward(spark), items))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    assert rows(decontaminate.report(awkward(spark), items)) == whole


def test_small_shards_give_the_same(spark, monkeypatch):
    docs, items = table(spark, SF_TINY, "documents").coalesce(1), table(spark, SF_TINY, "benchmark")
    found = decontaminate.find(docs, items, ["doc_id"])
    whole = rows(found)
    known = decontaminate.phrases([(str(r.item_id), r.text.encode()) for r in items.collect()], 10)
    texts = [(r.doc_id, r.text.encode()) for r in docs.select("doc_id", "text").collect()]
    one_by_one = [(d, *decontaminate._search_shard([t], known)[0]) for d, t in texts]
    assert sorted([(r[0], r[1], [(s.start, s.end) for s in r[2]], r[3]) for r in whole], key=repr) == sorted(
        one_by_one, key=repr
    )


def test_cleaned_texts_hold_no_window(spark):
    docs, items = table(spark, SF_TINY, "documents"), table(spark, SF_TINY, "benchmark")
    cleaned = decontaminate.find(docs, items, docs.columns, clean=True)
    again = decontaminate.report(cleaned.select(docs.columns), items)
    assert again.where("contaminated").count() == 0
    untouched = cleaned.where(F.size("hit_spans") == 0).select("doc_id", "text")
    assert untouched.exceptAll(docs.select("doc_id", "text")).count() == 0
    assert decontaminate.cut("A, bb cc. Dd!", [(1, 3)]) == "A, \n. Dd!"


def test_index_against_plain_search():
    draw = random.Random(3)
    for alphabet in (2, 3, 30):
        symbols = np.array([draw.randrange(alphabet) for _ in range(700)] + [0], np.int32)
        if alphabet == 3:
            symbols = np.tile(symbols[:90], 8)
            symbols[-1] = 0
        order = suffix_array(symbols)
        assert sorted(order.tolist()) == list(range(len(symbols)))
        index = FMIndex(symbols, alphabet)
        for size in (1, 2, 5):
            phrases = np.array([[draw.randrange(1, alphabet) for _ in range(size)] for _ in range(40)], np.int64)
            low, high = index.search(phrases)
            for row, a, b in zip(phrases, low, high, strict=True):
                plain = [i for i in range(len(symbols) - size + 1) if (symbols[i : i + size] == row).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == plain


def test_columns_with_the_names_of_results_stay(spark):
    docs = spark.createDataFrame([(1, "some one two three", 7, "a", "b")], "doc_id bigint, text string, n_words int, Hit_Spans string, hit_items string")
    items = spark.createDataFrame([(5, "two three")], "item_id bigint, text string")
    found = decontaminate.find(docs, items, docs.columns, clean=True)
    assert found.columns == [*docs.columns, "_n_words", "_hit_spans", "_hit_items"]
    assert [(r.n_words, r["Hit_Spans"], r.hit_items, r._n_words, r._hit_items) for r in found.collect()] == [(7, "a", "b", 4, ["5"])]
    assert "three" not in found.first().text
