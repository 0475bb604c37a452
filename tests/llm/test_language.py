import math
from collections import Counter
from functools import cache
from zlib import crc32

import pytest
import xxhash
from pyspark.sql import functions as F

from rillmark.llm import language
from rillmark.llm.base import table
from tests.conftest import SF_CHECK, SF_TINY
from tests.llm.helpers import awkward, rows


def test_held_out_rows(spark):
    docs = table(spark, SF_CHECK, "documents")
    found = language.report(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 100 and right / total > 0.98


def test_counts_cover_all_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "FLUSH", 50)
    docs = table(spark, SF_CHECK, "documents").limit(60).cache()
    plain = Counter()
    for r in docs.collect():
        plain.update((r.lang, w.decode()) for w in language.spoken_words(r.text.encode()))
    counted = language.word_counts(docs, "text", "lang").cache()
    assert {(r.lang, r.form): r.n for r in counted.collect()} == plain
    grams = Counter()
    for lang, word in plain:
        word = f"^{word}$"
        grams.update((lang, g) for at in range(len(word)) for g in language.grams_at(word, at))
    assert {(r.lang, r.form): r.n for r in language.gram_counts(counted).collect()} == grams


def test_tables_keep_to_their_size(spark):
    counts = spark.createDataFrame([("a", f"w{i}", i // 3 + 1) for i in range(300)] + [("b", "x", 1)], "lang string, form string, n bigint")
    kept = language.most_frequent(counts, ["lang"], 100)
    assert rows(kept) == sorted([("a", f"w{i}", i // 3 + 1) for i in range(201, 300)] + [("b", "x", 1)], key=repr)
    assert language.most_frequent(counts.where("lang = 'a'"), ["lang"], 2).count() == 0


def plain(docs):
    """Languages and scores by dictionaries of all words and n-grams; ``docs`` are (id, text, lang)."""
    words, grams, kinds = {}, {}, {}
    for doc, text, lang in docs:
        if lang is not None and crc32(str("" if doc is None else doc).encode()) % 5:
            words.setdefault(lang, Counter()).update(w.decode() for w in language.spoken_words((text or "").encode()))
    words = {lang: counted for lang, counted in words.items() if counted}
    names, forms = sorted(words), {w for counted in words.values() for w in counted}
    for lang, counted in words.items():
        for w in counted:
            for n in range(1, 5):
                grams.setdefault((lang, n), Counter()).update(f"^{w}$"[i : i + n] for i in range(len(w) + 3 - n))
    for n in range(1, 5):
        kinds[n] = len({g for lang in names for g in grams[lang, n]})

    def share(n, total, kinds):
        return math.log((n + 0.5) / (total + 0.5 * (kinds + 1)))

    def of_gram(gram):
        n = len(gram)
        return [share(grams[lang, n][gram], sum(grams[lang, n].values()), kinds[n]) for lang in names]

    @cache
    def of_word(word):
        if word in forms:
            return [share(words[lang][word], sum(words[lang].values()), len(forms)) for lang in names]
        found = []
        for at in range(len(word) + 2):
            known = [g for g in language.grams_at(f"^{word}$", at) if any(grams[lang, len(g)][g] for lang in names)]
            if known:
                found.append(of_gram(known[0]))
        return [sum(column) / len(found) for column in zip(*found, strict=True)] if found else [0.0] * len(names)

    out = []
    for doc, text, _ in docs:
        held_out = crc32(str("" if doc is None else doc).encode()) % 5 == 0
        if not names or not any(map(str.isalpha, text or "")):
            out.append((doc, held_out, "und", 0.0))
            continue
        mine = [of_word(w.decode()) for w in language.spoken_words(text.encode())]
        total = [sum(column) for column in zip(*mine, strict=True)] if mine else [0.0] * len(names)
        most = max(total)
        parts = [math.exp((x - most) / max(1, len(mine)) ** 0.5) for x in total]
        out.append((doc, held_out, names[total.index(most)], round(1 / sum(parts), 7)))
    return sorted(out, key=repr)


def found_in(docs):
    return sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 7)) for r in language.report(docs).collect()), key=repr)


@pytest.mark.parametrize("held", [0, 400, 10**6])
def test_plain_twin(spark, monkeypatch, held):
    """Whatever part of the words and n-grams the tasks hold."""
    monkeypatch.setattr(language, "WORD_SCORES", held)
    monkeypatch.setattr(language, "GRAM_SCORES", held)
    docs = table(spark, SF_TINY, "documents").select("doc_id", "text", "lang").limit(120)
    cut = docs.withColumn("text", F.substring("text", 1, 300)).cache()
    assert found_in(cut) == plain([tuple(r) for r in cut.collect()])


def test_plain_twin_on_awkward_rows(spark):
    docs = awkward(spark, "item", "key", "doc", "seed", "t", "whole")
    more = spark.createDataFrame([(None, "zweite Zeile", None, None), (None, "other text", None, None), (6, "words", "en", None)] * 2, docs.select("doc_id", "text", "lang", "source").schema)
    docs = docs.unionByName(more, allowMissingColumns=True)
    assert found_in(docs) == plain([(r.doc_id, r.text, r.lang) for r in docs.collect()])


def test_the_key_of_a_word_is_the_hash_of_spark(spark):
    words = ["a", "straße", "x" * 100, ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    keys = [r[0] for r in df.select(F.xxhash64("w")).collect()]
    assert [k & (2**64 - 1) for k in keys] == [xxhash.xxh64_intdigest(w.encode(), language.SEED) for w in words]


def test_awkward_rows(spark):
    docs = awkward(spark, "lang_pred", "score", "n", "form")
    got = language.report(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in got if r.doc_id in (2, 3, 4)] == ["und"] * 3
    assert {r.lang_pred for r in got} <= {"und", "en", "de"}
    assert language.report(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language.report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
