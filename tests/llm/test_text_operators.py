"""Text operators on small inputs whose results are known."""

from hashlib import md5
from math import log10
from zlib import crc32

import pytest

from rillmark.llm import decontaminate, language, linededup, lm, quality, topk, toxicity
from rillmark.llm.base import labelled_sample


def _ids(held_out: bool, folds: int, of: int = 0):
    return (i for i in range(10_000) if (crc32(str(i).encode()) % folds == of) == held_out)


def test_long_unseen_words_cost_their_spelling(spark):
    train, held = _ids(False, 10), _ids(True, 10)
    rows = [(next(train), f"plain words of a small corpus number {i}") for i in range(40)]
    long = "q7" * 1000
    empty, once, twice = next(held), next(held), next(held)
    rows += [(empty, ""), (once, long), (twice, f"{long} {long}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model, _ = lm.fit(docs.where(f"doc_id not in ({empty}, {once}, {twice})"))
    share = model.mixer.log10([long.encode()])[0] + log10(lm.DISCOUNT * model.kinds / model.tokens)
    assert share < -400
    found = {r.doc_id: r for r in lm.report(docs).collect()}
    end = found[empty].score
    # the end's share and the word's; the second word falls on a total of KEPT + 1 and so on
    assert found[once].score == pytest.approx(end + share + log10(lm.KEPT / (lm.KEPT + 1)), rel=1e-9)
    again = log10(1 / (lm.KEPT + 1)) + log10(lm.KEPT / (lm.KEPT + 2))
    assert found[twice].score == pytest.approx(end + share + again, rel=1e-9)
    assert found[once].bits_per_byte > 0.5


@pytest.mark.parametrize("long", [300, 5_000])
def test_a_long_labelled_text_costs_no_other_its_place(spark, long):
    free = _ids(False, 4, 2)
    by_label = {value: sorted((next(free) for _ in range(30)), key=lambda i: md5(str(i).encode()).hexdigest()) for value in (0, 1)}
    # the first toxic text by MD5 is above the bound, or nearly fills it; all others have the same length
    texts = {i: f"{i:020d}" for ids in by_label.values() for i in ids}
    texts[by_label[1][0]] = "x" * long
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, v) for v, ids in by_label.items() for i in ids], "doc_id bigint, toxic int")
    held, totals = labelled_sample(docs, labels, "doc_id", "text", "toxic", 12, 320)
    assert [i for i, _ in held[0]] == [str(i) for i in by_label[0][:12]]
    assert [i for i, _ in held[1]] == [str(i) for i in by_label[1][1:13]]
    assert all(body.decode() == texts[int(i)] for v in (0, 1) for i, body in held[v]) and totals == (30, 30)


def test_ids_may_be_texts(spark, monkeypatch):
    docs = [(f"doc-{i}", f"some {'vile' if i % 3 == 0 else 'kind'} words number {i}") for i in range(120)] + [(None, "vile"), ("doc-1", None)]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    labels = spark.createDataFrame([(f"doc-{i}", i % 2, int(i % 3 == 0)) for i in range(100)], "doc_id string, quality long, toxic long")
    numbers = frame.where("doc_id LIKE 'doc-%'").selectExpr("CAST(substring(doc_id, 5) AS bigint) AS doc_id", "text")
    monkeypatch.setattr(quality, "EPOCHS", 1)
    for operator in (quality, toxicity):
        got = operator.report(frame, labels)
        assert got.schema["doc_id"].dataType.simpleString() == "string" and got.count() == len(docs)
        held_out = {r.doc_id for r in got.where("held_out").collect()}
        assert held_out == {d for d, _ in docs if crc32((d or "").encode()) % 4 == 2}
    assert toxicity.without_toxic(frame, labels).count() < len(docs)
    # a table of texts may be labelled by numbers
    sample, _ = labelled_sample(numbers, labels.selectExpr("substring(doc_id, 5) AS doc_id", "toxic"), "doc_id", "text", "toxic", 5, 10**6)
    assert len(sample[0]) == len(sample[1]) == 5

def test_repeated_rows_are_made_distinct_before_they_are_gathered(spark, monkeypatch):
    seen = []
    prepare, phrases = topk.prepare, decontaminate.phrases
    monkeypatch.setattr(topk, "prepare", lambda rows: seen.append(len(rows)) or prepare(rows))
    monkeypatch.setattr(decontaminate, "phrases", lambda rows, window: seen.append(len(rows)) or phrases(rows, window))
    vectors = spark.createDataFrame([(0, [2.0, 1.0]), (0, [1.0, 2.0])] * 50 + [(1, [1.0, 0.0]), (0, [1.0]), (2, [3.0])], "vec_id bigint, embedding array<double>")
    found = [tuple(r) for r in topk.top_k(vectors, k=2).collect()]
    # an id is asked once with each number of components
    assert found == [(0, 1, 2, 3 * 256 * 256), (0, 2, 1, 256 * 256)]
    docs = spark.createDataFrame([(1, "one two three")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "two three")] * 100, "item_id bigint, text string")
    hit = decontaminate.report(docs, items).first()
    assert (hit.n_hit, hit.n_items) == (2, 1)
    assert seen == [2, 1]


def test_repeated_rows_gather_their_windows_once(spark):
    text = "a\nb\nc\nd"
    docs = spark.createDataFrame([(1, text)] + [(2, text + "\ne")] * 20, "doc_id bigint, text string")
    done = linededup.dedup(docs)
    assert sorted(tuple(r) for r in done.collect()) == [(1, text)] + [(2, "e")] * 20
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" in plan and "collect_list" not in plan


def test_languages_do_not_depend_on_what_tasks_hold(spark, monkeypatch):
    train, held = _ids(False, 5), _ids(True, 5)
    words = {"aa": "bak dor fen gul hap", "bb": "kab rod nef lug pah"}
    rows = [(next(train), f"{w} {w}{i}x {w}{w}", tongue) for tongue, mine in words.items() for w in mine.split() for i in range(3)]
    # a known word, unseen ones with known beginnings, one without any known n-gram but its end, and no word at all
    rows += [(next(held), t, None) for t in ("fen", "lug lugnef", "gulbak dorr", "zzz \u00e9", "12 34", "", None)]
    rows += [(rows[-6][0], rows[-6][1], None)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")

    def found():
        return sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in language.report(docs).collect()))

    whole = found()
    assert len(whole) == len(rows)
    by_text = {t: next(r for r in whole if r[0] == i) for i, t, _ in rows[-9:]}
    assert [by_text[t][2] for t in ("fen", "lug lugnef", "gulbak dorr", "12 34", "", None)] == ["aa", "bb", "aa", "und", "und", "und"]
    for most in (0, 12):
        monkeypatch.setattr(language, "WORD_SCORES", most)
        monkeypatch.setattr(language, "GRAM_SCORES", 4 * most)
        assert found() == whole
