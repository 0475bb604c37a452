import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.llm import toxicity
from rillmark.llm.base import table
from rillmark.llm.logistic import Logistic
from rillmark.llm.wordcache import WordValues
from tests.conftest import SF_CHECK
from tests.llm.helpers import awkward, rows


def plain_chance(word, own, other):
    """Chance of a word's letters under one class, order by order, with dictionaries."""
    n = toxicity.ORDER

    def counts(classes, k):
        out = Counter()
        if k == n:
            for words in classes:
                for w, times in words.items():
                    s = b"\x01" + w + b"\x02"
                    for i in range(1, len(s)):
                        if i >= k - 1:
                            out[s[i - k + 1 : i + 1]] += times
            return out
        for words in classes:
            before = {}
            for w, times in words.items():
                s = b"\x01" + w + b"\x02"
                for i in range(1, len(s)):
                    if i == k - 1:
                        out[s[: i + 1]] += times
                    elif i >= k:
                        before.setdefault(s[i - k + 1 : i + 1], set()).add(s[i - k])
            for gram, letters in before.items():
                out[gram] += len(letters)
        return out

    total = 0.0
    s = b"\x01" + word + b"\x02"
    tables = [counts((own, other) if k <= toxicity.SHARED else (own,), k) for k in range(1, n + 1)]
    for i in range(1, len(s)):
        p = 1 / 256
        for k in range(1, n + 1):
            if i < k - 1:
                continue
            gram, seen = s[i - k + 1 : i + 1], tables[k - 1]
            followers = {g: c for g, c in seen.items() if g[:-1] == gram[:-1] and len(g) == k}
            if followers:
                mass = sum(followers.values())
                freed = sum(min(c, toxicity.DISCOUNT) for c in followers.values())
                c = followers.get(gram, 0)
                p = (c - min(c, toxicity.DISCOUNT)) / mass + freed / mass * p
        total += math.log(p)
    return total


def test_model_against_dictionaries():
    draw = random.Random(4)
    make = lambda: bytes(draw.choice(b"abcd") for _ in range(draw.randrange(1, 8)))
    ordinary, toxic = (Counter(make() for _ in range(150)) for _ in range(2))
    model = toxicity.kneser_ney(ordinary, toxic)
    words = [*list(toxic)[:20], *list(ordinary)[:20], b"abcdabcdabcd", b"zzz", "ñandú".encode()]
    plain = [plain_chance(w, toxic, ordinary) - plain_chance(w, ordinary, toxic) for w in words]
    assert model.word_ratios(words).tolist() == pytest.approx(plain, abs=1e-9)


def test_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = toxicity.report(docs, labels).where("held_out").join(labels, "doc_id").select("toxic", "score", "predicted")
    found = found.toPandas()
    order = found["score"].rank()
    n1, n0 = found["toxic"].sum(), (1 - found["toxic"]).sum()
    assert (order[found["toxic"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.95
    assert found[found["toxic"] == 0]["predicted"].mean() < 0.02


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 8)] + [(1, 0, 0), (None, 1, 1), (99, 1, None)], "doc_id bigint, quality int, toxic int")
    docs = awkward(spark, "score", "predicted", "held_out", "toxic", "label", "body")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert rows(toxicity.report(docs, labels)) == sorted(map(tuple, got), key=repr)
    assert toxicity.report(docs.limit(0), labels).collect() == []
    assert {r.score for r in toxicity.report(docs, labels.limit(0)).collect()} == {0.5}
    kept = toxicity.without_toxic(docs, labels.where("toxic = 0"))
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0


def test_whole_text_is_read():
    """The one toxic word of a long text counts wherever it stands."""
    ordinary, toxic = Counter({b"plain": 50, b"word": 50, b"text": 40}), Counter({b"plain": 20, b"word": 20, b"vile": 30})
    model = toxicity.kneser_ney(ordinary, toxic)
    far = model.features([b"plain word " * 300_000 + b"vile", b"plain word " * 300_000], WordValues(model.word_ratios))
    assert far[0][0] > far[1][0] + 0.1


def test_curve_without_one_class():
    flat = Logistic.fit(np.zeros((3, 2)), np.zeros(3, np.int64), (3, 0))
    assert flat.chance(np.ones((2, 2))).tolist() == pytest.approx([0.125, 0.125])


def test_sample_is_bounded(spark):
    from rillmark.llm.base import labelled_sample

    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    sample, totals = labelled_sample(docs, labels, "doc_id", "text", "toxic", 10, 9_000)
    assert all(len(v) <= 10 and sum(len(t) for _, t in v) <= 9_000 for v in sample.values()) and sample[0]
    known = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
    assert totals == (known.where("toxic = 0").count(), known.where("toxic = 1").count())
