"""Toxicity by two class-conditional Kneser-Ney models over the letters of words.

Each class predicts a letter from the letters before it in the word, interpolating down the orders with
absolute discounting: counts at the highest order, continuation counts below.  The lowest orders
are shared by both classes, so an expression that is rare in both counts for neither, and spellings
that share a stem share its counts.  A text is compared by log-likelihoods per letter: of its best
stretches of several lengths and of the whole, and per word of its strongest words.  A logistic curve, fitted on labelled rows left out
of the counts, turns these ratios into a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.base import fold, free_name, labelled_sample, word_bytes
from rillmark.llm.logistic import Logistic
from rillmark.llm.wordcache import WordValues, laid_out

# labelled rows per class that the model is fitted on, and bytes of them at most
SAMPLE = 1500
SAMPLE_BYTES = 12 << 20
ORDER = 5
# orders up to this one are shared by the classes
SHARED = 2
DISCOUNT = 0.75
# words in a stretch
STRETCHES = (1, 2, 5, 20)
# numbers of strongest words, wherever they stand
STRONGEST = (1, 2, 4, 8)
THRESHOLD = 0.3
# the curve is fitted on ratios by models that did not count the text: the sample is left out in so many parts
PARTS = 3
# words scored at a time
PIECE = 100_000
FIRST, LAST = 1, 2
N_FEATURES = len(STRETCHES) + len(STRONGEST) + 2


def _grams(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word number of every letter place, and per order the n-gram that ends there (-1: reaches before the word)."""
    letters, begins = laid_out(words, FIRST, LAST)
    word = np.repeat(np.arange(len(words)), np.diff(np.concatenate([begins, [len(letters)]])))
    offset = np.arange(len(letters)) - begins[word] if len(letters) else np.zeros(0, np.int64)
    grams, now = [], np.zeros(len(letters), np.int64)
    for k in range(ORDER):
        back = np.concatenate([np.zeros(min(k, len(letters)), np.int64), letters[: max(0, len(letters) - k)]])
        now = now | (back << (8 * k))
        grams.append(np.where(offset >= k, now, -1))
    # the place of the first marker is never predicted, but is a context
    return np.where(offset > 0, word, -1), grams


@dataclass
class Table:
    """The n-grams of one order seen in either class: what each adds as a prediction and keeps as a context."""

    keys: np.ndarray
    given: np.ndarray
    reserve: np.ndarray

    def find(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        return np.where(self.keys[at] == grams, at, -1)


@dataclass
class Model:
    tables: list[Table]
    curve: Logistic | None = None

    def word_ratios(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood ratio of each word, toxic against ordinary."""
        word, grams = _grams(words)
        place = np.flatnonzero(word >= 0)
        chance = np.full((2, len(place)), 1 / 256)
        context = np.zeros(len(word), np.int64)
        for k, table in enumerate(self.tables):
            found = table.find(grams[k])
            at, before = found[place], context[place - 1] if k else np.zeros(len(place), np.int64)
            usable = grams[k][place] >= 0
            for c in (0, 1):
                add = np.where(at >= 0, table.given[c][at], 0.0) if len(table.keys) else 0.0
                keep = self._kept(k, c, before)
                chance[c] = np.where(usable, add + keep * chance[c], chance[c])
            context = found
        return np.bincount(word[place], np.log(chance[1]) - np.log(chance[0]), minlength=len(words))

    def _kept(self, k: int, c: int, before: np.ndarray) -> np.ndarray:
        """What the context, an n-gram of the order below, leaves to that order; everything if it is unknown."""
        reserve = self.tables[k].reserve[c]
        if not len(reserve):
            return np.ones(len(before))
        return np.where(before >= 0, reserve[np.minimum(before, len(reserve) - 1)], 1.0)

    def features(self, texts: list[bytes], ratios: WordValues) -> np.ndarray:
        """Per text: the best ratio per letter of a stretch of each length, the mean ratio of the strongest words, and the whole's ratio."""
        out = np.zeros((len(texts), N_FEATURES))
        held: list[list[bytes]] = []
        volume = 0
        for i, text in enumerate(texts):
            held.append(word_bytes(text))
            volume += len(held[-1])
            if volume >= PIECE or i == len(texts) - 1:
                tokens = [w for words in held for w in words]
                if tokens:
                    ratio = np.concatenate([[0.0], np.cumsum(ratios.of(tokens))])
                    letters = np.concatenate([[0], np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)])
                    b = 0
                    for j, words in enumerate(held, i + 1 - len(held)):
                        a, b = b, b + len(words)
                        out[j] = self._of(ratio[a : b + 1], letters[a : b + 1])
                held, volume = [], 0
        return out

    @staticmethod
    def _of(ratio: np.ndarray, letters: np.ndarray) -> np.ndarray:
        n = len(ratio) - 1
        if n == 0:
            return np.zeros(N_FEATURES)
        best = []
        for length in STRETCHES:
            span = min(length, n)
            best.append(float(((ratio[span:] - ratio[:-span]) / (letters[span:] - letters[:-span])).max()))
        words = -np.sort(np.partition(-np.diff(ratio), min(STRONGEST[-1], n) - 1)[: STRONGEST[-1]])
        best += [float(words[:most].sum()) / most for most in STRONGEST]
        whole, size = float(ratio[-1] - ratio[0]), float(letters[-1] - letters[0])
        found = np.array([*best, whole / size, whole / size**0.5])
        # differences among ratios that leave no doubt matter little
        return np.sign(found) * np.log1p(np.abs(found))

    def score(self, texts: list[bytes], ratios: WordValues) -> np.ndarray:
        return self.curve.chance(self.features(texts, ratios))


def _uses(grams: list[np.ndarray], times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the n-grams of order k + 1: how often at the highest order or at a word's beginning, else after how many letters."""
    here = grams[k]
    top = k == ORDER - 1
    begins = (here >= 0) & ((here >> (8 * k)) == FIRST)
    plain = (here >= 0) & ((here & 255) != FIRST) & (begins | top)
    keys, which = np.unique(here[plain], return_inverse=True)
    counts = np.bincount(which, times[plain], minlength=len(keys))
    if top:
        return keys, counts
    longer = grams[k + 1]
    kinds, after = np.unique(np.unique(longer[longer >= 0]) & ((1 << (8 * (k + 1))) - 1), return_counts=True)
    # n-grams that only ever begin a word have no continuation count
    every = np.union1d(keys, kinds)
    total = np.zeros(len(every))
    total[np.searchsorted(every, kinds)] += after
    total[np.searchsorted(every, keys)] += counts
    return every, total


def kneser_ney(ordinary: Counter[bytes], toxic: Counter[bytes]) -> Model:
    """Fit both classes on their word counts."""
    classes = []
    for counted in (ordinary, toxic):
        word, grams = _grams(list(counted))
        times = np.fromiter(counted.values(), float, len(counted))
        letters = np.where(word >= 0, word, 0)
        classes.append((grams, times[letters] * (word >= 0) if len(counted) else np.zeros(len(word))))
    uses = [[_uses(grams, times, k) for k in range(ORDER)] for grams, times in classes]
    tables: list[Table] = []
    below = np.zeros(1, np.int64)
    for k in range(ORDER):
        keys = np.union1d(uses[0][k][0], uses[1][k][0])
        counts = np.zeros((2, len(keys)))
        for c in (0, 1):
            counts[c][np.searchsorted(keys, uses[c][k][0])] = uses[c][k][1]
        if k < SHARED:
            counts[:] = counts.sum(0)
        # contexts are places in the table below, so that a letter's context is found with the letter before it
        context = np.searchsorted(below, keys >> 8) if k else np.zeros(len(keys), np.int64)
        given, reserve = np.zeros((2, len(keys))), np.ones((2, len(below)))
        for c in (0, 1):
            total = np.bincount(context, counts[c], minlength=len(below))
            kinds = np.bincount(context, counts[c] > 0, minlength=len(below))
            freed = np.minimum(DISCOUNT, counts[c])
            given[c] = (counts[c] - freed) / np.maximum(total[context], 1e-9)
            mass = np.bincount(context, freed, minlength=len(below))
            reserve[c] = np.where(kinds > 0, mass / np.maximum(total, 1e-9), 1.0)
        tables.append(Table(keys, given, reserve))
        # a first marker is a context though it is never predicted
        below = keys
        if k == 0:
            below = np.union1d(keys, [FIRST])
            wide = np.zeros((2, len(below)))
            wide[:, np.searchsorted(below, keys)] = given
            tables[0] = Table(below, wide, reserve)
    return Model(tables)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from labelled rows of folds other than 2 of 4: at most ``SAMPLE`` rows a class.

    The curve is fitted on texts left out of the counts in turn, and its offset moved from the balance of the
    sample to that of all labelled rows of these folds; the final counts are those of the whole sample.
    """
    sample, totals = labelled_sample(docs, labels, doc_id, text, label, SAMPLE, SAMPLE_BYTES)
    texts = [[body for _, body in sample[value]] for value in (0, 1)]
    features, truth = [np.zeros((0, N_FEATURES))], []
    for part in range(PARTS):
        model = kneser_ney(*(_spellings([t for i, t in enumerate(mine) if i % PARTS != part]) for mine in texts))
        ratios = WordValues(model.word_ratios)
        for value, mine in enumerate(texts):
            features.append(model.features(mine[part::PARTS], ratios))
            truth += [value] * len(mine[part::PARTS])
    model = kneser_ney(*map(_spellings, texts))
    model.curve = Logistic.fit(np.concatenate(features), np.array(truth, np.int64), totals)
    return model


def _spellings(texts: list[bytes]) -> Counter[bytes]:
    """Words with the number of different texts that hold them: a text that repeats itself speaks once."""
    return Counter(w for body in set(texts) for w in set(word_bytes(body)))


def with_score(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """All columns and the score under ``name``; a null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        ratios = WordValues(known.word_ratios)
        for batch in batches:
            yield pd.Series(known.score([t.encode() for t in batch], ratios), dtype="float64")

    return docs.withColumn(name, score(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score``, ``predicted``.

    Null and empty texts get the score of a text without any evidence; a null id counts as the empty
    text for the folds and is no labelled row; an id labelled twice counts as toxic if one label says so;
    repeated rows give repeated results, and an empty table none.  Without labels of both kinds every
    score is the share of the one there is (a half without any).  Other columns are not read.
    """
    scored = with_score(docs.select(doc_id, text), fit(docs, labels, doc_id, text), "score", text)
    return scored.select(
        doc_id,
        (fold(doc_id, 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, unchanged, whose score is below the threshold."""
    name = free_name(docs, "toxic_score")
    return with_score(docs, fit(docs, labels, doc_id, text), name, text).where(F.col(name) < THRESHOLD).drop(name)
