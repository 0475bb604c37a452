"""Language identification, word first.

A known word scores by its log frequency in each language.  An unseen word falls back to n-grams: from
left to right the longest known n-gram at each place, shorter ones where longer ones are unknown.
Frequencies count all training texts.  Every task holds the most frequent words and n-grams; all
others are looked up by joins on the tables of counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.base import fold, stored

# scores that every task holds: a word or n-gram has one for each language, and languages have equal shares
WORD_SCORES = 1_000_000
GRAM_SCORES = 640_000
LONGEST = 4
# Spark's own hash of strings, by which words beyond the head are looked up
SEED = 42
# part of a language's mass that a form may have without having been seen in it
UNSEEN = 0.5
# distinct words a task counts before it hands them on
FLUSH = 200_000
# texts scored at once
TEXTS = 256

# lower-cased ASCII letters and all bytes beyond ASCII
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def spoken_words(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def grams_at(word: str, at: int) -> list[str]:
    """The n-grams that begin at a place of the word, which ``^`` opens and ``$`` ends; longest first."""
    return [word[at : at + n] for n in range(min(LONGEST, len(word) - at), 0, -1)]


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, form, n`` over all rows; tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[bytes]] = {}
        for batch in batches:
            for body, tongue in zip(batch.column(0).cast(pa.large_binary()), batch.column(1).to_pylist(), strict=True):
                held.setdefault(tongue, Counter()).update(spoken_words(body.as_py()))
                if sum(map(len, held.values())) > FLUSH:
                    yield from _handed_on(held)
                    held = {}
        yield from _handed_on(held)

    source = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l")
    )
    counted = source.mapInArrow(count, "lang string, form string, n bigint")
    return counted.groupBy("lang", "form").agg(F.sum("n").alias("n"))


def _handed_on(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for tongue, counted in held.items():
        forms = [w.decode() if isinstance(w, bytes) else w for w in counted]
        yield pa.RecordBatch.from_arrays(
            [pa.array([tongue] * len(forms), pa.string()), pa.array(forms, pa.string()), pa.array(list(counted.values()), pa.int64())],
            names=["lang", "form", "n"],
        )


def gram_counts(words: DataFrame) -> DataFrame:
    """``lang, form, n``: in how many distinct words of a language an n-gram stands, once for each place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[str]] = {}
        for batch in batches:
            for tongue, form in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                word = f"^{form}$"
                mine = held.setdefault(tongue, Counter())
                for n in range(1, LONGEST + 1):
                    mine.update([word[i : i + n] for i in range(len(word) - n + 1)])
            if sum(map(len, held.values())) > FLUSH:
                yield from _handed_on(held)
                held = {}
        yield from _handed_on(held)

    return words.select("lang", "form").mapInArrow(count, "lang string, form string, n bigint").groupBy("lang", "form").agg(
        F.sum("n").alias("n")
    )


def most_frequent(counts: DataFrame, groups: list[str], most: int) -> DataFrame:
    """The rows of each group whose count is above the least value at which no more than ``most`` rows remain.

    Ties at that value stay out together, so the bound holds and no order of equal forms is needed.  The
    value comes from a histogram of the counts, which is small whatever the number of forms.
    """
    # powers of 1.02: counts below 50 each have a step of their own
    step = F.when(F.col("n") < 50, F.col("n")).otherwise(F.floor(50 + F.log(F.col("n") / 50.0) / F.log(F.lit(1.02)))).cast("int")
    stepped = counts.withColumn("step", step)
    histogram: dict[tuple, dict[int, int]] = {}
    for *group, at, forms in stepped.groupBy(*groups, "step").agg(F.count("*").alias("forms")).collect():
        histogram.setdefault(tuple(group), {})[at] = forms
    kept = []
    for group, steps in histogram.items():
        least, room = None, most
        for at in sorted(steps, reverse=True):
            room -= steps[at]
            if room < 0:
                break
            least = at
        if least is not None:
            kept.append((*group, least))
    if not kept:
        return counts.where("false")
    schema = ", ".join(f"{name} {counts.schema[name].dataType.simpleString()}" for name in groups) + ", least int"
    least = counts.sparkSession.createDataFrame(kept, schema)
    return stepped.join(F.broadcast(least), groups).where("step >= least").select(*counts.columns)


@dataclass
class Model:
    """The languages, and of the most frequent words and n-grams the log frequency in each."""

    languages: list[str]
    words: dict[bytes, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray


def _scored(counts: DataFrame, languages: list[str], totals: dict[str, int], kinds: int) -> DataFrame:
    """``form, scores``: the log of its share in each language, level where it is equally frequent in all."""
    shares = [
        F.log(
            (F.coalesce(F.sum(F.when(F.col("lang") == name, F.col("n"))), F.lit(0)) + F.lit(UNSEEN))
            / F.lit(totals.get(name, 0) + UNSEEN * (kinds + 1))
        )
        for name in languages
    ]
    return counts.groupBy("form").agg(F.array(*shares).alias("scores"))


def _head(scored: DataFrame, counts: DataFrame, groups: list[str], most: int) -> tuple[list[str], np.ndarray]:
    """Forms that one group keeps, with their scores in all languages."""
    rows = scored.join(most_frequent(counts, groups, most).select("form").distinct(), "form").select("form", "scores").collect()
    return [r.form for r in rows], np.array([r.scores for r in rows], float)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[Model, DataFrame | None, DataFrame | None]:
    """Count words and n-grams of all rows with a language: the model and the tables ``form, scores`` of both."""
    words = stored(word_counts(docs, text, lang), "language-words")
    word_totals = {r.lang: int(r.n) for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(word_totals)
    model = Model(languages, {}, np.zeros((0, len(languages))), {}, np.zeros((0, len(languages))))
    if not languages:
        return model, None, None
    grams = stored(gram_counts(words).withColumn("size", F.char_length("form")), "language-grams")
    scored = stored(_scored(words, languages, word_totals, words.select("form").distinct().count()), "language-word-scores")
    forms, scores = _head(scored, words, ["lang"], WORD_SCORES // len(languages) ** 2)
    if forms:
        model.words, model.word_scores = {f.encode(): i for i, f in enumerate(forms)}, scores
    gram_totals = {(r.lang, r.size): int(r.n) for r in grams.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    gram_kinds = {r.size: r.n for r in grams.groupBy("form", "size").count().groupBy("size").agg(F.count("*").alias("n")).collect()}
    by_size = [
        _scored(grams.where(F.col("size") == size), languages, {name: gram_totals.get((name, size), 0) for name in languages}, kinds)
        for size, kinds in gram_kinds.items()
    ]
    whole = by_size[0]
    for other in by_size[1:]:
        whole = whole.unionAll(other)
    gram_scored = stored(whole, "language-gram-scores")
    forms, scores = _head(gram_scored, grams, ["lang", "size"], GRAM_SCORES // (LONGEST * len(languages) ** 2))
    if forms:
        model.grams, model.gram_scores = {f: i for i, f in enumerate(forms)}, scores
    return model, scored, gram_scored


def _summed(scores: Column, model: Model) -> list[Column]:
    return [F.sum(F.get(scores, F.lit(i))) for i in range(len(model.languages))]


def unseen_scores(forms: DataFrame, model: Model, gram_scores: DataFrame) -> DataFrame:
    """``form, scores`` of words without a count: the mean over the longest known n-gram of each place.

    Places overlap, so their sum would speak several times over: a word counts as one form.
    """
    shared = forms.sparkSession.sparkContext.broadcast(model)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = shared.value
        none = np.zeros(len(known.languages))
        schema = pa.schema(
            [("word", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("gram", pa.string()), ("places", pa.int64()), ("held", pa.list_(pa.float64()))]
        )
        for batch in batches:
            rows: list[tuple] = []
            for form in batch.column(0).to_pylist():
                word, settled = f"^{form}$", []
                for at in range(len(word)):
                    grams = grams_at(word, at)
                    gram = next((g for g in grams if g in known.grams), "")
                    size, place = len(gram), known.grams.get(gram)
                    if size == len(grams):
                        settled.append(place)
                        continue
                    # a longer one may be known beyond the head
                    rows.append((form, at, size, None, int(size > 0), none if place is None else known.gram_scores[place]))
                    rows += [(form, at, len(g), g, 1, None) for g in grams if len(g) > size]
                    if len(rows) > FLUSH:
                        yield _looked_up(rows, schema)
                        rows = []
                rows.append((form, -1, 0, None, len(settled), known.gram_scores[settled].sum(0) if settled else none))
            yield _looked_up(rows, schema)

    asked = forms.select("form").mapInArrow(look, "word string, at bigint, size bigint, gram string, places bigint, held array<double>")
    # rows that ask for nothing meet no n-gram, wherever they are dealt
    key = F.coalesce("gram", F.concat(F.lit("\n"), "word"))
    found = asked.withColumn("form", key).join(gram_scores, "form", "left").withColumn("held", F.coalesce("held", "scores"))
    longest = found.where("held IS NOT NULL").groupBy("word", "at").agg(F.max_by(F.struct("places", "held"), "size").alias("best"))
    summed = longest.groupBy("word").agg(F.sum("best.places").alias("places"), F.array(*_summed(F.col("best.held"), model)).alias("total"))
    mean = F.transform("total", lambda x: x / F.greatest(F.col("places"), F.lit(1)))
    return summed.select(F.col("word").alias("form"), mean.alias("scores"))


def _looked_up(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _parts(docs: DataFrame, model: Model, doc_id: str, text: str) -> DataFrame:
    """Per text one row with what the head settles, and one per distinct word beyond the head.

    ``item`` is the hash of id and text, ``key`` that of the word; rows of texts have a key of no use, which deals them out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[doc_id].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = shared.value
        place_of = known.words.get
        width = len(known.languages)
        hashed = xxhash.xxh64_intdigest
        # the last row is that of all words beyond the head
        scores = np.concatenate([known.word_scores, np.zeros((1, width))])
        for whole in batches:
            for begin in range(0, len(whole), TEXTS):
                batch = whole.slice(begin, TEXTS)
                texts = [t.as_py() for t in batch.column(2).cast(pa.large_binary())]
                bags = [Counter(spoken_words(t)) for t in texts]
                forms = [w for bag in bags for w in bag]
                times = np.fromiter((n for bag in bags for n in bag.values()), np.int64, len(forms))
                text_of = np.repeat(np.arange(len(texts)), [len(bag) for bag in bags])
                places = np.fromiter((place_of(w, -1) for w in forms), np.int64, len(forms))
                sums = [np.bincount(text_of, times * scores[places, i], minlength=len(texts)).astype(float) for i in range(width)]
                rare = np.flatnonzero(places < 0)
                ids = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).tolist()
                items = np.array([hashed(t, i & (2**64 - 1)) for t, i in zip(texts, ids, strict=True)], np.uint64).view(np.int64)
                keys = np.array([hashed(forms[i], SEED) for i in rare.tolist()], np.uint64).view(np.int64)
                owner = np.concatenate([np.arange(len(texts)), text_of[rare]])
                held = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(texts) + 1) * width, pa.int32()), pa.array(np.stack(sums, 1).reshape(-1))
                )
                n = np.bincount(text_of, times, minlength=len(texts)).astype(np.int64)
                spoken = [any(map(str.isalpha, t.decode())) for t in texts]
                settled = pa.StructArray.from_arrays(
                    [batch.column(0), pa.array(n), pa.array(spoken, pa.bool_()), held], names=["doc", "n_words", "spoken", "held"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(items[owner]),
                        pa.array(np.concatenate([items ^ np.arange(len(texts)), keys])),
                        pa.array(np.concatenate([np.zeros(len(texts), np.int64), times[rare]]), pa.int32()),
                        pa.concat_arrays([settled, pa.nulls(len(rare), settled.type)]),
                    ],
                    names=["item", "key", "times", "whole"],
                )

    doc = F.col(doc_id)
    seed = F.xxhash64(doc.isNull(), F.coalesce(doc.cast("string"), F.lit("")))
    source = docs.select(doc.alias("doc"), seed.alias("seed"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    whole = f"whole struct<doc:{id_type},n_words:bigint,spoken:boolean,held:array<double>>"
    return source.mapInArrow(score, f"item bigint, key bigint, times int, {whole}")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred``, ``score``; learnt from folds other than 0 of 5.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no row has a
    language.  Of equally likely languages the first by name is taken.  A null id counts as the empty text
    for the folds; repeated rows give repeated results, an empty table none.  Languages are never read
    for a prediction, and other columns not at all.
    """
    training = fold(doc_id, 5) != 0
    model, word_scores, gram_scores = fit(docs.where(training), text, lang)
    if not model.languages:
        return docs.select(doc_id, (~training).alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # all words of the other rows have a count
    others = docs.where(~training | F.col(lang).isNull()).select(F.col(text).alias("t"), F.lit("").alias("l"))
    unseen = word_counts(others, "t", "l").join(word_scores, "form", "left_anti")
    scored = word_scores.unionAll(stored(unseen_scores(unseen, model, gram_scores), "language-unseen"))
    scored = scored.select(F.xxhash64("form").alias("key"), "scores")
    parts = _parts(docs, model, doc_id, text).join(scored, "key", "left")
    rare = F.col("whole").isNull()
    sums = [
        F.sum(F.when(rare, F.col("times") * F.get("scores", F.lit(i))).otherwise(F.get("whole.held", F.lit(i))))
        for i in range(len(model.languages))
    ]
    # rows that repeat an id and a text meet here; each gets its equal part of the sums
    summed = parts.groupBy("item").agg(
        F.sum(F.when(~rare, 1).otherwise(0)).alias("copies"),
        F.first("whole.doc", ignorenulls=True).alias("doc"),
        F.max("whole.n_words").alias("n_words"),
        F.max("whole.spoken").alias("spoken"),
        F.array(*sums).alias("sums"),
    )
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    total = F.transform("sums", lambda x: x / F.col("copies"))
    each = each.select("doc", "spoken", "n_words", total.alias("total")).withColumn("most", F.array_max("total"))
    names = F.array(*map(F.lit, model.languages))
    best = F.get(names, (F.array_position("total", F.col("most")) - 1).cast("int"))
    # neighbouring words are no independent witnesses
    part = F.transform("total", lambda x: F.exp((x - F.col("most")) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))))
    return each.select(
        F.col("doc").alias(doc_id),
        (fold("doc", 5) == 0).alias("held_out"),
        F.when(F.col("spoken"), best).otherwise("und").alias("lang_pred"),
        F.when(F.col("spoken"), 1.0 / F.aggregate(part, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0).alias("score"),
    )
