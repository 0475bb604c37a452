"""Language-model scoring by online logistic context mixing over the texts of a corpus.

A text is predicted word by word, each in its order.  Bit predictors spell the next word from the last
bytes of the text, across blanks.  Above them stand exact counts of the whole corpus, hashed and looked
up for every word: of the word, of the word after the one before, and after the two before; and of the
word in the text so far.  Each count is mixed with what stands below it by a weight that is logistic in
the confidence of its context and learnt online within the text.  What a text itself adds to the counts
of words is left out when it is scored, so that texts of all folds are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log, log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.base import fold, stored
from rillmark.llm.bitmix import LAST, ORDERS, SLOT_BITS, BitMixer, grams, path, slots, spread
from rillmark.llm.keycounts import ASKED, answered, asked, bucket_bits, distinct, first_bits, mixed, run_bits, totals

DISCOUNT = 0.6
# strength of the corpus against what a text has shown so far
KEPT = 3000.0
# counts of a context at which it has half the weight to begin with: the word before, the two words before
HALF = (200.0, 8.0)
# how much evidence a weight of a text needs to move, and how far it may
INERTIA, FURTHEST = 8.0, 6.0
# bytes whose words are hashed at once, and the bytes of a word that is hashed alone
HEAD = 1 << 17
LONG = 1 << 16
# training texts the mixer learns its first weights from, and the characters of each
LESSONS = 400
LESSON_CHARS = 2_000
# words of a chunk of texts; a longer text is a chunk
FLUSH = 250_000
# ratio of the counts of two codes beyond the exact ones
STEP = 1.155
# cells of the mixer's table that come as one row
CELL_BITS = 16
# the end of a text, a token that no word can be, and what stands before its first word
END = "\n"
START = 1
WORD, PAIR, TRIPLE = range(3)
# families of keys: words are told apart by 64 bits, runs of words by as many as their number needs
WORDS, RUNS = range(2)


def _stream(body: bytes) -> bytes:
    """The tokens of a text, a blank between each two; the last one is the end."""
    return b" ".join([*body.lower().split(), END.encode()])


def spelling_counts(words: DataFrame, whole: bool = False) -> DataFrame:
    """``o, k, n``: after which contexts a byte follows, once per place in the words, or in ``whole`` texts' words.

    The key holds the order, the context and the byte.
    """

    def spellings(batch: pa.RecordBatch) -> Iterator[bytes]:
        for body in batch.column(0).cast(pa.large_binary()):
            yield _stream(body.as_py()) if whole else body.as_py()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for begin in range(0, len(batch), 512):
                    for keys in grams(list(spellings(batch.slice(begin, 512)))):
                        yield _counted(keys)

        return _summed(pieces())

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for order in range(ORDERS):
                    # the context's last letters stand next to the byte
                    yield (np.int64(order) << 48) | _shortened(keys, order), n

        return _summed(pieces())

    longest = words.select(words.columns[0]).mapInArrow(count, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    counted = longest.mapInArrow(shorten, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    return counted.select(F.shiftright("k", 48).alias("o"), "k", "n")


def _shortened(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & ((1 << (8 * (order + 1))) - 1)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = np.sort(keys)
    begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(found)), bool), found[1:] != found[:-1]]))
    return found[begins], np.diff(np.append(begins, len(found)))


def _summed(pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Batches ``k, n`` of numbers by key, added up as far as a task can hold them."""
    held: list[np.ndarray] = []
    times: list[np.ndarray] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, which = distinct(np.concatenate(held))
        return keys, np.bincount(which, np.concatenate(times), minlength=len(keys)).astype(np.int64)

    for some, numbers in pieces:
        held.append(some)
        times.append(numbers)
        if sum(map(len, held)) > 2_000_000:
            keys, n = merged()
            held, times = [keys], [n]
            if len(keys) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["k", "n"])
                held, times = [], []
    if held:
        keys, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["k", "n"])


def cell_counts(spelled: DataFrame) -> DataFrame:
    """``block, counts``: the mixer's counts by order, bit and slot, from all contexts, in rows of ``2 ** CELL_BITS`` floats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for order in range(ORDERS):
                    mine = (keys >> 48) == order
                    hashed = spread(order, (keys[mine] >> 8) & ((1 << 40) - 1))
                    for node, bit in path(keys[mine] & 255):
                        yield ((order * 2 + bit) << SLOT_BITS) | slots(hashed, node), n[mine]

        return _summed(pieces())

    def pack(rows: pa.Table) -> pa.Table:
        keys, cells = rows.column("k").to_numpy(), np.zeros(1 << CELL_BITS, np.float32)
        cells[keys & ((1 << CELL_BITS) - 1)] = rows.column("n").to_numpy()
        return pa.table({"block": pa.array([int(keys[0]) >> CELL_BITS], pa.int64()), "counts": pa.array([cells.tobytes()], pa.binary())})

    cells = spelled.select("k", "n").mapInArrow(count, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
    return cells.groupBy(F.shiftright("k", CELL_BITS)).applyInArrow(pack, "block bigint, counts binary")


def _coded(cells: DataFrame) -> DataFrame:
    """``block, codes``: the cells in a byte each, as the driver takes them: exact up to 127, beyond in steps of a sixth."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n = np.frombuffer(counts.as_py(), np.float32)
                beyond = 127 + np.rint(np.log(np.maximum(n, 127) / 127) / np.log(STEP))
                codes = np.where(n <= 127, n, np.minimum(beyond, 255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([codes.tobytes()], pa.binary())], names=["block", "codes"])

    return cells.mapInArrow(code, "block bigint, codes binary")


def _counts_of(codes: bytes) -> np.ndarray:
    code = np.arange(256)
    return np.where(code <= 127, code, 127 * STEP ** (code - 127.0)).astype(np.float32)[np.frombuffer(codes, np.uint8)]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of words that each end with a blank: a polynomial in their bytes, of long words another hash."""
    ends = np.flatnonzero(data == LAST)
    begins = np.concatenate([[0], ends[:-1] + 1])
    out = np.empty(len(ends), np.uint64)
    long = ends - begins >= LONG
    for i in np.flatnonzero(long).tolist():
        out[i] = xxhash.xxh64_intdigest(data[begins[i] : ends[i]].tobytes())
    # runs of words that are not long, of some HEAD bytes
    short = np.flatnonzero(~long)
    run = np.cumsum(long)[short] + begins[short] // HEAD * (len(ends) + 1)
    for at in np.split(short, np.flatnonzero(np.diff(run)) + 1) if len(short) else []:
        first, last = begins[at[0]], ends[at[-1]]
        powers, inverse = _powers(int(last - first))
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_VALUES[data[first:last]] * powers, out=sums[1:])
        b, e = begins[at] - first, ends[at] - first
        out[at] = (sums[e] - sums[b]) * inverse[b]
    return mixed(out, np.maximum(ends - begins, 0))


# fixed values: an odd multiplier and what each byte counts
_BASE = 0xD1342543DE82EF95
_VALUES = mixed(np.arange(256), 0x5851F42D4C957F2D)


def _powers(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the multiplier and of its inverse."""
    if len(_powers.held[0]) < most + 1:
        size = most + most // 4 + 2
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers.held[i] = np.cumprod(row)
    return _powers.held[0][:most], _powers.held[1]


_powers.held = [np.zeros(0, np.uint64)] * 2


@dataclass
class Chunk:
    """The words of some texts one after another, and their keys."""

    streams: list[bytes]
    # of every word: its text, its place in it, its own key among the chunk's sorted ones
    text: np.ndarray
    place: np.ndarray
    word: np.ndarray
    word_keys: np.ndarray
    # the run of two words that it ends, and of three, by the first bits of their hashes
    pair: np.ndarray
    triple: np.ndarray
    run_keys: np.ndarray

    @staticmethod
    def of(texts: list[bytes], width: int) -> Chunk:
        streams = [_stream(t) for t in texts]
        data = np.frombuffer(b"".join(s + b" " for s in streams), np.uint8)
        own = word_hashes(data)
        total = len(own)
        sizes = np.fromiter((s.count(b" ") + 1 for s in streams), np.int64, len(streams))
        text = np.repeat(np.arange(len(streams)), sizes)
        place = np.arange(total) - (np.cumsum(sizes) - sizes)[text]
        before, second = np.roll(own, 1), np.roll(own, 2)
        before[place == 0] = START
        second[place <= 1] = START
        third = np.flatnonzero(place > 0)
        runs = np.concatenate([mixed(PAIR, before, own), mixed(TRIPLE, second[third], before[third], own[third])])
        run_keys, run = distinct(first_bits(runs, width))
        word_keys, word = distinct(own)
        triple = np.full(total, -1)
        triple[third] = run[total:]
        return Chunk(streams, text, place, word, word_keys, run[:total], triple, run_keys)


def _within(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often the text of each word has its key, and how often before it."""
    order = np.argsort((text << 32) | key, kind="stable")
    code = ((text << 32) | key)[order]
    begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]]))
    sizes = np.diff(np.append(begins, len(code)))
    times, before = np.empty(len(code), np.int64), np.empty(len(code), np.int64)
    times[order] = np.repeat(sizes, sizes)
    before[order] = np.arange(len(code)) - np.repeat(begins, sizes)
    return times, before


def _of_others(text: np.ndarray, key: np.ndarray, total: np.ndarray, learnt: np.ndarray) -> np.ndarray:
    """The totals of keys without what the text itself adds."""
    left = total - learnt
    # only a key that is counted more than once can be in other texts
    more = np.flatnonzero((learnt > 0) & (left > 0))
    left[more] = total[more] - _within(text[more], key[more])[0]
    return left


def chunks(docs: DataFrame, doc: Column, held_out: Column, text: str) -> DataFrame:
    """Rows cut into chunks of some FLUSH words: ``chunk, words, learnt, rows``, with the rows ``doc, held, t`` packed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        words = 0

        def row() -> pa.RecordBatch:
            learnt = sum(len(b) - b.column(1).true_count for b in held)
            numbers = [pa.array([n], pa.int64()) for n in (number, words, learnt)]
            packed = pa.array([_packed_rows(held)], pa.binary())
            return pa.RecordBatch.from_arrays([*numbers, packed], names=["chunk", "words", "learnt", "rows"])

        for batch in batches:
            begin = 0
            for i, body in enumerate(batch.column(2).cast(pa.binary())):
                words += len(body.as_py().split()) + 1
                if words >= FLUSH:
                    held.append(batch.slice(begin, i + 1 - begin))
                    yield row()
                    held, words, begin, number = [], 0, i + 1, number + 1
            if begin < len(batch):
                held.append(batch.slice(begin))
        if held:
            yield row()

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select(doc.alias("doc"), held_out.alias("held"), body.alias("t"))
    return source.mapInArrow(cut, "chunk bigint, words bigint, learnt bigint, rows binary")


def _packed_rows(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.Table.from_batches(batches).combine_chunks())
    return sink.getvalue().to_pybytes()


def _rows(packed: pa.Scalar) -> tuple[pa.Array, pa.Array, list[bytes]]:
    """Ids, whether they are held out, and texts."""
    doc, held, texts = pa.ipc.open_stream(packed.as_buffer()).read_all().combine_chunks().columns
    return doc.chunk(0), held.chunk(0), texts.chunk(0).cast(pa.binary()).to_pylist()


def _ask(cut: DataFrame, bits: int, width: int) -> DataFrame:
    """What the chunks ask of the counts: all their words and runs, with what their training texts add."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _, held, texts = _rows(packed)
                chunk = Chunk.of(texts, width)
                counted = (~held.to_numpy(zero_copy_only=False))[chunk.text].astype(float)
                third = chunk.triple >= 0
                words = np.bincount(chunk.word, counted, minlength=len(chunk.word_keys)).astype(np.int64)
                runs = np.bincount(chunk.pair, counted, minlength=len(chunk.run_keys))
                runs += np.bincount(chunk.triple[third], counted[third], minlength=len(chunk.run_keys))
                rows = [*asked(number, WORDS, chunk.word_keys, words, bits)]
                rows += asked(number, RUNS, chunk.run_keys, runs.astype(np.int64), bits, width)
                columns = zip(*rows, strict=True)
                types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", "keys", "counts"])

    return cut.select("chunk", "rows").mapInArrow(ask, ASKED)


@dataclass
class Model:
    # all training words, how many are distinct, and all training texts
    tokens: int
    kinds: int
    texts: int
    mixer: BitMixer

    def spelled(self, chunk: Chunk) -> np.ndarray:
        """Log chance that the next word of the text is spelled so."""
        out = np.zeros(len(chunk.text))
        done = 0
        for keys in grams(chunk.streams):
            ended = (keys & 255) == LAST
            word = np.cumsum(ended) - ended
            summed = np.bincount(word, self.mixer.log_of(keys), minlength=1)
            # a window may end within a word or after its end
            out[done : done + len(summed)] += summed[: len(out) - done]
            done += int(ended.sum())
        return out

    def scores(self, chunk: Chunk, words: np.ndarray, runs: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Log chance of each text, from the totals of the chunk's keys without what the text itself adds."""
        learnt = (~held)[chunk.text].astype(np.int64)
        third = chunk.triple >= 0
        times, seen = _within(chunk.text, chunk.word)
        all_of = words[chunk.word]
        n1 = all_of - times * learnt
        n2 = _of_others(chunk.text, chunk.pair, runs[chunk.pair], learnt)
        n3 = np.zeros(len(n2), np.int64)
        n3[third] = _of_others(chunk.text[third], chunk.triple[third], runs[chunk.triple[third]], learnt[third])
        first = chunk.place == 0
        # how often others have the word before, and the two words before
        one, two = np.roll(n1, 1), np.roll(n2, 1)
        one[first] = two[first] = 0
        size = np.bincount(chunk.text, minlength=len(chunk.streams))
        alone = np.bincount(chunk.text, (seen == 0) & (n1 == 0) & (all_of > 0), minlength=len(size))
        tokens = (self.tokens - size * ~held)[chunk.text]
        kinds = (self.kinds - alone)[chunk.text]
        with np.errstate(divide="ignore"):
            known = np.log(np.maximum(n1 - DISCOUNT, 0)) - np.log(np.maximum(tokens, 1))
            spelled = self.spelled(chunk)
            share = np.where(tokens > 0, np.log(DISCOUNT * kinds / np.maximum(tokens, 1)), 0.0)
            # the end has a count where there are other texts, and is not spelled beside it
            counted_end = np.append(first[1:], True) & (n1 > 0)
            below = np.where(counted_end, known, np.logaddexp(known, share + spelled))
            odds = np.stack([np.log(one / HALF[0]), np.log(two / HALF[1]), np.log(chunk.place / KEPT)])
        shares = np.stack([n2 / np.maximum(one, 1), n3 / np.maximum(two, 1), seen / np.maximum(chunk.place, 1)])
        return mixed_online(chunk.text, chunk.place, len(size), below, odds, shares)


def mixed_online(text: np.ndarray, place: np.ndarray, texts: int, below: np.ndarray, odds: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Log chance of each text, whose words have the log chance ``below`` and, by each context, the chance ``shares``.

    Each context in turn is mixed with what stands below it; its weight has the log-odds ``odds`` (none where
    they are minus infinity) and an offset that the text learns from the words before.  A text's offsets
    are set anew after 16, 32, 64 ... words, later after every 256.
    """
    out = np.zeros(texts)
    moved, sure = np.zeros((len(odds), texts)), np.full((len(odds), texts), INERTIA)
    part = np.where(place < 256, np.log2(np.maximum(place, 8) / 8).astype(np.int64), 4 + place // 256)
    order = np.argsort(part, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
        t = text[at]
        level = below[at]
        slopes = []
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            for k in range(len(odds)):
                weight = 1 / (1 + np.exp(-odds[k, at] - moved[k, t]))
                came = weight * shares[k, at]
                whole = came + (1 - weight) * np.exp(level)
                # a word that the context does not have may be rarer than the least double
                level = np.where(came > 0, np.log(whole), np.log1p(-weight) + level)
                # how much of the word came from the context, and of the weight
                slopes.append((np.where(came > 0, came / whole, 0.0), weight))
        out += np.bincount(t, level, minlength=texts)
        reach = np.ones(len(at))
        for k in reversed(range(len(odds))):
            part_of, weight = slopes[k]
            slope = reach * (part_of - weight)
            reach = reach * (1 - part_of)
            sure[k] += np.bincount(t, slope**2, minlength=texts)
            moved[k] = np.clip(moved[k] + np.bincount(t, slope, minlength=texts) / sure[k], -FURTHEST, FURTHEST)
    return out


@dataclass
class Counts:
    # the chunks, the totals of their keys, and the bits that tell buckets and runs apart
    cut: DataFrame
    totals: DataFrame
    bits: int
    width: int
    # all training words, how many are distinct, and all training texts
    tokens: int
    kinds: int
    texts: int


def count(cut: DataFrame) -> Counts:
    """The totals that chunks ask for."""
    cut = stored(cut, "chunks")
    words, texts = cut.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("learnt"), F.lit(0))).first()
    # a word is a key, and ends two more
    bits, width = bucket_bits(3 * words), run_bits(2 * words)
    counted = stored(totals(_ask(cut, bits, width)), "key-totals")
    mine = F.shiftright("bucket", bits) == WORDS
    kinds = F.coalesce(F.sum(F.when(mine, F.col("kinds"))), F.lit(0))
    tokens, kinds = counted.agg(F.coalesce(F.sum(F.when(mine, F.col("sum"))), F.lit(0)), kinds).first()
    return Counts(cut, counted, bits, width, int(tokens), int(kinds), int(texts))


def fit(docs: DataFrame, text: str = "text", counts: Counts | None = None) -> tuple[Model, Counts]:
    """The model of all these texts, and their counts; the weights of the bit predictors are learnt from some of them."""
    counts = counts or count(chunks(docs, F.lit(None).cast("string"), F.lit(False), text))
    mixer = BitMixer()
    spelled = stored(spelling_counts(docs.select(F.coalesce(F.col(text).cast("string"), F.lit(""))), whole=True), "spelling-counts")
    cells = mixer.counts.reshape(-1)
    for row in _coded(cell_counts(spelled)).collect():
        cells[row.block << CELL_BITS : (row.block + 1) << CELL_BITS] = _counts_of(row.codes)
    # a pseudo-random part of the texts, some LESSONS of them
    parts = max(1, counts.texts // (2 * LESSONS))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    some = docs.select(body.alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(parts)) == 0)
    begun = some.select(F.substring("t", 1, LESSON_CHARS).alias("t")).distinct().orderBy(F.md5("t"), "t").limit(LESSONS)
    mixer.learn([_stream(r.t.encode()) for r in begun.collect()])
    return Model(counts.tokens, counts.kinds, counts.texts, mixer.freeze()), counts


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the counts and both scores; learnt from folds other than 0 of 10.

    A null text is empty: its one token is the end.  A null id counts as the empty text for the folds.
    Repeated rows give repeated results; an empty table gives none.  Without training texts every word
    is spelled without any context, and the base score is 0.  Other columns are not read.
    """
    counts = count(chunks(docs, F.col(doc_id), fold(doc_id, 10) == 0, text))
    model, _ = fit(docs.where(fold(doc_id, 10) != 0), text, counts)
    bits, width = counts.bits, counts.width
    shared = docs.sparkSession.sparkContext.broadcast(model)
    size = log10(model.tokens + 0.1 * (model.kinds + 1))

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        known: Model = shared.value
        ids, held_out, bodies = _rows(rows.column("rows")[0])
        chunk = Chunk.of(bodies, width)
        totals_of = list(zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist(), strict=True))
        words, runs = answered(totals_of, WORDS, bits), answered(totals_of, RUNS, bits)
        score = known.scores(chunk, words, runs, held_out.to_numpy(zero_copy_only=False)) / log(10)
        all_of = words[chunk.word]
        n = np.bincount(chunk.text, minlength=len(bodies))
        n_known = np.bincount(chunk.text, all_of > 0, minlength=len(bodies)).astype(np.int64)
        base = np.bincount(chunk.text, np.log10(all_of + 0.1), minlength=len(bodies)) - n * size
        length = np.maximum(np.fromiter(map(len, bodies), np.int64, len(bodies)), 1)
        return pa.table(
            {
                doc_id: ids,
                "held_out": held_out,
                "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(n_known),
                "train_tokens": pa.array(np.full(len(bodies), known.tokens), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score),
                "bits_per_byte": pa.array(-score * (log(10) / log(2)) / length),
            }
        )

    scored = ", ".join(("held_out boolean", *(f"{c} bigint" for c in ("n_tokens", "n_known", "train_tokens")), *(f"{c} double" for c in ("base_score", "score", "bits_per_byte"))))
    both = counts.cut.groupBy("chunk").cogroup(counts.totals.select("chunk", "bucket", "totals").groupBy("chunk"))
    return both.applyInArrow(score, f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, {scored}")
