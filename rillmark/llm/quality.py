"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned vector; learned filters read windows of eight bytes, four apart.  Windows are
pooled by their maximum over overlapping chunks that cover the whole text, and the mean, least and
greatest response of each filter over the chunks are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.base import fold, labelled_sample

# labelled rows per class that the network is trained on, and bytes of them at most
SAMPLE = 1200
SAMPLE_BYTES = 5 << 20
THRESHOLD = 0.7
VECTOR, FILTERS = 8, 32
# bytes between windows; a window is two such blocks
BLOCK = 4
# windows of a chunk: it reads 508 bytes, the last four of them again at the beginning of the next
CHUNK = 126
EPOCHS, BATCH, RATE = 14, 32, 0.01
# bytes of texts that go through the network at once
PIECE = 1 << 20
# texts that are encoded at once
TEXTS = 256
SEED = 11


@dataclass
class Layout:
    """Texts as blocks of bytes, one after another, and where their windows and chunks begin."""

    blocks: np.ndarray
    starts: np.ndarray  # first window of every chunk, and the void window between texts, in turn
    chunks: np.ndarray  # which of these are chunks
    first_chunk: np.ndarray
    n_chunks: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Layout:
        sizes = [max(2, -(-len(t) // BLOCK)) for t in texts]
        joined = b"".join(t.ljust(BLOCK * n, b"\0") for t, n in zip(texts, sizes, strict=True))
        blocks = np.frombuffer(joined, np.uint8).reshape(-1, BLOCK)
        begins = np.cumsum(sizes) - sizes
        starts, real, n_chunks = [], [], []
        for begin, size in zip(begins.tolist(), sizes, strict=True):
            mine = list(range(begin, begin + size - 1, CHUNK))
            starts += [*mine, begin + size - 1]
            real += [True] * len(mine) + [False]
            n_chunks.append(len(mine))
        counts = np.array(n_chunks)
        return cls(blocks, np.array(starts), np.array(real), np.cumsum(counts) - counts, counts)


@dataclass
class Network:
    vectors: np.ndarray
    filters: np.ndarray  # (2, BLOCK * VECTOR, FILTERS): for the first and the second block of a window
    bias: np.ndarray
    weights: np.ndarray  # (3, FILTERS): for mean, least and greatest response
    offset: float
    flat: float | None = None

    @classmethod
    def fresh(cls) -> Network:
        draw = np.random.default_rng(SEED)
        return cls(
            draw.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
            draw.normal(0, 0.2, (2, BLOCK * VECTOR, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            draw.normal(0, 0.1, (3, FILTERS)).astype(np.float32),
            0.0,
        )

    def responses(self, layout: Layout) -> np.ndarray:
        """Response of every filter at every window."""
        read = self.vectors[layout.blocks].reshape(len(layout.blocks), -1)
        out = read @ self.filters[0]
        out[:-1] += (read @ self.filters[1])[1:]
        return out

    def pooled(self, layout: Layout, out: np.ndarray) -> np.ndarray:
        return np.tanh(np.maximum.reduceat(out, layout.starts, axis=0)[layout.chunks] + self.bias)

    def features(self, layout: Layout, act: np.ndarray) -> np.ndarray:
        first = layout.first_chunk
        mean = np.add.reduceat(act, first, axis=0) / layout.n_chunks[:, None]
        return np.stack([mean, np.minimum.reduceat(act, first, axis=0), np.maximum.reduceat(act, first, axis=0)], 1)

    def features_of_long(self, text: bytes) -> np.ndarray:
        """The same features of one text, some chunks at a time: what is laid out never exceeds a piece."""
        windows = max(1, -(-len(text) // BLOCK) - 1)
        step = max(1, PIECE // (CHUNK * BLOCK)) * CHUNK
        total, least, greatest, chunks = np.zeros(FILTERS), np.full(FILTERS, np.inf), np.full(FILTERS, -np.inf), 0
        for begin in range(0, windows, step):
            # the last window of a piece reads one block more
            end = min(begin + step, windows)
            layout = Layout.of([text[BLOCK * begin : BLOCK * (end + 1)]])
            act = self.pooled(layout, self.responses(layout))
            total, chunks = total + act.sum(0), chunks + len(act)
            least, greatest = np.minimum(least, act.min(0)), np.maximum(greatest, act.max(0))
        return np.stack([total / chunks, least, greatest])[None]

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        if self.flat is not None:
            return out + self.flat
        held: list[int] = []
        for i, text in enumerate(texts):
            if len(text) > PIECE:
                out[i] = self._probability(self.features_of_long(text))[0]
            else:
                held.append(i)
            if held and (sum(len(texts[j]) for j in held) >= PIECE or len(held) == 1000 or i == len(texts) - 1):
                layout = Layout.of([texts[j] for j in held])
                out[held] = self._probability(self.features(layout, self.pooled(layout, self.responses(layout))))
                held = []
        return out

    def _probability(self, found: np.ndarray) -> np.ndarray:
        z = (found * self.weights).sum((1, 2)) + self.offset
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -500, 500)))

    def gradients(self, texts: list[bytes], truth: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        layout = Layout.of(texts)
        out = self.responses(layout)
        act = self.pooled(layout, out)
        found = self.features(layout, act)
        z = (found * self.weights).sum((1, 2)) + self.offset
        miss = (weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth)).astype(np.float32)
        text_of = np.repeat(np.arange(len(texts)), layout.n_chunks)
        back = self.weights[0] / layout.n_chunks[text_of][:, None]
        # ties share the least and the greatest
        for part in (1, 2):
            here = act == found[text_of, part]
            share = np.add.reduceat(here.astype(np.float32), layout.first_chunk, axis=0)
            back = back + self.weights[part] * here / share[text_of]
        back = back * miss[text_of][:, None] * (1 - act**2)
        begins = layout.starts[layout.chunks]
        ends = np.concatenate([layout.starts[1:], [len(out)]])[layout.chunks]
        best = np.stack([b + np.argmax(out[b:e], axis=0) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)])
        grads = [np.zeros_like(self.vectors), np.zeros_like(self.filters), back.sum(0), np.einsum("tpf,t->pf", found, miss), miss.sum()]
        for half in (0, 1):
            letters = layout.blocks[best + half]
            read = self.vectors[letters].reshape(*best.shape, -1)
            grads[1][half] = np.einsum("cfx,cf->xf", read, back)
            spread = (back[:, :, None] * self.filters[half].T[None]).reshape(-1, VECTOR)
            flat = letters.reshape(-1)
            for v in range(VECTOR):
                grads[0][:, v] += np.bincount(flat, spread[:, v], 256)
        return grads


def train(texts: list[bytes], truth: np.ndarray, totals: tuple[int, int]) -> Network:
    """Adam on classes of equal weight; the offset then moves to the balance of all labelled rows."""
    net = Network.fresh()
    share = (totals[1] + 0.5) / (sum(totals) + 1)
    n = np.bincount(truth, minlength=2)
    if not n.all():
        net.flat = share
        return net
    weight = np.where(truth == 1, 0.5 / n[1], 0.5 / n[0]) * len(truth) / BATCH
    names = ("vectors", "filters", "bias", "weights", "offset")
    first, second, step = [0.0] * 5, [0.0] * 5, 0
    draw = np.random.default_rng(SEED)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            mine = order[at : at + BATCH]
            step += 1
            for i, g in enumerate(net.gradients([texts[j] for j in mine], truth[mine], weight[mine])):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g**2
                move = rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
                old = getattr(net, names[i])
                setattr(net, names[i], float(old - move) if i == 4 else (old - move).astype(np.float32))
    net.offset += float(np.log(share / (1 - share)))
    return net


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """Train on labelled rows of folds other than 2 of 4, at most ``SAMPLE`` rows a class, whole texts."""
    sample, totals = labelled_sample(docs, labels, doc_id, text, label, SAMPLE, SAMPLE_BYTES)
    texts = [body for value in (0, 1) for _, body in sample[value]]
    return train(texts, np.array([0] * len(sample[0]) + [1] * len(sample[1]), np.int64), totals)


def report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score``, ``predicted``.

    A null text is empty, and an empty one reads as eight zero bytes.  A null id counts as the empty text
    for the folds and is no labelled row; an id labelled twice has the better label; repeated rows give
    repeated results, an empty table none.  Without labels of both kinds every score is the share of the
    one there is (a half without any).  Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = shared.value
        for batch in batches:
            # a few texts at a time: a batch may hold thousands of long ones
            scores = [net.score([t.encode() for t in batch.iloc[i : i + TEXTS]]) for i in range(0, len(batch), TEXTS)]
            yield pd.Series(np.concatenate(scores) if scores else [], dtype="float64")

    scored = docs.select(
        doc_id, (fold(doc_id, 4) == 2).alias("held_out"), score(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
