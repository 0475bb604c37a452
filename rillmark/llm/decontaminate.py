"""Benchmark decontamination with an FM-index per shard of documents.

A shard is as many documents, whole, as a task reads until it has ``SHARD_WORDS`` words.  Its words
are indexed over the alphabet of the test phrases; the phrases are searched backwards in the index,
located, and the word positions they cover merged into spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.base import free_name, stored, word_bytes
from rillmark.llm.fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 300_000
# bytes of test items that one pass over the documents searches for; more items take more passes
BLOCK_BYTES = 8 << 20

_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


@dataclass
class Phrases:
    """Distinct windows of a block of items, as rows of word numbers, by length."""

    vocabulary: dict[bytes, int]
    by_length: dict[int, np.ndarray]
    # ids of the items that hold a window, in the order of the rows
    items: dict[int, list[list[str]]]


def phrases(items: list[tuple[str | None, bytes]], window: int) -> Phrases:
    vocabulary: dict[bytes, int] = {}
    held: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in word_bytes(text)]
        size = min(window, len(numbers))
        for at in range(len(numbers) - size + 1 if size else 0):
            found = held.setdefault(tuple(numbers[at : at + size]), set())
            if item is not None:
                found.add(item)
    by_length: dict[int, list[tuple[int, ...]]] = {}
    for row in held:
        by_length.setdefault(len(row), []).append(row)
    return Phrases(
        vocabulary,
        {size: np.array(rows, np.int64) for size, rows in by_length.items()},
        {size: [sorted(held[row]) for row in rows] for size, rows in by_length.items()},
    )


def _search_shard(texts: list[bytes], known: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per document: number of words, merged spans of word positions, ids of the items found."""
    get = known.vocabulary.get
    pieces, sizes = [], []
    for text in texts:
        mine = word_bytes(text)
        pieces.append(np.fromiter(map(get, mine, (0 for _ in mine)), dtype=np.int32, count=len(mine)))
        sizes.append(len(mine))
    ends = np.cumsum(np.array(sizes, np.int64) + 1)
    symbols = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    for end, piece in zip(ends.tolist(), pieces, strict=True):
        symbols[end - 1 - len(piece) : end - 1] = piece
    # neighbouring separators say no more than one
    kept = np.flatnonzero((symbols != 0) | np.concatenate([[True], symbols[:-1] != 0]))
    if len(kept) and symbols[kept[-1]] != 0:
        raise AssertionError("a shard ends with a separator")
    index = FMIndex(symbols[kept], len(known.vocabulary) + 1)
    cover = np.zeros(len(symbols) + 1, np.int32)
    found: list[set[str]] = [set() for _ in texts]
    for size, rows in known.by_length.items():
        low, high = index.search(rows)
        hit = np.flatnonzero(low < high)
        times = (high - low)[hit]
        suffixes = np.repeat(low[hit] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        start = kept[index.locate(suffixes)]
        np.add.at(cover, start, 1)
        np.add.at(cover, start + size, -1)
        # each window once per document
        pairs = np.unique(np.searchsorted(ends, start, side="right") * len(rows) + np.repeat(hit, times))
        for pair in pairs.tolist():
            found[pair // len(rows)].update(known.items[size][pair % len(rows)])
    covered = np.cumsum(cover) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    result = [(size, [], []) for size in sizes]
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        doc = int(np.searchsorted(ends, start, side="right"))
        first = int(ends[doc]) - 1 - sizes[doc]
        result[doc][1].append((start - first, end - first))
    return [(size, spans, sorted(ids)) for (size, spans, _), ids in zip(result, found, strict=True)]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], end))
        else:
            merged.append((start, end))
    return merged


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between them; a line break takes their place."""
    if not spans or text is None:
        return text
    places = [m.span() for m in _WORD.finditer(text.translate({c: c + 32 for c in range(0x41, 0x5B)}))]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    out.append(text[at:])
    return "\n".join(out)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    clean: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every row, then ``n_words``, ``hit_spans`` (word positions) and ``hit_items``.

    Where ``keep`` has such a name in any case, that column stays and the new one has a line before its name.

    With ``clean`` the text among ``keep`` loses the words of the spans.  A null text has no words and
    stays null; items without words have no window; a null item id is found but not listed; repeated
    rows give repeated results; empty tables give no rows or no hits.  Columns not in ``keep`` are not
    read.  The items are taken in blocks of at most ``BLOCK_BYTES``: each block is one pass that adds to
    the spans and items of the pass before, and from the second on passes are written down between.
    """
    if clean and text not in keep:
        raise ValueError("clean rewrites the text column, which must be kept")
    items = benchmark.select(
        F.col(item_id).cast("string").alias("i"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t")
    )
    # copies of an item would all fall into one block
    items = items.distinct()
    # the largest item decides whether a block can stay within its bound
    total = items.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * int(total) // BLOCK_BYTES)) if total > BLOCK_BYTES else 1
    placed = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    kept = docs.select(*keep)
    n_words, spans, found, source = (free_name(kept, c) for c in ("n_words", "hit_spans", "hit_items", "shard_text"))
    frame = docs.select(
        *keep,
        F.lit(0).cast("bigint").alias(n_words),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias(spans),
        F.array().cast("array<string>").alias(found),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias(source),
    )
    for block in range(blocks):
        rows = [(r.i, r.t.encode()) for r in placed.where(F.col("b") == block).select("i", "t").toLocalIterator()]
        # the last pass knows all spans and may cut
        cut_at = keep.index(text) if clean and block + 1 == blocks else None
        frame = _pass(frame, phrases(rows, window), len(keep), cut_at)
        if block + 1 < blocks:
            frame = stored(frame, "contamination")
    return frame.drop(source)


def _batch(
    rows: list[pa.RecordBatch], results: list, n_keep: int, cut_at: int | None, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    at = 0
    for batch in rows:
        n, spans, ids = [], [], []
        for (size, new, items), old, had in zip(
            results[at : at + len(batch)], batch.column(n_keep + 1).to_pylist(), batch.column(n_keep + 2).to_pylist(), strict=True
        ):
            n.append(size)
            spans.append([{"start": a, "end": b} for a, b in merge_spans(new + [(s["start"], s["end"]) for s in old])])
            ids.append(sorted({*items, *had}))
        at += len(batch)
        kept = [batch.column(i) for i in range(n_keep)]
        if cut_at is not None and any(spans):
            texts = kept[cut_at].to_pylist()
            cleaned = [cut(t, [(s["start"], s["end"]) for s in found]) for t, found in zip(texts, spans, strict=True)]
            kept[cut_at] = pa.array(cleaned, kept[cut_at].type)
        columns = [
            *kept,
            pa.array(n, pa.int64()),
            pa.array(spans, schema.field(n_keep + 1).type),
            pa.array(ids, schema.field(n_keep + 2).type),
            batch.column(n_keep + 3),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)


def _pass(frame: DataFrame, known: Phrases, n_keep: int, cut_at: int | None) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast(known)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        texts: list[bytes] = []
        volume = 0
        for whole in batches:
            schema = whole.schema
            # rows join the shard one small slice at a time, so that a shard's size does not depend on Arrow's
            for begin in range(0, len(whole), 64):
                piece = whole.slice(begin, 64)
                held.append(piece)
                mine = [t.as_py() for t in piece.column(n_keep + 3).cast(pa.large_binary())]
                texts += mine
                volume += sum(map(len, mine))
                # a word and its blank have seven bytes or so
                if volume >= 7 * SHARD_WORDS:
                    yield from _batch(held, _search_shard(texts, shared.value), n_keep, cut_at, schema)
                    held, texts, volume = [], [], 0
        if held:
            yield from _batch(held, _search_shard(texts, shared.value), n_keep, cut_at, schema)

    return frame.mapInArrow(search, frame.schema)


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document the counts of words, hit words and items, and a digest of the items."""
    found = find(docs, benchmark, [doc_id])
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        doc_id,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def digest(items: list[str]) -> str:
    return sha256(",".join(sorted(items)).encode()).hexdigest()
