"""Exact top-k inner products with a pivot table.

|q - x|^2 = |q|^2 + |x|^2 - 2 qx, and the distances of q and x to a pivot differ by at most |q - x|: the
largest such difference over all pivots bounds the distance from below, and so the product from above.
Candidates are evaluated in the order of their bounds until no bound reaches the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.base import stored
from rillmark.session import scratch

SCALE = 256
PIVOTS = 24
# queries that one pass over the vectors answers; more queries take more passes
QUERY_BLOCK = 4096
# vectors bounded at a time, and candidates evaluated between two looks at the bound
ROWS = 4096
STEP = 64
LONG = np.iinfo(np.int64)
# components beyond this count as this: their products are beyond a long already, and sums of squares stay finite
LARGEST = 1e150


@dataclass
class Queries:
    """The queries of one block that have the same number of components."""

    ids: np.ndarray
    vectors: np.ndarray
    pivots: np.ndarray
    distances: np.ndarray


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * (vectors @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def _whole(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.clip(x, -LARGEST, LARGEST))


def pivots_of(vectors: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Farthest-first choice among the queries."""
    chosen = [int(np.argmax((vectors**2).sum(1)))]
    nearest = _distances(vectors, vectors[chosen])[:, 0]
    while len(chosen) < min(n, len(vectors)) and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, _distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def prepare(rows: list[tuple[int, list[float]]]) -> dict[int, Queries]:
    by_width: dict[int, dict[int, tuple[float, ...]]] = {}
    for vec_id, vector in rows:
        mine = tuple(vector)
        held = by_width.setdefault(len(mine), {})
        held[vec_id] = min(mine, held.get(vec_id, mine))
    prepared = {}
    for width, held in by_width.items():
        vectors = _whole(np.array(list(held.values()), np.float64).reshape(len(held), width))
        pivots = pivots_of(vectors)
        prepared[width] = Queries(np.array(list(held), np.int64), vectors, pivots, _distances(vectors, pivots))
    return prepared


class Best:
    """The k best (score, id) per query seen so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n

    def least(self, q: int) -> int | None:
        scores = self.found[q][0]
        return int(scores[-1]) if len(scores) == self.k else None

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.found[q][0], scores]), np.concatenate([self.found[q][1], ids])
        order = np.lexsort((ids, ~scores))[: self.k]
        self.found[q] = scores[order], ids[order]


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers; beyond 53 bits in Python's integers, and held to the range of long."""
    if vectors.size and np.abs(vectors).max() * np.abs(query).max() * max(1, len(query)) >= 2.0**52:
        whole = [int(q) for q in query]
        exact = [sum(int(x) * q for x, q in zip(row, whole, strict=True)) for row in vectors]
        return np.array([min(max(v, LONG.min), LONG.max) for v in exact], np.int64)
    return (vectors @ query).astype(np.int64)


def search_block(known: Queries, ids: np.ndarray, vectors: np.ndarray, best: Best) -> None:
    """Offer a block of vectors to every query."""
    norms = (vectors**2).sum(1)
    table = np.ascontiguousarray(_distances(vectors, known.pivots).T)
    for q, query in enumerate(known.vectors):
        own = float(query @ query)
        bound = np.zeros(len(ids))
        for p in range(len(table)):
            np.maximum(bound, np.abs(table[p] - known.distances[q, p]), out=bound)
        # room for rounding, so that the bound stays a bound
        most = (own + norms - bound**2) / 2 + 1e-6 * (1 + own + norms)
        least = best.least(q)
        open_ = np.flatnonzero((ids != known.ids[q]) if least is None else (ids != known.ids[q]) & (most >= least))
        open_ = open_[np.argsort(-most[open_])]
        for at in range(0, len(open_), STEP):
            least = best.least(q)
            step = open_[at : at + STEP]
            if least is not None and most[step[0]] < min(least, 2.0**62):
                break
            best.add(q, _products(vectors[step], query), ids[step])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose id is divisible by ``every``, against all others.

    Null ids, null vectors and vectors with a null or non-finite component take no part.  A query's
    candidates are the rows under other ids with as many components; repeated rows are candidates each,
    an id repeated with other vectors is asked once, with the smallest.  Scores are exact; those beyond
    the range of long stay at its end.  Fewer candidates give fewer rows, an empty table none.
    The queries are stored once and go in blocks of some ``QUERY_BLOCK``.  Each block is one pass, whose answers are
    stored before the next begins, so that the driver and the tasks hold the queries of one block at a time.
    """
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    # one row per id and number of components before any goes to the driver
    asked = usable.where(F.col("id") % every == 0).groupBy("id", F.size("v").alias("width")).agg(F.min("v").alias("v"))
    asked = stored(asked, "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    paths = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        shared = usable.sparkSession.sparkContext.broadcast(prepare([(r.id, r.v) for r in rows]))
        paths.append(scratch(usable.sparkSession, "answers"))
        ranked = _pass(usable, shared, k).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        ranked.write.parquet(paths[-1])
        shared.destroy()
    schema = "query_id bigint, vec_id bigint, score bigint, rank int"
    return usable.sparkSession.read.schema(schema).parquet(*paths).select("query_id", "rank", "vec_id", "score")


def _pass(usable: DataFrame, shared: Broadcast[dict[int, Queries]], k: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best = {width: Best(len(q.ids), k) for width, q in queries.items()}
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                lists = part.column(1)
                widths = np.diff(lists.offsets.to_numpy())
                flat = _whole(lists.flatten().to_numpy(zero_copy_only=False))
                starts = np.concatenate([[0], np.cumsum(widths)])[:-1]
                for width in np.unique(widths).tolist():
                    if width in queries:
                        rows = np.flatnonzero(widths == width)
                        cells = flat[starts[rows][:, None] + np.arange(width)[None, :]]
                        search_block(queries[width], ids[rows], cells, best[width])
        for width, q in queries.items():
            lengths = [len(scores) for scores, _ in best[width].found]
            if sum(lengths):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(q.ids, lengths)),
                        pa.array(np.concatenate([ids for _, ids in best[width].found])),
                        pa.array(np.concatenate([scores for scores, _ in best[width].found])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return usable.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
