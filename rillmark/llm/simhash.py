"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments.  The perfect (23,12,7) Golay code maps a segment
to the index of its nearest codeword, and where that is three bits away also to the five codewords
four bits away; two segments that differ in one bit then always share an index.  Two fingerprints
that differ in at most two bits agree, by pigeonhole, in some segment exactly and in the next one
up to one bit, so (exact segment, codeword index of the next) is a key they share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.base import free_name, stored
from rillmark.llm.components import smallest_reachable

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# (lowest bit, width) of the segments
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# fingerprints that share a key are compared pair by pair up to this many; beyond, by balls
BUCKET = 64
# fixed value: generator polynomial of the binary Golay code
GENERATOR = 0xC75


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingle hashes, as a signed 64-bit number; 0 without any word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(shingle, len(words)) - 1
    one = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - span].tolist(), ends[span:].tolist(), strict=True)
    hashes = np.array([one(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``fp bigint`` for every row."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", fp bigint"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.large_binary())
            values = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "fp"])

    source = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("fp_text"))
    return source.mapInArrow(hashed, schema)


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error pattern, its weight, and the five weight-7 codewords over a weight-3 error."""

    def syndrome(words: np.ndarray) -> np.ndarray:
        rest = words.copy()
        for bit in range(22, 10, -1):
            rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
        return rest

    messages = np.arange(4096, dtype=np.int64) << 11
    codewords = messages | syndrome(messages)
    heavy = codewords[np.bitwise_count(codewords) == 7]
    errors = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)], dtype=np.int64)
    by = syndrome(errors)
    pattern, weight, over = np.zeros(2048, np.int64), np.zeros(2048, np.int64), np.zeros((2048, 5), np.int64)
    pattern[by], weight[by] = errors, np.bitwise_count(errors)
    for s in np.flatnonzero(weight == 3):
        over[s] = heavy[(heavy & pattern[s]) == pattern[s]]
    return pattern, weight, over


def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def golay_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index) for each 23-bit word: one index, or six if the nearest codeword is three bits off."""
    pattern, weight, over = _golay()
    s = _syndromes(words)
    nearest = words ^ pattern[s]
    rows = np.arange(len(words))
    far = np.flatnonzero(weight[s] == 3)
    more = nearest[far, None] ^ over[s[far]]
    return np.concatenate([rows, np.repeat(far, 5)]), np.concatenate([nearest, more.ravel()]) >> 11


def _keys(fps: DataFrame) -> DataFrame:
    """Every key of every fingerprint: ``k bigint, fp bigint``."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = values.view(np.uint64)
            cut = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
            for t in range(3):
                rows, index = golay_indices(cut[(t + 1) % 3])
                key = (np.int64(t) << 40) | (cut[t][rows] << 12) | index
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[rows])], names=["k", "fp"])

    return fps.select("fp").mapInArrow(keyed, "k bigint, fp bigint")


def links(fps: DataFrame) -> DataFrame:
    """Edges ``a, b`` among distinct fingerprints ``fp`` that connect all that differ in at most two bits.

    Small buckets are compared pair by pair.  Fingerprints that meet in a large bucket are connected
    exactly in another way: each sends itself to the 65 points within one bit, all that meet at a
    point differ in at most two bits, and each is tied to the smallest there.  Two fingerprints within
    two bits always meet at such a point, and at most 65 can meet, so the work is linear.
    """
    keys = _keys(fps)
    sizes = stored(keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "golay-buckets")
    met = keys.join(sizes, "k")
    small = met.where(F.col("n") <= BUCKET).groupBy("k").agg(F.sort_array(F.collect_list("fp")).alias("members"))
    pairs = small.select(
        F.explode(
            F.expr(
                "flatten(transform(members, (x, i) -> transform("
                f"filter(members, (y, j) -> j > i and bit_count(x ^ y) <= {MAX_BITS}), y -> struct(x as a, y as b))))"
            )
        ).alias("e")
    ).select("e.a", "e.b")
    crowded = met.where(F.col("n") > BUCKET).select("fp").distinct()
    points = crowded.select(
        "fp",
        F.explode(
            F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(cast(1 as bigint), i)))")
        ).alias("point"),
    )
    centres = stored(points.groupBy("point").agg(F.min("fp").alias("a")), "balls")
    balls = points.join(centres, "point").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionAll(balls).distinct()


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    more: list[str] | None = None,
    root_as: str | None = None,
) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable over links).

    Rows with equal fingerprints are linked.  A null or blank text has fingerprint zero and is linked
    like any other.  Null ids never win the minimum; a component without any id has a null
    ``component_id``.  Repeated rows give repeated results, an empty table none.  Columns other than
    id, text and those named in ``more`` are not read.  ``root_as`` names a column for the smallest
    fingerprint of the component, which is never null.
    """
    keep = [doc_id, *(more or [])]
    printed = stored(fingerprints(docs, keep, text, shingle), "fingerprints")
    classes = stored(printed.groupBy("fp").agg(F.min(doc_id).alias("least")), "classes")
    roots = smallest_reachable(links(classes.select("fp")), "a", "b")
    rooted = classes.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    by_fp = stored(rooted.select("fp", "root").join(least, "root"), "by-fingerprint")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    root = [F.col("root").alias(root_as)] if root_as else []
    return printed.join(by_fp, "fp").select(*keep, hexed, "component_id", *root)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, unchanged: the smallest id, of several rows under it the smallest text hash.

    A null id comes last; rows that repeat an id and a text are one document.
    """
    mine = free_name(docs, "text_print")
    marked = docs.withColumn(mine, F.coalesce(F.unhex(F.md5(text)), F.lit(b"")))
    ids, prints, roots = free_name(marked, "kept_id"), free_name(marked, "kept_print"), "component_key"
    place = F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("i"), F.col(mine).alias("p"))
    grouped = near_duplicates(marked.select(doc_id, mine, text), doc_id, text, shingle, [mine], roots)
    kept = grouped.groupBy(roots).agg(F.min(place).alias("k")).select(F.col("k.i").alias(ids), F.col("k.p").alias(prints))
    kept = stored(kept, "kept")
    same = F.col(doc_id).eqNullSafe(F.col(ids)) & F.col(mine).eqNullSafe(F.col(prints))
    found = marked.join(kept, same)
    # the join has dealt and sorted the rows by these two columns already
    nth, number = Window.partitionBy(doc_id, mine).orderBy(F.lit(0)), free_name(found, "copy")
    return found.withColumn(number, F.row_number().over(nth)).where(F.col(number) == 1).select(docs.columns)
