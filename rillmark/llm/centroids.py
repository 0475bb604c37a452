"""Lloyd's clustering, sharded by dimension.

The vectors are stored once as blocks: up to ``CHUNK`` vectors by the components of one shard.  In a round every
task computes exact partial distances of its blocks to that shard's slice of the centroids; the partial
distances of a chunk are added over its shards, and the smallest gives the cluster of each vector.  Then each
shard adds up its own blocks by cluster and makes its own slice of the next centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from rillmark.llm.base import stored
from rillmark.session import scratch

SCALE = 64
WIDTH = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
SHARDS = 4
# vectors of a block, and of those that meet the centroids at a time
CHUNK = 4096
STEP = 512
# whole components beyond this count as this, so that squared distances of 128 components stay in a long
LARGEST = 1 << 27
LONGEST = np.iinfo(np.int64).max


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the narrowest type that holds them all, little-endian."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in ("<i1", "<i2", "<i4"):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return kind, values.astype(kind).tobytes()
    return "<i8", values.astype("<i8").tobytes()


def _unpacked(kind: str, data: bytes, columns: int = 1) -> np.ndarray:
    return np.frombuffer(data, kind).astype(np.int64).reshape(-1, columns)


def _slices(width: int, shards: int) -> list[slice]:
    bounds = np.linspace(0, width, shards + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]


def _sound(vectors: DataFrame, vec_id: str, vector: str, width: int) -> DataFrame:
    """``id, v`` of the vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where((F.size(vector) == width) & finite).select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))


def _whole(flat: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(scale * flat), -LARGEST, LARGEST).astype(np.int64)


def _blocks(sound: DataFrame, width: int, scale: int, shards: int) -> DataFrame:
    """``chunk, ids, kind, cells, shard``, stored by shard; the ids stand with shard 0 only."""
    schema = StructType(
        [
            StructField("chunk", LongType()),
            StructField("ids", ArrayType(sound.schema["id"].dataType)),
            StructField("kind", StringType()),
            StructField("cells", BinaryType()),
            StructField("shard", IntegerType()),
        ]
    )
    parts = _slices(width, shards)

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                rows = batch.slice(at, CHUNK)
                cells = _whole(rows.column(1).flatten().to_numpy(zero_copy_only=False), scale).reshape(-1, width)
                packed = [_packed(cells[:, part]) for part in parts]
                ids = [rows.column(0).to_pylist(), *[None] * (shards - 1)]
                kinds, data = zip(*packed, strict=True)
                columns = [[chunk] * shards, ids, list(kinds), list(data), list(range(shards))]
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.list_(rows.column(0).type), pa.string(), pa.binary(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                chunk += 1

    path = scratch(sound.sparkSession, "column-blocks")
    sound.mapInArrow(blocked, schema).write.partitionBy("shard").parquet(path)
    return sound.sparkSession.read.schema(schema).parquet(path)


def _assigned(blocks: DataFrame, centroids: np.ndarray, width: int, shards: int) -> DataFrame:
    """``chunk, cluster_kind, cluster, distance_kind, distance``: nearest centroid and squared distance of each vector."""
    parts, k = _slices(width, shards), len(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, kind, cells, shard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slice_ = centroids[:, parts[shard]]
                x = _unpacked(kind, cells, slice_.shape[1])
                found = np.empty((len(x), k), np.int64)
                for at in range(0, len(x), STEP):
                    apart = x[at : at + STEP, None, :] - slice_[None, :, :]
                    found[at : at + STEP] = np.einsum("nkd,nkd->nk", apart, apart)
                name, data = _packed(found)
                yield pa.RecordBatch.from_pydict({"chunk": [chunk], "kind": [name], "distances": [data]})

    def added(table: pa.Table) -> pa.Table:
        total = 0
        for kind, data in zip(table.column("kind").to_pylist(), table.column("distances").to_pylist(), strict=True):
            total = total + _unpacked(kind, data, k)
        # of equal distances the first, that is the smaller number
        cluster = total.argmin(1)
        kinds, data = zip(_packed(cluster), _packed(total[np.arange(len(cluster)), cluster]), strict=True)
        return pa.Table.from_pydict(
            {"chunk": table.column("chunk")[:1].to_pylist(), "cluster_kind": [kinds[0]], "cluster": [data[0]], "distance_kind": [kinds[1]], "distance": [data[1]]}
        )

    sums = blocks.select("chunk", "kind", "cells", "shard").mapInArrow(partial, "chunk bigint, kind string, distances binary")
    schema = "chunk bigint, cluster_kind string, cluster binary, distance_kind string, distance binary"
    return stored(sums.groupBy("chunk").applyInArrow(added, schema), "assigned")


def _moved(blocks: DataFrame, assigned: DataFrame, centroids: np.ndarray, width: int, shards: int) -> np.ndarray:
    """The next centroids: exact floors of the means, slice by slice; a centroid without vectors stays."""
    parts, k = _slices(width, shards), len(centroids)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for shard, kind, cells, cluster_kind, cluster in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = parts[shard].stop - parts[shard].start
                sums, counts = held.setdefault(shard, (np.zeros((k, size), np.int64), np.zeros(k, np.int64)))
                mine = _unpacked(cluster_kind, cluster)[:, 0]
                np.add.at(sums, mine, _unpacked(kind, cells, size))
                counts += np.bincount(mine, minlength=k)
        for shard, (sums, counts) in held.items():
            some = np.flatnonzero(counts)
            rows = {"shard": [shard] * len(some), "cluster": some, "n": counts[some], "sums": list(sums[some])}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(rows.items(), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)})

    # the clusters of a chunk are a byte or two a vector: the side to build a hash table of
    met = blocks.join(assigned.select("chunk", "cluster_kind", "cluster").hint("shuffle_hash"), "chunk")
    partial = met.select("shard", "kind", "cells", "cluster_kind", "cluster").mapInArrow(summed, "shard int, cluster int, n bigint, sums array<bigint>")
    cells = partial.select("shard", "cluster", "n", F.posexplode("sums").alias("place", "x")).groupBy("shard", "cluster", "place")
    floors = cells.agg(F.sum("x").alias("x"), F.sum("n").alias("n")).select("shard", "cluster", "place", F.expr("(x - pmod(x, n)) div n").alias("mean"))
    moved = centroids.copy()
    # one number for each component of each centroid
    for r in floors.collect():
        moved[r.cluster, parts[r.shard].start + r.place] = r["mean"]
    return moved


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
    shards: int = SHARDS,
) -> DataFrame:
    """Per vector: id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors with another width, a null or a non-finite component take no part.  Components become whole numbers,
    those beyond ``LARGEST`` count as that.  Centroids start as the vectors whose seeded id has the smallest SHA-256, of
    equal ids the smallest vector; null ids start none, and fewer ids than clusters start fewer centroids.  Repeated
    rows are vectors each, null ids stay null.  Sums beyond a long stay at its end.  No vector, or none with an id,
    gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    shards = max(1, min(shards, width))
    sound = _sound(vectors, vec_id, vector, width)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    whole = F.transform("v", lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(x, F.lit(-1e15)), F.lit(1e15)) * scale), F.lit(-LARGEST)), F.lit(LARGEST)))
    first = sound.where("id IS NOT NULL").select(order.alias("order"), whole.alias("v")).orderBy("order", "v").limit(clusters).collect()
    kind = vectors.schema[vec_id].dataType
    schema = StructType([StructField(vec_id, kind), StructField("cluster", IntegerType()), StructField("distance", LongType())])
    if not first:
        empty = spark.createDataFrame([], schema)
        return empty.selectExpr("*", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    centroids = np.array([r.v for r in first], np.int64)
    blocks = _blocks(sound, width, scale, shards)
    for _ in range(rounds):
        centroids = _moved(blocks, _assigned(blocks, centroids, width, shards), centroids, width, shards)
    assigned = _assigned(blocks, centroids, width, shards)
    summary = spark.createDataFrame(_summary(assigned, centroids), "number int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    ids = blocks.where("shard = 0").select("chunk", "ids")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                mine, *packed = (batch.column(i).slice(row, 1) for i in range(5))
                a, b, c, d = (p[0].as_py() for p in packed)
                columns = [mine.flatten(), pa.array(_unpacked(a, b)[:, 0], pa.int32()), pa.array(_unpacked(c, d)[:, 0], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    met = ids.join(assigned, "chunk").drop("chunk")
    rows = met.mapInArrow(spread, schema)
    # one row for each centroid
    return rows.join(F.broadcast(summary), rows.cluster == summary.number).drop("number")


def _summary(assigned: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, int, str]]:
    """Number, inertia, total inertia and hash of every centroid."""
    k = len(centroids)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c, d in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                mine, far = _unpacked(a, b)[:, 0], _unpacked(c, d)[:, 0]
                # in two halves, so that no sum of a chunk leaves a long
                for half, shift in ((far >> 32, 32), (far & 0xFFFFFFFF, 0)):
                    totals = np.zeros(k, np.int64)
                    np.add.at(totals, mine, half)
                    yield pa.RecordBatch.from_pydict({"number": pa.array(np.arange(k), pa.int32()), "shift": pa.array(np.full(k, shift), pa.int32()), "part": pa.array(totals)})

    parts = assigned.select("cluster_kind", "cluster", "distance_kind", "distance").mapInArrow(summed, "number int, shift int, part bigint")
    inertia = [0] * k
    for r in parts.groupBy("number", "shift").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
        inertia[r.number] += int(r.part) << r.shift
    total = min(sum(inertia), LONGEST)
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return [(i, min(inertia[i], LONGEST), total, hashes[i]) for i in range(k)]
