"""Exact dedup by a sort of contents.

Rows are range-partitioned and sorted by their normalised text, so that equal texts stand side by side; each
text is compared whole with the one before it.  Spark's sampled splitters see the first bytes of a text, its
hash, its length and its id, so they stay small and cut even a group of equal texts into many partitions.
What such a cut separates is joined again by comparing the last text of a partition with the first of the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from rillmark.llm.base import stored

# fixed value: the characters that do not count
BLANKS = r"[\x20\x09-\x0D]+"
# bytes of a text that the splitters see beside its hash
HEAD = 32


def _sorted(docs: DataFrame, doc_id: str, text: str, carry: list[str]) -> DataFrame:
    """``id, digest, norm, row`` in the order of contents, of equal texts the one to keep first."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    carried = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row")] if carry else []
    keyed = docs.select(F.col(doc_id).alias("id"), F.regexp_replace(body, BLANKS, "").alias("norm"), F.length(body).alias("chars"), *carried)
    keyed = keyed.withColumn("digest", F.unhex(F.sha2("norm", 256))).withColumn("head", F.substring(F.col("norm").cast("binary"), 1, HEAD))
    # rows that are alike in all of this are told apart by a number, so that they too can be dealt to many tasks
    keyed = keyed.withColumn("nth", F.monotonically_increasing_id())
    best = [F.desc("chars"), F.asc_nulls_last("id"), F.asc("nth")]
    dealt = keyed.repartitionByRange("head", "digest", *best)
    return dealt.sortWithinPartitions("head", "digest", "norm", *best).select("id", "digest", "norm", *(["row"] if carry else []))


def _runs(docs: DataFrame, doc_id: str, text: str, carry: list[str], firsts_only: bool) -> DataFrame:
    """Every row (or the first of each run) with its run of equal texts within a partition.

    ``size, keep, first``: rows of the run, the id of its first row, and whether this is it.  The first and the
    last run of a partition may go on in another: they have ``part, piece``, and their first row the text.
    """
    kind = docs.schema[doc_id].dataType
    ordered = _sorted(docs, doc_id, text, carry)
    schema = StructType(
        [
            StructField("id", kind),
            StructField("digest", BinaryType()),
            *([ordered.schema["row"]] if carry else []),
            StructField("size", LongType()),
            StructField("keep", kind),
            StructField("first", BooleanType()),
            StructField("part", IntegerType()),
            StructField("piece", IntegerType()),
            StructField("edge", StringType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []  # the open run without its texts, which are all alike
        last_text, piece = None, 0

        def closed(rows: pa.RecordBatch, starts: np.ndarray, piece: int | None = None, edge: pa.Scalar | None = None) -> pa.RecordBatch:
            sizes = np.diff(np.append(starts, len(rows)))
            first = np.zeros(len(rows), bool)
            first[starts] = True
            columns = [
                *rows.columns,
                pa.array(np.repeat(sizes, sizes)),
                rows.column(0).take(pa.array(np.repeat(starts, sizes))),
                pa.array(first),
                pa.nulls(len(rows), pa.int32()) if piece is None else pa.array(np.full(len(rows), part, np.int32)),
                pa.nulls(len(rows), pa.int32()) if piece is None else pa.array(np.full(len(rows), piece, np.int32)),
                pa.nulls(len(rows), pa.string()) if edge is None else pa.array([edge.as_py()] + [None] * (len(rows) - 1), pa.string()),
            ]
            done = pa.RecordBatch.from_arrays(columns, names=schema.names)
            return done.filter(done.column("first")) if firsts_only else done

        def together(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]

        only = np.zeros(1, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            norm, rest = batch.column(2), batch.select([0, 1, *range(3, batch.num_columns)])
            fresh = np.ones(len(batch), bool)
            fresh[1:] = ~pc.equal(norm.slice(1), norm.slice(0, len(norm) - 1)).to_numpy(zero_copy_only=False)
            fresh[0] = last_text is not None and not last_text.equals(norm[0])
            starts = np.flatnonzero(fresh)
            if len(starts):
                if starts[0]:
                    held.append(rest.slice(0, starts[0]))
                yield closed(together(held), only, 0 if piece == 0 else None, norm[int(starts[0]) - 1] if piece == 0 and starts[0] else last_text if piece == 0 else None)
                piece, inner = 1, rest.slice(starts[0], starts[-1] - starts[0])
                if len(inner):
                    yield closed(inner, starts[:-1] - starts[0])
                held = []
            held.append(rest.slice(starts[-1]) if len(starts) else rest)
            last_text = norm[len(norm) - 1]
        if held:
            yield closed(together(held), only, piece, last_text)

    return ordered.mapInArrow(cut, schema)


def _joined(runs: DataFrame) -> DataFrame:
    """``part, piece, whole, whole_keep, goes_on`` for the runs at the edges of partitions: two a partition at most."""
    edges = runs.where("edge IS NOT NULL").select("part", "piece", "size", "keep", "edge")
    # numbers alone pass through one task, the texts meet in a join
    numbered = edges.select("part", "piece").withColumn("nr", F.row_number().over(Window.orderBy("part", "piece")))
    edges = edges.join(numbered, ["part", "piece"])
    before = edges.select((F.col("nr") + 1).alias("nr"), F.col("edge").alias("edge_before"))
    same = edges.join(before, "nr", "left").select(
        "nr", "part", "piece", "size", "keep", F.coalesce(F.col("edge") == F.col("edge_before"), F.lit(False)).alias("goes_on")
    )
    grouped = same.withColumn("run", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(Window.orderBy("nr")))
    whole = grouped.groupBy("run").agg(F.sum("size").alias("whole"), F.min_by("keep", "nr").alias("whole_keep"))
    return grouped.join(whole, "run").select("part", "piece", "whole", "whole_keep", "goes_on")


def _marked(docs: DataFrame, doc_id: str, text: str, carry: list[str], firsts_only: bool) -> DataFrame:
    runs = stored(_runs(docs, doc_id, text, carry, firsts_only), "content-runs")
    edges = F.broadcast(_joined(runs))
    inner = F.col("whole").isNull()
    return runs.join(edges, ["part", "piece"], "left").withColumns(
        {
            "keep": F.when(inner, F.col("keep")).otherwise(F.col("whole_keep")),
            "size": F.when(inner, F.col("size")).otherwise(F.col("whole")),
            "kept": F.col("first") & ~F.coalesce(F.col("goes_on"), F.lit(False)),
        }
    )


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.

    Texts are equal when they are identical without blanks (space, tab, line ends).  Of equal texts the row with
    the most code points stays, then the smallest id; a null id comes last.  Of rows that repeat id and text
    one stays.  A null text counts as empty, and all that are empty without blanks are one group.  An empty
    table gives no rows; columns other than id and text are not read.
    """
    marked = _marked(docs, doc_id, text, [], False)
    return marked.select(
        F.col("id").alias(doc_id), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay by ``report``, with all their columns as they were."""
    kept = _marked(docs, doc_id, text, docs.columns, True).where("kept")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
