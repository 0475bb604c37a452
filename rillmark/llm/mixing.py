"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only.

Every source has a weight that changes linearly over the training time 0 ... 1.  Its integral is the
share of the source's target demanded so far; a document's place in the cumulative tokens of its
source, put through the inverse, is its training position.  Documents are then range-sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.base import stored

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
# weight at the start and at the end of training, repeating over the sources like WEIGHTS
SCHEDULE = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def _cycled(rank: Column, values: tuple) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (rank % len(values) + 1).cast("int"))


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` to the same with ``rank, weight, target``: water-filling up to the caps.

    Sources are taken by the ratio of cap to weight; the first whose cap is not below its share of
    what the earlier ones leave sets the level that all later sources get.  The table has one row per
    source, so a window over all of it stays small.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", _cycled(F.col("rank"), WEIGHTS))
    ranked = ranked.withColumn("cap", MOST * F.col("source_size"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn(
        "level", (F.sum("source_size").over(everything) * F.lit(SHARE) - before) / left
    )
    free = F.col("cap") >= F.col("level") * F.col("weight")
    first = F.min(F.when(free, F.struct((F.col("cap") / F.col("weight")).alias("r"), "rank", "level"))).over(everything)
    return levels.withColumn(
        "target", F.least(F.col("cap").cast("double"), F.coalesce(first["level"] * F.col("weight"), F.col("cap").cast("double")))
    ).select("source", "source_size", "rank", "weight", "target")


def _before(rows: DataFrame, keys: list[str], order: list[str], size: str) -> Column:
    ahead = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(ahead), F.lit(0))


def _cumulative(rows: DataFrame) -> DataFrame:
    """Adds ``ahead``: words of the same source before the row, in the order of ``mix, size``.

    A source may hold a third of all rows: its sums run over 256 blocks of the hash, then over the 256
    parts of each, then over the rows of a part, so that no window grows with the source.
    """
    fine = rows.groupBy("rank", "part").agg(F.sum("size").alias("words")).withColumn("block", F.substring("part", 1, 2))
    coarse = fine.groupBy("rank", "block").agg(F.sum("words").alias("words"))
    coarse = coarse.select("rank", "block", _before(coarse, ["rank"], ["block"], "words").alias("ahead_block"))
    fine = fine.select("rank", "block", "part", _before(fine, ["rank", "block"], ["part"], "words").alias("ahead_part"))
    offsets = fine.join(coarse, ["rank", "block"]).select(
        "rank", "part", (F.col("ahead_block") + F.col("ahead_part")).alias("offset")
    )
    joined = rows.join(offsets, ["rank", "part"])
    return joined.withColumn("ahead", F.col("offset") + _before(joined, ["rank", "part"], ["mix", "size"], "size"))


def _taken(ahead: Column, size: Column, limit: Column) -> Column:
    return F.greatest(F.lit(0), F.least(ahead + size, limit) - ahead)


def _moment(share: Column, start: Column, end: Column) -> Column:
    """The time by which a source whose weight runs from ``start`` to ``end`` has met that share of its demand."""
    root = F.sqrt(start * start + (end * end - start * start) * share)
    return F.when(start + root > 0, share * (start + end) / (start + root)).otherwise(F.lit(0.0))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: id, size, source size and target, ``taken`` words and the training ``positions`` of its copies.

    Within a source, documents come in the order of the MD5 of their id and text.  The source is read once, and
    up to once more, until its target (rounded down) is met; the last copy may be taken in part, so the
    taken words of a source are its whole target.  A null source is a source of its own, last in order;
    a null text has size 0, takes nothing and has no position; a null id counts as the empty text;
    repeated rows are rows of their own, and which of them is cut makes no difference.  An empty table
    gives no rows.  Other columns are not read.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("bigint")
    # the text is part of it, so that rows without an id, or under one, are spread as well
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text).cast("string"), F.lit(""))))
    rows = stored(docs.select(F.col(doc_id), F.col(source).alias("source"), size.alias("size"), key.alias("mix")), "sizes")
    goals = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    named = goals.withColumnsRenamed({"source": "goal_source"})
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source", "source", "weight")
    placed = _cumulative(rows.withColumn("part", F.substring("mix", 1, 4)))
    limit = F.floor("target")
    once = _taken(F.col("ahead"), F.col("size"), limit)
    twice = _taken(F.col("source_size") + F.col("ahead"), F.col("size"), limit)
    placed = placed.withColumn("once", once).withColumn("twice", twice)
    start, end = _cycled(F.col("rank"), tuple(a for a, _ in SCHEDULE)), _cycled(F.col("rank"), tuple(b for _, b in SCHEDULE))
    first = _moment((F.col("ahead") + F.col("once") / 2) / limit, start, end)
    second = _moment((F.col("source_size") + F.col("ahead") + F.col("twice") / 2) / limit, start, end)
    positions = F.filter(
        F.array(F.when(F.col("once") > 0, first), F.when(F.col("twice") > 0, second)), lambda p: p.isNotNull()
    )
    return placed.select(
        doc_id, "size", "source_size", "target", (F.col("once") + F.col("twice")).alias("taken"), positions.alias("positions")
    )


def in_training_order(mixed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows range-sorted by their first position; rows that are not taken come last."""
    first = F.element_at(F.when(F.size("positions") > 0, F.col("positions")), 1)
    return mixed.orderBy(first.asc_nulls_last(), F.col(doc_id).asc_nulls_last())
