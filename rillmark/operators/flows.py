"""Limits, batches, stream results, fan-in and fan-out over ordered tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from rillmark.operators.scan import join_same, union_all, with_position

SORT_LIMIT = 100_000


def take(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def drop(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Rows after the first ``n``.

    ``offset`` alone would move the table into one task.  For a small ``n`` the order value of row
    ``n`` is found by a top-n and compared in place; a large ``n`` uses positions.
    """
    if n <= 0:
        return df
    if n > SORT_LIMIT:
        return with_position(df, order, name="_pos").where(F.col("_pos") >= n).drop("_pos")
    cut = df.select(*order).orderBy(*order).limit(n).agg(F.max(F.struct(*order)))
    return df.where(F.struct(*order) > cut.scalar())


def _guarded(result: Column, what: str, strict: bool) -> Column:
    """The result, or an error instead of null when there was no row and ``strict`` is set."""
    if not strict:
        return result
    return F.when(F.count(F.lit(1)) == 0, F.raise_error(F.lit(f"{what} of an empty stream"))).otherwise(result)


def head(
    df: DataFrame, order: Sequence[str], value: Column, keys: Sequence[str] = (), strict: bool = False
) -> DataFrame:
    """First value in order (per key); no row, or null without keys, when the input is empty."""
    first = F.min_by(value, F.struct(*order))
    return df.groupBy(*keys).agg(_guarded(first, "head", strict).alias("value"))


def last(
    df: DataFrame, order: Sequence[str], value: Column, keys: Sequence[str] = (), strict: bool = False
) -> DataFrame:
    """Last value in order (per key), with the same rule for empty input."""
    final = F.max_by(value, F.struct(*order))
    return df.groupBy(*keys).agg(_guarded(final, "last", strict).alias("value"))


def fold_sum(df: DataFrame, value: Column, zero: int = 0, keys: Sequence[str] = ()) -> DataFrame:
    """Sum that starts from ``zero``; an empty input gives ``zero``."""
    return df.groupBy(*keys).agg((F.coalesce(F.sum(value), F.lit(0)) + F.lit(zero)).alias("value"))


def reduce_rows(df: DataFrame, reducer: Column, strict: bool = False) -> DataFrame:
    """Reduce without a zero: null on empty input, or an error when ``strict``."""
    return df.agg(_guarded(reducer, "reduce", strict).alias("value"))


def batches(df: DataFrame, order: Sequence[str], value: str, size: int) -> DataFrame:
    """Groups of ``size`` rows in arrival order, the rest at the end; no group exceeds ``size``."""
    placed = with_position(df.select(*dict.fromkeys([*order, value])), order)
    grouped = placed.groupBy(F.floor(F.col("pos") / size).alias("batch_id")).agg(
        F.array_sort(F.collect_list(F.struct("pos", value))).alias("_rows")
    )
    return grouped.select("batch_id", F.col(f"_rows.{value}").alias("items"))


def count_tap(df: DataFrame, name: str = "tap") -> tuple[DataFrame, Observation]:
    """The same rows plus an observation whose ``n`` holds the row count after the run."""
    tap = Observation(name)
    return df.observe(tap, F.count(F.lit(1)).alias("n")), tap


def zip_rows(left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]) -> DataFrame:
    """Pair the i-th rows; stops at the shorter input."""
    return with_position(left, left_order).join(with_position(right, right_order), "pos")


def concat(frames: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """All of the first frame, then all of the second, with ``src_ord`` and the joint position ``pos``."""
    parts, shift = [], F.lit(0).cast("bigint")
    for i, (df, order) in enumerate(frames):
        placed = with_position(df, order).withColumn("pos", F.col("pos") + shift)
        parts.append(placed.withColumn("src_ord", F.lit(i)))
        shift = shift + df.agg(F.count(F.lit(1))).scalar()
    return union_all(parts)


def merge(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union; also valid for streams."""
    return union_all(frames)


def merge_preferred(
    preferred: tuple[DataFrame, Sequence[str]], other: tuple[DataFrame, Sequence[str]]
) -> DataFrame:
    """Interleave two inputs: in each slot the preferred one goes first.

    ``emit_pos`` follows from a row's own position and the other side's length, so no common sort.
    """
    rows = {True: preferred, False: other}
    sizes = {side: df.agg(F.count(F.lit(1))).scalar() for side, (df, _) in rows.items()}
    parts = []
    for side, (df, order) in rows.items():
        ahead = F.col("slot") + F.lit(0 if side else 1)
        parts.append(
            with_position(df, order, name="slot")
            .withColumn("emit_pos", F.col("slot") + F.least(ahead, sizes[not side]))
            .withColumn("preferred", F.lit(side))
        )
    return union_all(parts)


def balance(df: DataFrame, order: Sequence[str], lanes: int) -> DataFrame:
    """Each row goes to exactly one lane in turn; ``lane_n`` counts the rows of its lane so far."""
    placed = with_position(df, order)
    return placed.withColumn("lane", F.col("pos") % lanes).withColumn(
        "lane_n", F.floor(F.col("pos") / lanes) + 1
    )


def tee(df: DataFrame, *branches: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, ...]:
    """Feed one frame to several branches."""
    return tuple(df.transform(branch) for branch in branches)


def tee_write(df: DataFrame, sinks: dict[str, Column], path: str) -> dict[str, DataFrame]:
    """Write one frame to several tables, each with the rows of its condition; the input is computed once.

    A row goes out once for each sink that takes it, and one writer puts the sinks into folders of their own.
    """
    taken = F.array_compact(F.array(*[F.when(condition, name) for name, condition in sinks.items()]))
    routed = df.withColumn("sink", F.explode(taken))
    routed.write.partitionBy("sink").parquet(path)
    table = df.sparkSession.read.schema(routed.schema).parquet(path)
    return {name: table.where(F.col("sink") == name).drop("sink") for name in sinks}


def route_to_all(df: DataFrame, routees: Sequence[str]) -> DataFrame:
    """Every row once per routee of a fixed list."""
    return df.withColumn("routee", F.explode(F.array(*map(F.lit, routees))))


def round_robin(position: Column, workers: int) -> Column:
    return F.pmod(position, F.lit(workers))


def random_slot(workers: Column, *row_id: Column) -> Column:
    """A random one of ``workers`` slots, drawn from the row's id so that a rerun draws the same."""
    digest = F.md5(F.concat_ws(":", *row_id))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % workers


# up to this many rows a key are trimmed by the tasks before the shuffle
TRIM_ROWS = 1000


def newest(df: DataFrame, order: Sequence[str], n: int, keys: Sequence[str]) -> DataFrame:
    """The last ``n`` rows per key, with ``age_rank`` from 1; up to ``TRIM_ROWS`` the tasks trim their rows before the shuffle.

    More rows of a key are found by position, as in every scan, so that a heavy key is not one task's.
    """
    if n <= TRIM_ROWS:
        window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        return df.withColumn("age_rank", F.row_number().over(window)).where(F.col("age_rank") <= n)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    placed = join_same(with_position(df, order, keys, "_pos"), sizes, keys)
    return placed.withColumn("age_rank", F.col("_size") - F.col("_pos")).where(F.col("age_rank") <= n).drop("_size", "_pos")


def throttle(df: DataFrame, order: Sequence[str], n: int, interval_s: int) -> DataFrame:
    """At most ``n`` rows per interval: ``release_s`` is when a row leaves, counted from the start."""
    placed = with_position(df, order)
    return placed.withColumn("release_s", F.floor(F.col("pos") / n) * interval_s)


def process_order(df: DataFrame, rank: Column, order: Sequence[str], ranks: int) -> DataFrame:
    """Processing position when lower ``rank`` (0 .. ranks - 1) goes first and ties keep arrival order.

    Positions are taken within each rank and shifted by the sizes of the ranks before it, so neither
    a global sort nor a task per rank is needed.
    """
    ranked = df.withColumn("rank", rank.cast("int"))
    sizes = ranked.agg(
        F.array(*[F.count_if(F.col("rank") < r) for r in range(ranks)])
    ).scalar()
    placed = with_position(ranked, order, keys=["rank"], name="process_pos")
    return placed.withColumn("process_pos", F.col("process_pos") + F.get(sizes, F.col("rank")))


def seeded_scan(running: DataFrame, keys: Sequence[str], value: str, zero: int) -> DataFrame:
    """Add the seed row that a running fold emits first, once per key."""
    seeds = running.select(*keys).distinct().withColumn(value, F.lit(zero).cast(running.schema[value].dataType))
    return union_all([seeds, running])
