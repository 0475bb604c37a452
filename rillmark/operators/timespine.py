"""Rates and clocks: bursts, gap filling on a fixed tick, heartbeats, idle sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.operators.scan import OrderedScan, join_same


def conflate(
    df: DataFrame, keys: Sequence[Column], order: Sequence[str], instances: Column, description: Column
) -> DataFrame:
    """Collapse each burst into one row; a burst of one keeps its own description."""
    n = F.sum(instances)
    return df.groupBy(*keys).agg(
        n.alias("n_instances"),
        F.when(F.count(F.lit(1)) == 1, F.min_by(description, F.struct(*order)))
        .otherwise(F.concat(F.lit("You have "), n.cast("string"), F.lit(" events")))
        .alias("description"),
    )


SPINE = 10_000


def numbered(df: DataFrame, n: Column, name: str) -> DataFrame:
    """Each row ``n`` times (not at all below one), with its number from 0.

    Rows expand in two levels, into blocks and then within them, so that no array has more than ``SPINE`` numbers up
    to a square of that, however long the life of a key is.
    """
    blocks = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / SPINE)))
    spread = df.withColumn("_end_no", n.cast("bigint") - 1).withColumn("_block_no", F.explode(blocks))
    first = F.col("_block_no") * SPINE
    inner = F.sequence(first, F.least(F.col("_end_no"), first + (SPINE - 1)))
    return spread.select(*df.columns, F.explode(inner).alias(name))


def fill_ticks(
    df: DataFrame, keys: Sequence[str], ts_us: str, order: Sequence[str], value: str, step_us: int
) -> DataFrame:
    """One row per key and tick from the key's first to its last tick.

    ``value`` is the newest one up to the tick (repeat), ``counted`` counts up from it: the first
    filled tick repeats it, the next adds one.  ``is_filled`` marks ticks without an event of their
    own.  Events are first reduced to one row per tick, so a key has no more rows than ticks; each of
    them then expands into itself and the ticks since the one before, without a join against a spine.
    """
    tick = F.floor(F.col(ts_us) / step_us) * step_us
    ticks = df.groupBy(*keys, tick.alias("_tick")).agg(F.max_by(F.col(value), F.struct(*order)).alias("value"))
    # a struct, so that a value of null is remembered too
    before = F.struct(F.col("_tick").alias("tick"), F.col("value").alias("value"))
    scan = OrderedScan(ticks, ["_tick"], keys).before(_before=("last", before))
    apart = F.coalesce(F.floor((F.col("_tick") - F.col("_before.tick")) / step_us), F.lit(1))
    filled = numbered(scan.df, apart, "_j")
    own = F.col("_j") == 0
    repeated = F.when(own, F.col("value")).otherwise(F.col("_before.value"))
    return filled.select(
        *keys,
        F.when(own, F.col("_tick")).otherwise(F.col("_before.tick") + F.col("_j") * step_us).alias("tick_us"),
        repeated.alias("value"),
        (repeated + F.greatest(F.col("_j") - 1, F.lit(0))).alias("counted"),
        (~own).alias("is_filled"),
    )


def missing_beats(
    df: DataFrame, keys: Sequence[str], ts_us: str, delay_us: int, period_us: int
) -> DataFrame:
    """Expected beats of each key without an event in their period.

    Beats run from the key's first event plus ``delay_us`` in steps of ``period_us`` up to its last
    event; a beat at b expects an event in [b, b + period).
    """
    lives = df.groupBy(*keys).agg(F.min(ts_us).alias("_start"), F.max(ts_us).alias("_end"))
    first_beat = F.col("_start") + delay_us
    n = F.floor((F.col("_end") - first_beat) / period_us) + 1
    beats = numbered(lives.withColumn("_n", n), F.col("_n"), "beat_no").select(
        *keys, "beat_no", (first_beat + F.col("beat_no") * period_us).alias("beat_us")
    )
    starts = lives.select(*keys, first_beat.alias("_first"))
    seen = (
        join_same(df.select(*keys, ts_us), starts, keys)
        .where(F.col(ts_us) >= F.col("_first"))
        .select(*keys, F.floor((F.col(ts_us) - F.col("_first")) / period_us).alias("beat_no"))
        .distinct()
    )
    return join_same(beats, seen, [*keys, "beat_no"], "left_anti")


def sessions(df: DataFrame, keys: Sequence[str], ts_us: str, order: Sequence[str], idle_us: int) -> DataFrame:
    """Sessions per key: a silence longer than ``idle_us`` starts a new one, an equal one does not."""
    scan = OrderedScan(df.select(*dict.fromkeys([*keys, ts_us, *order])), order, keys)
    scan = scan.before(_prev=("last", F.col(ts_us)))
    scan = scan.upto(session_no=("count", F.when(F.col(ts_us) - F.col("_prev") > idle_us, 1)))
    return scan.df.groupBy(*keys, "session_no").agg(
        F.min(ts_us).alias("start_us"),
        F.max(ts_us).alias("last_us"),
        F.count(F.lit(1)).alias("n_events"),
    )


def until_silence(
    df: DataFrame, keys: Sequence[str], ts_us: str, order: Sequence[str], idle_us: int
) -> DataFrame:
    """All rows with ``closed``: true from the first row that follows a silence longer than ``idle_us``."""
    scan = OrderedScan(df, order, keys).before(_prev=("last", F.col(ts_us)))
    scan = scan.upto(_gaps=("count", F.when(F.col(ts_us) - F.col("_prev") > idle_us, 1)))
    return scan.df.withColumn("closed", F.col("_gaps") > 0).drop("_prev", "_gaps")
