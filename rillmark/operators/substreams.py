"""Keyed substreams, delimiter-cut substreams and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def capped_counts(df: DataFrame, key: Column, max_keys: int) -> DataFrame:
    """Rows per key; an error if there are more than ``max_keys`` keys."""
    counts = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    keys = counts.limit(max_keys + 1).agg(F.count(F.lit(1))).scalar()
    guard = F.assert_true(keys <= max_keys, F.lit(f"more than {max_keys} substreams"))
    return counts.where(guard.isNull())


def flat_map_range(df: DataFrame, x: Column, ordered: bool) -> DataFrame:
    """Each x becomes x .. 3x; ``ordered`` keeps the place inside the range as ``place``."""
    values = F.sequence(x, x * 3)
    if ordered:
        return df.select("*", F.posexplode(values).alias("place", "value"))
    return df.select("*", F.explode(values).alias("value"))


def lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line with its number within the text."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def chars(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per character with its place within the text."""
    return df.where(F.length(text) > 0).select(
        *keep, F.posexplode(F.split(F.col(text), "", -1)).alias("place", "ch")
    )


def cut_at_newlines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Substreams of characters cut at every newline: number and size (newlines not counted).

    Cutting the text yields the substreams directly; the characters need not become rows.
    """
    return lines(df, text, *keep).select(
        *keep, F.col("line_no").alias("segment"), F.length("line").cast("bigint").alias("n_chars")
    )
