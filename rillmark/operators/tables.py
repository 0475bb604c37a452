"""Keyed tables kept as logs: lookups, upserts, deletes, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.operators.scan import OrderedScan, union_all


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key, by partial aggregation rather than a window over each key's history."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in insertion order."""
    rest = [c for c in df.columns if c not in keys]
    oldest = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return oldest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def compact(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column
) -> DataFrame:
    """Current table of a change log: last change per key, gone if it was a delete."""
    return latest(df.withColumn("_deleted", deleted), keys, order).where(~F.col("_deleted")).drop("_deleted")


def upsert(table: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert or replace by key; of several changes to a key the last one counts."""
    news = latest(changes, keys, order).select(*table.columns)
    return union_all([table.join(news.select(*keys), list(keys), "left_anti"), news])


def delete(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.join(changes.select(*keys).distinct(), list(keys), "left_anti")


def add_quantity(table: DataFrame, deltas: DataFrame, key: str, quantity: str) -> DataFrame:
    """Add summed deltas to existing rows; unknown ids come back with status ``AddFail``."""
    sums = deltas.groupBy(key).agg(F.sum(quantity).alias("_delta"))
    known = F.col("_table").isNotNull()
    joined = table.withColumn("_table", F.lit(True)).join(sums, key, "full")
    status = F.when(F.col("_delta").isNull(), "Unchanged").when(known, "AddSuccess").otherwise("AddFail")
    total = F.when(known, F.col(quantity) + F.coalesce("_delta", F.lit(0)))
    return joined.withColumns({"status": status, quantity: total}).drop("_delta", "_table")


def lookup(requests: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Requests with the table's columns, null where the key is unknown."""
    return requests.join(table, list(on), "left")


def authenticate(
    log: DataFrame, user: str, order: Sequence[str], kind: Column, password: str
) -> DataFrame:
    """Outcome of each attempt against the last password registered before it."""
    scan = OrderedScan(log.withColumn("_kind", kind), order, [user])
    scan = scan.before(_known=("last", F.when(F.col("_kind") == "register", F.col(password))))
    outcome = (
        F.when(F.col("_known").isNull(), "user not found")
        .when(F.col("_known") == F.col(password), "success")
        .otherwise("wrong pw")
    )
    attempts = scan.df.where(F.col("_kind") != "register")
    return attempts.withColumn("outcome", outcome).drop("_kind", "_known")
