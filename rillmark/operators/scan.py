"""Running folds over an ordered, optionally keyed log.

Every ordered operator of the package (running totals, positions, forward fill, gap detection,
segment numbers) is a prefix fold.  A window over the key does it with one shuffle, and keys of an
ordinary size are always folded that way.  But a window puts all rows of a key into one task, so the
rows of heavy keys (or of a log without keys) are taken apart first:

1. counts per key over a sample find the keys with more rows than a task should hold; they are a stored
   table, broadcast to mark their rows, and are fewer than the table has tasks' worth of rows;
2. the heavy rows are range-partitioned by (key, order), whatever types these have, into chunks of about a
   task's rows, and written down, so that a recomputed task finds each row in the same chunk again;
3. a window folds inside (key, chunk);
4. only the first and the last key of a chunk can have rows in other chunks too.  Of these, each chunk is
   summarised to one row a key, the summaries are folded over the chunks, and the result (the carry, two
   rows a chunk at most) is broadcast and joined back.

A fold over the result of an earlier fold reads its input twice; for heavy logs that input is first
written to the shared scratch folder, so the work grows linearly with the folds.
Inputs below ``spark.rillmark.scan.smallBytes`` skip the search if their plan cannot multiply rows: any one
task can hold them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.session import multiplies_rows, plan_bytes, scratch

# files are compressed: a megabyte can hold a million narrow rows, and each takes some 100 bytes and more when sorted
SMALL_BYTES = ("spark.rillmark.scan.smallBytes", 4 * 1024 * 1024)
# sorted and buffered by a window, a row with a few strings takes some 700 bytes
TASK_ROWS = ("spark.rillmark.scan.taskRows", 500_000)

# rows that the sample has of a key with as many rows as a task should hold
_KEY_SAMPLE = 2000
_CHUNK = "_chunk"

Folds = dict[str, tuple[str, Column]]


def _setting(spark: SparkSession, option: tuple[str, int]) -> int:
    return int(spark.conf.get(option[0], str(option[1])))


def task_rows(spark: SparkSession) -> int:
    """How many rows of one key a task should hold."""
    return _setting(spark, TASK_ROWS)


def is_small(df: DataFrame) -> bool:
    """Whether one task could hold the whole frame; not known of plans that may multiply rows."""
    limit = _setting(df.sparkSession, SMALL_BYTES)
    return limit > 0 and plan_bytes(df) <= limit and not multiplies_rows(df)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from a table in the scratch folder."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Layout:
    """Which logs are heavy (a stored table of keys; ``None``: the one log without keys), and their number of chunks."""

    heavy: DataFrame | None
    chunks: int


def find_layout(df: DataFrame, keys: Sequence[str]) -> Layout | None:
    """How to take the heavy logs of a frame apart; ``None`` if windows over the keys will do."""
    if is_small(df):
        return None
    most = task_rows(df.sparkSession)
    if not keys:
        rows = df.count()
        return Layout(None, ceil(rows / most)) if rows > most else None
    # heavy keys stand out in a sample; a key misjudged near the limit costs balance, never rows
    share = min(1.0, _KEY_SAMPLE / most)
    counts = df.select(*keys).sample(share, seed=7).groupBy(*keys).agg((F.count(F.lit(1)) / share).alias("_n"))
    heavy = counts.where(F.col("_n") > most)
    rows = heavy.agg(F.sum("_n")).first()[0]
    return None if rows is None else Layout(written(heavy.drop("_n"), "heavy-keys"), max(2, ceil(rows / most)))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null, as in a grouping; keeps the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    return left.join(renamed, same, how).drop(*[f"_of_{k}" for k in keys])


class OrderedScan:
    """A log, its keys and its total order, to which running columns are added.

    ``order`` must be a total order within a key.  A scan over a frame derived from an earlier one may take over
    that one's ``layout``.
    """

    def __init__(
        self,
        df: DataFrame,
        order: Sequence[str],
        keys: Sequence[str] = (),
        layout: Layout | None | str = "find",
    ) -> None:
        self.order, self.keys = list(order), list(keys)
        self.layout = find_layout(df, self.keys) if layout == "find" else layout
        self._plain: DataFrame | None = df
        self._heavy: DataFrame | None = None
        self._folded = False
        if self.layout is not None:
            self._take_apart(df, self.layout)

    def _take_apart(self, df: DataFrame, layout: Layout) -> None:
        if layout.heavy is None:
            self._plain, logs = None, df
        else:
            # a key of the table has more rows than a task should hold
            marks = F.broadcast(layout.heavy)
            self._plain = join_same(df, marks, self.keys, "left_anti")
            logs = join_same(df, marks, self.keys, "left_semi")
        dealt = logs.repartitionByRange(layout.chunks, *self.keys, *self.order)
        self._heavy = written(dealt.withColumn(_CHUNK, F.spark_partition_id()), "chunks")

    def _each(self, change: Callable[[DataFrame], DataFrame]) -> OrderedScan:
        self._plain = None if self._plain is None else change(self._plain)
        self._heavy = None if self._heavy is None else change(self._heavy)
        return self

    @property
    def df(self) -> DataFrame:
        parts = [self._plain, None if self._heavy is None else self._heavy.drop(_CHUNK)]
        return union_all([part for part in parts if part is not None])

    def table(self) -> DataFrame:
        """Like ``df``, but written out if logs were taken apart, for results that are read repeatedly."""
        return self.df if self._heavy is None else written(self.df, "scan")

    def let(self, **columns: Column) -> OrderedScan:
        """Add plain columns, to be used by later folds."""
        return self._each(lambda df: df.withColumns(columns))

    def where(self, condition: Column) -> OrderedScan:
        return self._each(lambda df: df.where(condition))

    def upto(self, **folds: tuple[str, Column]) -> OrderedScan:
        """Add running columns that include the current row: ``total=("sum", F.col("x"))``."""
        return self.fold(upto=folds)

    def before(self, **folds: tuple[str, Column]) -> OrderedScan:
        """Add running columns over the rows strictly before the current one."""
        return self.fold(before=folds)

    def fold(self, upto: Folds | None = None, before: Folds | None = None) -> OrderedScan:
        """Add running columns of both sorts in one pass."""
        spans = {"upto": upto or {}, "before": before or {}}
        if self._plain is not None:
            plain = self._plain
            local = self._local(plain, self.keys, spans)
            self._plain = self._finish(local, plain.columns, spans, lambda name: F.lit(None))
        if self._heavy is not None:
            heavy = written(self._heavy, "scan") if self._folded else self._heavy
            by = [*self.keys, _CHUNK]
            # a chunk or two a task (bounds are sampled): left to AQE, chunks meet in a task until their compressed bytes reach its target
            apart = heavy.repartitionByRange(self.layout.chunks, _CHUNK)
            carried = join_same(self._local(apart, by, spans), F.broadcast(self._carry(heavy, spans)), by, "left")
            self._heavy = self._finish(carried, heavy.columns, spans, lambda name: F.col(f"_carry_{name}"))
        self._folded = True
        return self

    def _local(self, df: DataFrame, by: list[str], spans: dict[str, Folds]) -> DataFrame:
        columns = []
        for span, end in (("upto", 0), ("before", -1)):
            window = Window.partitionBy(*by).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, end)
            columns += [_WINDOW[kind](v).over(window).alias(f"_in_{name}") for name, (kind, v) in spans[span].items()]
        return df.select("*", *columns)

    def _carry(self, heavy: DataFrame, spans: dict[str, Folds]) -> DataFrame:
        folds, order = {**spans["upto"], **spans["before"]}, F.struct(*self.order)
        if self.keys:
            key = F.struct(*self.keys)
            ends = heavy.groupBy(_CHUNK).agg(F.min(key).alias("first"), F.max(key).alias("last"))
            at_ends = ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("key"))
            spread = at_ends.groupBy("key").count().where("count > 1").select("key.*")
            heavy = join_same(heavy, F.broadcast(spread), self.keys, "left_semi")
        parts = heavy.groupBy(*self.keys, _CHUNK).agg(
            *[_PARTIAL[kind](value, order).alias(f"_part_{name}") for name, (kind, value) in folds.items()]
        )
        # one row a chunk of each key
        earlier = Window.partitionBy(*self.keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        merged = [_MERGE[kind](F.col(f"_part_{name}")).over(earlier) for name, (kind, _) in folds.items()]
        carries = [m.alias(f"_carry_{n}") for m, n in zip(merged, folds, strict=True)]
        return parts.select(*self.keys, _CHUNK, *carries)

    @staticmethod
    def _finish(
        local: DataFrame, kept: list[str], spans: dict[str, Folds], carry: Callable[[str], Column]
    ) -> DataFrame:
        folds = {**spans["upto"], **spans["before"]}
        final = [
            _combine(kind, F.col(f"_in_{name}"), carry(name)).alias(name) for name, (kind, _) in folds.items()
        ]
        return local.select(*[c for c in kept if c not in folds], *final)


def _last(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


def _first(value: Column) -> Column:
    return F.first(value, ignorenulls=True)


_WINDOW = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "last": _last, "first": _first}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "last": _last, "first": _first}
_PARTIAL = {
    "sum": lambda v, o: F.sum(v),
    "count": lambda v, o: F.count(v),
    "min": lambda v, o: F.min(v),
    "max": lambda v, o: F.max(v),
    "last": lambda v, o: F.max_by(v, F.when(v.isNotNull(), o)),
    "first": lambda v, o: F.min_by(v, F.when(v.isNotNull(), o)),
}


def _combine(kind: str, here: Column, carry: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0))
    if kind == "min":
        return F.least(here, carry)
    if kind == "max":
        return F.greatest(here, carry)
    return F.coalesce(here, carry) if kind == "last" else F.coalesce(carry, here)


def with_position(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "pos", start: int = 0
) -> DataFrame:
    """Dense index in arrival order, per key or over the whole table, without one global sort task."""
    scan = OrderedScan(df, order, keys).upto(**{name: ("count", F.lit(1))})
    return scan.df.withColumn(name, F.col(name) + F.lit(start - 1))


_BLOCK = 4096
_LEVELS = 4


def ordered_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    element: Column,
    zero: Column,
    combine: Callable[[Column, Column], Column],
) -> DataFrame:
    """Combine the elements of each key in order into one ``value``; ``combine`` must be associative.

    Rows are numbered per key and combined in blocks of ``_BLOCK`` consecutive rows, then blocks of
    block results, and so on, so no task ever gathers much more than one block of a key.  Input that
    one task can hold takes a single level, keys of ordinary size take two.
    """
    scan = OrderedScan(df.select(*dict.fromkeys([*keys, *order]), element.alias("_e")), order, keys)
    level = scan.upto(_i=("count", F.lit(1))).df
    levels = 1 if is_small(df) else 2 if scan.layout is None else _LEVELS
    for depth in range(levels):
        block = F.lit(0).cast("bigint") if depth == levels - 1 else F.floor(F.col("_i") / _BLOCK)
        rows = F.array_sort(F.collect_list(F.struct("_i", "_e")))
        level = (
            level.groupBy(*keys, block.alias("_block"))
            .agg(rows.alias("_rows"))
            .select(
                *keys,
                F.col("_block").alias("_i"),
                F.aggregate("_rows", zero, lambda acc, row: combine(acc, row["_e"])).alias("_e"),
            )
        )
    return level.select(*keys, F.col("_e").alias("value"))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
