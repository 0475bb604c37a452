"""Append-only event journal with indexes, snapshots and compaction, in tables of any Spark file format."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rillmark.operators.scan import OrderedScan, join_same, task_rows, union_all, with_position, written
from rillmark.session import folders, multiplies_rows

# rows of one bucket; small batches get one bucket, large ones up to the store's number
BUCKET_ROWS = 1_000_000


@dataclass(frozen=True)
class Part:
    """One live folder of events: an appended batch, or several that were merged."""

    part: str
    first_batch: int
    last_batch: int
    first_ordering: int
    last_ordering: int
    n: int
    buckets: int
    added: int


_PART = T.StructType([T.StructField(f.name, {"part": T.StringType(), "buckets": T.IntegerType()}.get(f.name, T.LongType())) for f in fields(Part)])
MANIFEST = T.StructType([*_PART.fields, T.StructField("version", T.LongType())])


class Journal:
    """Events by entity with gapless sequence numbers per entity and a global ordering.

    Layout: events in ``part=<p>/pid_bucket=<b>``; beside them, with the same parts, the *heads* (the last numbers per
    entity) and the *tag index* (tag, ordering).  A part is live once a version of the *manifest* lists it, and
    each version is one folder that is written whole.  So a batch is appended by one step, whatever was lost
    before it is written again, and a merge is swapped in by one step.  Reads take the parts from the newest version,
    which is a row a part and, after ``compact``, few rows.  One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, fmt: str = "parquet", buckets: int = 64, bucket_rows: int = BUCKET_ROWS
    ) -> None:
        self.spark, self.path, self.fmt, self.buckets, self.bucket_rows = spark, path, fmt, buckets, bucket_rows
        self.heads, self.tags, self.manifest = (f"{path}-{name}" for name in ("heads", "tags", "manifest"))
        # a version of the manifest never changes, nor do the columns of a store
        self._known: tuple[int, list[Part]] = (0, [])
        self._schemas: dict[str, T.StructType] = {}

    # the manifest

    def version(self) -> int:
        """The newest published version; 0 before the first batch."""
        for name in sorted(folders(self.spark, self.manifest), reverse=True):
            # without a committed file the run that wrote it was lost
            if any(f.startswith("part-") for f in folders(self.spark, f"{self.manifest}/{name}")):
                return int(name.removeprefix("version="))
        return 0

    def live(self) -> list[Part]:
        """The live parts in order, a row each."""
        version = self.version()
        if version != self._known[0]:
            rows = self.spark.read.schema(_PART).parquet(f"{self.manifest}/version={version:012d}").collect()
            self._known = version, sorted((Part(**row.asDict()) for row in rows), key=lambda p: p.first_batch)
        return list(self._known[1])

    def _publish(self, version: int, parts: Sequence[Part]) -> None:
        rows = self.spark.createDataFrame(pa.Table.from_pylist([vars(p) for p in parts], to_arrow_schema(_PART)))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.manifest}/version={version:012d}")

    # parts

    def _bucket(self, persistence_id: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(persistence_id), F.lit(buckets)).cast("int")

    def _load(self, root: str, fmt: str, parts: Sequence[Part]) -> DataFrame:
        names = [f"{root}/part={p.part}" for p in parts if p.n]
        if not names:
            raise ValueError(f"nothing has been appended to {self.path} yet")
        reader = self.spark.read.format(fmt).option("basePath", root)
        if root not in self._schemas:
            self._schemas[root] = reader.load(names[:1]).schema
        return reader.schema(self._schemas[root]).load(names)

    def _write_part(self, name: str, rows: DataFrame, n: int) -> Part:
        """Events (with their numbers) as one part with its heads and tags; not live before it is published."""
        buckets = max(1, min(self.buckets, -(-n // self.bucket_rows)))
        placed = rows.withColumn("pid_bucket", self._bucket(F.col("persistence_id"), buckets))
        # sorted files: row-group statistics prune reads of one entity inside its bucket
        by_entity = placed.hint("rebalance", "pid_bucket").sortWithinPartitions("pid_bucket", "persistence_id", "sequence_number")
        by_entity.write.format(self.fmt).mode("overwrite").partitionBy("pid_bucket").save(f"{self.path}/part={name}")
        written = self.spark.read.format(self.fmt).load(f"{self.path}/part={name}")
        heads = written.groupBy("persistence_id").agg(
            F.max("sequence_number").alias("sequence_number"), F.max("ordering").alias("ordering"), F.first("pid_bucket").alias("pid_bucket")
        )
        heads.write.mode("overwrite").parquet(f"{self.heads}/part={name}")
        own_tags = F.array_distinct("tags")
        ends = written.agg(F.min("ordering"), F.max("ordering"), F.count(F.lit(1)), F.sum(F.array_size(own_tags))).first()
        marks = written.select(F.explode(own_tags).alias("tag"), "ordering", "pid_bucket")
        marks = marks.withColumn("tag_bucket", self._bucket(F.col("tag"), self.buckets))
        # a tag may be on every event, and marks compress so well that AQE's target in bytes has ten million of them
        tasks = max(1, ceil((ends[3] or 0) / task_rows(self.spark)))
        sorted_marks = marks.repartitionByRange(tasks, "tag_bucket", "tag", "ordering").sortWithinPartitions("tag_bucket", "tag", "ordering")
        sorted_marks.write.mode("overwrite").partitionBy("tag_bucket").parquet(f"{self.tags}/part={name}")
        return Part(name, 0, 0, ends[0] or 0, ends[1] or 0, ends[2], buckets, 0)

    def append(self, events: DataFrame, order: Sequence[str], batch: int = 0, number: str | None = None) -> None:
        """Write events (``persistence_id``, ``payload``, ``tags``, ``ts`` and order columns) as one batch.

        Batches are appended in turn.  A batch that is there already stays as it is, so a run that was lost
        may append all of its batches again.  Ids of an entity are reserved from its head: a batch takes the next
        consecutive ones, in order.  ``number`` names a column that holds ids reserved before, see ``persist_lists``.
        """
        live, version = self.live(), self.version()
        newest = max((p.last_batch for p in live), default=-1)
        if batch <= newest:
            return
        if batch > newest + 1:
            raise ValueError(f"batch {batch - 1} has not been appended yet")
        if multiplies_rows(events):
            # what follows reads them several times
            events = written(events, "batch")
        if number:
            placed = events.withColumnRenamed(number, "sequence_number")
        else:
            placed = with_position(events, order, ["persistence_id"], "sequence_number", start=1)
        placed = with_position(placed, order, name="ordering", start=1 + max((p.last_ordering for p in live), default=0))
        if not number and any(p.n for p in live):
            last = self.last_numbers().select("persistence_id", F.col("sequence_number").alias("_last"))
            placed = join_same(placed, last, ["persistence_id"], "left").withColumn(
                "sequence_number", F.col("sequence_number") + F.coalesce("_last", F.lit(0))
            )
        rows = placed.select(
            "ordering", "persistence_id", "sequence_number", F.lit(False).alias("deleted"), "tags", "payload", "ts"
        )
        n = events.count()
        if n:
            part = self._write_part(f"b{batch:012d}", rows, n)
        else:
            part = Part(f"b{batch:012d}", 0, 0, 0, max((p.last_ordering for p in live), default=0), 0, 1, 0)
        numbered = {**vars(part), "first_batch": batch, "last_batch": batch, "added": version + 1}
        self._publish(version + 1, [*live, Part(**numbered)])

    def compact(self, least_rows: int = 10 * BUCKET_ROWS) -> int:
        """Merge neighbouring parts below ``least_rows``; returns the number of live parts.

        The merged parts become live, and those they replace stop being live, with one version of the manifest.  The
        folders of replaced parts stay for readers that have begun; expire them later.
        """
        live, version = self.live(), self.version()
        groups: list[list[Part]] = []
        for part in live:
            if groups and sum(p.n for p in groups[-1]) + part.n <= least_rows:
                groups[-1].append(part)
            else:
                groups.append([part])
        if all(len(group) == 1 for group in groups):
            return len(live)
        merged = []
        for group in groups:
            if len(group) == 1:
                merged += group
                continue
            ends = {"first_batch": group[0].first_batch, "last_batch": group[-1].last_batch, "added": version + 1}
            if n := sum(p.n for p in group):
                rows = self._load(self.path, self.fmt, group).drop("part", "pid_bucket")
                whole = self._write_part(f"m{version + 1:012d}-{group[0].first_batch:012d}", rows, n)
            else:
                whole = group[-1]
            merged.append(Part(**{**vars(whole), **ends}))
        self._publish(version + 1, merged)
        return len(merged)

    # reads

    def events(self, parts: Sequence[Part] | None = None) -> DataFrame:
        return self._load(self.path, self.fmt, self.live() if parts is None else parts).where(~F.col("deleted"))

    def by_id(self, persistence_id: str, first: int = 0, last: int = 2**63 - 1) -> DataFrame:
        """Events of one entity within a sequence range; reads one bucket a part."""
        parts = [p for p in self.live() if p.n]
        counts = sorted({p.buckets for p in parts}) or [1]
        of_bucket = [
            self.events([p for p in parts if p.buckets == n]).where(
                F.col("pid_bucket") == self._bucket(F.lit(persistence_id), n)
            )
            for n in counts
        ]
        return union_all(of_bucket).where(
            (F.col("persistence_id") == persistence_id) & F.col("sequence_number").between(first, last)
        )

    def last_numbers(self) -> DataFrame:
        """Last sequence number and ordering of every entity, from the heads alone."""
        return self._load(self.heads, "parquet", self.live()).groupBy("persistence_id").agg(
            F.max("sequence_number").alias("sequence_number"), F.max("ordering").alias("ordering")
        )

    def ids(self) -> DataFrame:
        return self.last_numbers().select("persistence_id")

    def next_ids(self) -> DataFrame:
        """The number that the next event of every entity gets."""
        return self.last_numbers().select("persistence_id", (F.col("sequence_number") + 1).alias("next_id"))

    def by_tag(self, tag: str, offset: int = 0, parts: Sequence[Part] | None = None) -> DataFrame:
        """Events that carry a tag, after a global offset.

        Parts that end at or before the offset are not opened; of the others the index gives the orderings, from one bucket.
        """
        wanted = [p for p in (self.live() if parts is None else parts) if p.n and p.last_ordering > offset]
        if not wanted:
            return self.events().where("false")
        marks = self._load(self.tags, "parquet", wanted).where(
            (F.col("tag_bucket") == self._bucket(F.lit(tag), self.buckets)) & (F.col("tag") == tag) & (F.col("ordering") > offset)
        )
        found = marks.select("part", "pid_bucket", "ordering")
        events = self.events(wanted).where(F.col("ordering") > offset)
        return events.join(found, ["part", "pid_bucket", "ordering"], "left_semi").select(events.columns)

    def stream_parts(self, versions: int = 100) -> DataFrame:
        """Live tail: a row for each batch when it is published, ``versions`` of the manifest at most in a trigger.

        Merges bring nothing new and do not show.
        """
        stream = self.spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", versions).parquet(self.manifest)
        return stream.where("added = version AND part LIKE 'b%'").drop("version")

    def published(self, parts: DataFrame) -> list[Part]:
        """The parts of one trigger of ``stream_parts``."""
        return [Part(**row.asDict()) for row in parts.collect()]


class SnapshotStore:
    """Folded states of entities beside a journal, in numbered folders that are written whole.

    A state is ``total`` and ``n_events`` up to and with ``sequence_number`` (and ``ordering``).  A complete folder, of all
    entities, has the ordering that it covers in its name: after it ``recover`` opens only the parts that end later.  States
    of some entities lead, by the heads and dynamic pruning, to the parts that hold later events of any.
    """

    STATE = ("persistence_id", "sequence_number", "ordering", "total", "n_events")

    def __init__(self, journal: Journal, amount: Column) -> None:
        self.journal, self.amount, self.path = journal, amount, f"{journal.path}-snapshots"

    def _saved(self) -> list[str]:
        names = sorted(folders(self.journal.spark, self.path))
        return [n for n in names if any(f.startswith("part-") for f in folders(self.journal.spark, f"{self.path}/{n}"))]

    def _save(self, states: DataFrame, kind: str) -> DataFrame:
        path = f"{self.path}/{len(folders(self.journal.spark, self.path)):012d}-{kind}"
        states.select(*self.STATE).write.parquet(path)
        return self.journal.spark.read.parquet(path)

    def take(self) -> DataFrame:
        """The state of every entity now, from the newest states and the tail."""
        covered = max((p.last_ordering for p in self.journal.live()), default=0)
        return self._save(self._states(), f"all-{covered:020d}")

    def take_every(self, n: int) -> DataFrame:
        """The state of every entity after each ``n``-th of its events."""
        return self._save(snapshots(self.journal.events(), self.amount, n), "some")

    def newest(self) -> DataFrame | None:
        """The newest state of each entity; folders before the last complete one are not read."""
        names = self._saved()
        if not names:
            return None
        complete = max((i for i, n in enumerate(names) if "-all-" in n), default=0)
        states = self.journal.spark.read.parquet(*(f"{self.path}/{n}" for n in names[complete:]))
        if "-all-" in names[-1]:
            return states
        state = F.max_by(F.struct(*self.STATE[1:]), "sequence_number").alias("s")
        return states.groupBy("persistence_id").agg(state).select("persistence_id", "s.*")

    def tail(self) -> DataFrame:
        """Events after the newest state of their entity."""
        names, live = self._saved(), self.journal.live()
        if not names:
            return self.journal.events()
        if "-all-" in names[-1]:
            covered = int(names[-1].rpartition("-")[2])
            later = [p for p in live if p.n and p.last_ordering > covered]
            return self.journal.events(later).where(F.col("ordering") > covered) if later else self.journal.events().where("false")
        newest = self.newest()
        states = newest.select("persistence_id", F.col("sequence_number").alias("_done"))
        heads = self.journal._load(self.journal.heads, "parquet", live)
        goes_on = F.col("sequence_number") > F.coalesce("_done", F.lit(0))
        # a row a part at most: the parts with a tail prune the scan of the events
        parts = join_same(heads, states, ["persistence_id"], "left").where(goes_on).select("part").distinct()
        events = self.journal.events().join(F.broadcast(parts), "part")
        return join_same(events, states, ["persistence_id"], "left").where(goes_on).drop("_done")

    def _states(self) -> DataFrame:
        newest = self.newest()
        folded = self.tail().groupBy("persistence_id").agg(
            F.sum(self.amount).alias("total"),
            F.count(F.lit(1)).alias("n_events"),
            F.max("sequence_number").alias("sequence_number"),
            F.max("ordering").alias("ordering"),
        )
        if newest is None:
            return folded
        both = newest.unionByName(folded.select(newest.columns))
        return both.groupBy("persistence_id").agg(
            F.sum("total").alias("total"),
            F.sum("n_events").alias("n_events"),
            F.max("sequence_number").alias("sequence_number"),
            F.max("ordering").alias("ordering"),
        )

    def recover(self) -> DataFrame:
        """State of every entity and its next id; equals a full replay."""
        next_id = (F.col("sequence_number") + 1).alias("next_id")
        return self._states().select("persistence_id", "total", "n_events", next_id)


def persist_lists(journal: Journal, lists: DataFrame, order: Sequence[str], batch: int) -> None:
    """Persist command lists (``persistence_id``, ``items``, ``tags``, ``ts`` and order columns) whole, as one batch.

    Each list reserves as many consecutive ids as it has items, after its entity's head and the lists before it:
    ``payload`` is (``base``, ``place``, ``item``), and the event's number is base + place.  An empty list takes none.
    """
    scan = OrderedScan(lists, order, ["persistence_id"]).before(_earlier=("sum", F.size("items").cast("bigint")))
    base = F.col("_earlier") + 1
    reserved = scan.df
    if any(p.n for p in journal.live()):
        last = journal.last_numbers().select("persistence_id", F.col("sequence_number").alias("_last"))
        reserved = join_same(reserved, last, ["persistence_id"], "left")
        base = base + F.coalesce("_last", F.lit(0))
    items = reserved.select(
        "persistence_id", "tags", "ts", *order, base.alias("_base"), F.posexplode("items").alias("_place", "_item")
    )
    payload = F.struct(F.col("_base").alias("base"), F.col("_place").cast("bigint").alias("place"), F.col("_item").alias("item"))
    numbered = items.withColumns({"payload": payload, "_number": F.col("_base") + F.col("_place")}).drop("_base", "_item")
    journal.append(numbered, [*order, "_place"], batch, "_number")


def jdbc_journal(
    spark: SparkSession, url: str, table: str, partitions: int, lower: int, upper: int, **options: str
) -> DataFrame:
    """The same envelope from a relational store, read in parallel by ranges of ``ordering``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", "ordering")
        .option("numPartitions", partitions)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .load()
    )


def replay(events: DataFrame, amount: Column) -> DataFrame:
    """State of every entity as the fold of all its events, and the next free sequence number.

    The id after recovery is the highest id plus one; taking the highest id itself would issue it twice.
    """
    return events.groupBy("persistence_id").agg(
        F.sum(amount).alias("total"),
        F.count(F.lit(1)).alias("n_events"),
        (F.max("sequence_number") + 1).alias("next_id"),
    )


def snapshots(events: DataFrame, amount: Column, every: int) -> DataFrame:
    """State after each ``every``-th event of an entity."""
    scan = OrderedScan(events, ["sequence_number"], ["persistence_id"]).upto(
        total=("sum", amount), n_events=("count", F.lit(1))
    )
    kept = [c for c in ("persistence_id", "sequence_number", "ordering") if c in events.columns]
    return scan.df.where(F.col("sequence_number") % every == 0).select(*kept, "total", "n_events")


def tag_events(songs: DataFrame, key: str, genre: Column) -> DataFrame:
    """Distinct genres per playlist; songs are first reduced to one row per playlist and genre."""
    pairs = songs.select(key, genre.alias("_genre")).distinct()
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list("_genre")).alias("tags"))


DEFAULT_TYPE = "acoustic"


def upcast_guitars(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Version 1 events read as version 2 with the default type."""
    both = v2.unionByName(v1, allowMissingColumns=True)
    return both.withColumn("guitar_type", F.coalesce("guitar_type", F.lit(DEFAULT_TYPE)))


def to_domain(stored: DataFrame) -> DataFrame:
    """Stored coupon events, with or without ``name``, as (code, user struct)."""
    name = F.coalesce("name", F.lit("")) if "name" in stored.columns else F.lit("")
    user = F.struct(F.col("user_id").alias("id"), F.col("email").alias("email"), name.alias("name"))
    return stored.select("code", user.alias("user"))


def to_storage(domain: DataFrame) -> DataFrame:
    return domain.select("code", F.col("user.id").alias("user_id"), "user.email", "user.name")


def invoice_events(df: DataFrame, order: Sequence[str], amount: Column) -> DataFrame:
    """One invoice becomes four events: tax, invoice, then both certificates."""
    rows = df.withColumn("_amount", amount)
    kinds = [("TaxRecord", "_amount div 3"), ("InvoiceRecord", "_amount"), ("Certified tax", None), ("Certified invoice", None)]
    parts = [
        F.struct(
            F.lit(i).alias("sub"),
            F.lit(kind).alias("kind"),
            (F.expr(value) if value else F.lit(None)).cast("bigint").alias("event_amount"),
        )
        for i, (kind, value) in enumerate(kinds)
    ]
    return rows.select(*order, F.inline(F.array(*parts)))


def processed_pairs(df: DataFrame, contents: Column, *keep: str) -> DataFrame:
    """Two events per command: the contents and the processed contents."""
    return df.select(*keep, F.explode(F.array(contents, F.concat(contents, F.lit("_pr")))).alias("event"))
