"""Structured Streaming helpers: file streams, landing folders, draining to tables, state folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from rillmark.session import folder_exists, load, scratch

FAR_FUTURE = "2200-01-01 00:00:00"
# files of a replayed history arrive in any time order and no row may be dropped as late; a live
# stream would allow minutes, so that closed windows leave the state earlier
REPLAY_LATENESS = "3650 days"
# input bytes per trigger
TRIGGER_BYTES = 256 << 30
# a key's rows wait and are released by slots of event time
REPLAY_SLOT_MS = 7 * 24 * 3_600_000
# waiting rows of a key that are folded at once, and the rows of the slot that goes beyond
RELEASE_ROWS = 50_000
# state partitions are fixed when a query first starts; unset: the shuffle partitions, two per core at most
STATE_PARTITIONS = "spark.rillmark.state.partitions"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def table_stream(spark: SparkSession, sf_dir: str, name: str, trigger_bytes: int = TRIGGER_BYTES) -> DataFrame:
    """One table as a file stream with its batch schema."""
    reader = spark.readStream.schema(load(spark, sf_dir, name).schema).option("maxBytesPerTrigger", trigger_bytes)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if folder_exists(spark, path):
        return reader.parquet(path)
    # a stream reads folders: pick the one file out of its folder
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def counter(spark: SparkSession, rows_per_batch: int, **options: Any) -> DataFrame:
    """Endless counter ``value`` 0, 1, 2 ... in batches of fixed size."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .options(**options)
        .load()
        .select("value")
    )


def landed_stream(spark: SparkSession, path: str, schema: T.StructType, files: int | None = None) -> DataFrame:
    """Files pushed into a landing folder; ``files`` per trigger, else ``TRIGGER_BYTES``."""
    limit = ("maxFilesPerTrigger", files) if files else ("maxBytesPerTrigger", TRIGGER_BYTES)
    return spark.readStream.schema(schema).option(*limit).parquet(path)


def push(df: DataFrame, landing: str) -> int:
    """Producer side of a landing folder; returns how many files lie there now."""
    df.write.mode("append").parquet(landing)
    return len(df.sparkSession.read.schema(df.schema).parquet(landing).inputFiles())


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stateful(spark: SparkSession):
    """State in RocksDB (on local disk, not in the heap) and sessions merged before their shuffle.

    ``spark.rillmark.state.partitions`` sets the number of state partitions of queries that start from now on.
    Choose it by the state that a query will hold: it cannot change later, a restart keeps the checkpoint's number.
    """
    chosen = spark.conf.get(STATE_PARTITIONS, None)
    usual = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return settings(
        spark,
        spark__sql__shuffle__partitions=chosen or str(usual),
        spark__sql__streaming__stateStore__providerClass=_ROCKSDB,
        spark__sql__streaming__sessionWindow__merge__sessions__in__local__partition="true",
    )


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything available now, then return; a failed query raises, and so do rows dropped as late.

    Dropped rows are added up over all triggers while the query runs; the rows written until then stay in the sink.
    """
    spark = SparkSession.active()
    late: dict[int, int] = {}
    # far more triggers than can pass between two looks at the progress
    with settings(spark, spark__sql__streaming__numRecentProgressUpdates="10000"):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        ended = False
        while not ended:
            # raises what ended the query
            ended = query.awaitTermination(1)
            for step in query.recentProgress:
                late[step["batchId"]] = sum(op["numRowsDroppedByWatermark"] for op in step["stateOperators"])
    if any(late.values()):
        raise RuntimeError(f"{sum(late.values())} rows came after the watermark had passed them: allow more lateness")


def run_until(stream: DataFrame, path: str, ended: Callable[[int], bool]) -> int:
    """Append an endless stream to a table until ``ended`` accepts the number of rows that a batch put out.

    Returns the number of batches up to that one.  A batch that is written again replaces its folder.
    """
    spark = stream.sparkSession
    counted = stream.observe("put_out", F.count(F.lit(1)).alias("n"))
    writer = counted.writeStream.format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", scratch(spark, "run-until")).trigger(processingTime="0 seconds")
    with settings(spark, spark__sql__streaming__numRecentProgressUpdates="10000"):
        query = writer.start()
        try:
            while True:
                for step in query.recentProgress:
                    if "put_out" in step["observedMetrics"] and ended(step["observedMetrics"]["put_out"]["n"]):
                        return step["batchId"] + 1
                # raises what ended the query
                query.awaitTermination(0.2)
        finally:
            query.stop()


def run_batches_until(
    stream: DataFrame, path: str, step: Callable[[DataFrame], DataFrame], ended: Callable[[int], bool]
) -> int:
    """Like ``run_until``, with each batch passed through ``step`` as a table, so that what it joins can be cut to the batch.

    ``ended`` is asked once a batch, in turn, and nothing is written after it has accepted.
    """
    keep, done = batch_writer(path), []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not done:
            # a stream's own session plans without it: as many shuffle tasks and files for each small batch as there can be
            with settings(batch.sparkSession, spark__sql__adaptive__enabled="true"):
                keep(step(batch), batch_id)
            if ended(stream.sparkSession.read.parquet(f"{path}/batch={batch_id}").count()):
                done.append(batch_id + 1)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", scratch(stream.sparkSession, "run-until"))
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        while not done:
            # raises what ended the query
            query.awaitTermination(0.2)
    finally:
        query.stop()
    return done[0]


def drain_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Append the stream to a table and return the table."""
    spark = stream.sparkSession
    path = scratch(spark, purpose)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    drain(writer, scratch(spark, f"{purpose}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Sink that writes each batch to its own folder, replacing it on a retry: the batch id is the ack."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def drain_by_batch(
    stream: DataFrame, purpose: str, mode: str = "append", checkpoint: str | None = None
) -> DataFrame:
    """Write each batch under its id and return the table with the column ``batch``."""
    spark = stream.sparkSession
    path = scratch(spark, purpose)
    writer = stream.writeStream.outputMode(mode).foreachBatch(batch_writer(path))
    drain(writer, checkpoint or scratch(spark, f"{purpose}-checkpoint"))
    return spark.read.parquet(path)


def with_sentinel(stream: DataFrame, ts: str) -> tuple[DataFrame, Callable[[], None]]:
    """The stream plus a side input for one far-future row, and the function that sends that row.

    Sent in a later run it moves the watermark past all real rows, so the open tail is emitted.  The column
    ``closing`` tells that row from real ones, whose other columns may be null as well; it has to be a key
    of the state and to be filtered in the sink, since an earlier filter would also hide the row's time.
    """
    spark = stream.sparkSession
    stream = stream.withColumn("closing", F.lit(False))
    landing = scratch(spark, "sentinel")
    nothing = spark.createDataFrame([], stream.schema)
    nothing.write.parquet(landing)

    def send() -> None:
        known = {ts: FAR_FUTURE, "closing": True}
        row = [F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
        spark.range(1).select(*row).write.mode("append").parquet(landing)

    return stream.unionByName(landed_stream(spark, landing, stream.schema)), send


Fold = Callable[[tuple | None, pd.DataFrame], tuple[tuple, pd.DataFrame]]


class OrderedState(StatefulProcessor):
    """Folds the rows of a key in order, however the triggers bring them.

    Rows wait in the state by slots of event time, as Arrow batches.  When the watermark passes the end of a slot no
    more rows can come for it: its timer takes out the slots that are due, in order, and folds them, as many at
    once as hold ``RELEASE_ROWS`` (at least one).  With ``idle_ms`` the state also expires: ``expire`` is asked once all
    rows up to that time after the key's last row have been folded and none has come.
    """

    def __init__(
        self,
        rows: T.StructType,
        order: list[str],
        time: str,
        slot_ms: int,
        state: str,
        fold: Fold,
        idle_ms: int | None = None,
        expire: Callable[[tuple], pd.DataFrame] | None = None,
    ) -> None:
        self.rows, self.order, self.time, self.slot_ms = rows, order, time, slot_ms
        self.state_schema, self.fold, self.idle_ms, self.expire = state, fold, idle_ms, expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.arrow = handle, to_arrow_schema(self.rows)
        self.parts = handle.getMapState("parts", "slot bigint", "n int")
        self.waiting = handle.getMapState("waiting", "slot bigint, part int", "batch binary")
        self.state = handle.getValueState("state", self.state_schema)
        # time of the last folded row
        self.last = handle.getValueState("last", "ms bigint")

    def _end(self, ms: int) -> int:
        return (ms // self.slot_ms + 1) * self.slot_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            ordered = batch.sort_values(self.time, ignore_index=True)
            times = ordered[self.time].to_numpy()
            slots = times // self.slot_ms
            packed = pa.RecordBatch.from_pandas(ordered[self.rows.names], self.arrow, preserve_index=False)
            starts = [0, *(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(slots)]
            for first, end in zip(starts, starts[1:], strict=False):
                slot = int(slots[first])
                n = (self.parts.getValue((slot,)) or (0,))[0]
                self.waiting.updateValue((slot, n), (packed.slice(first, end - first).serialize().to_pybytes(),))
                self.parts.updateValue((slot,), (n + 1,))
                if n == 0:
                    self.handle.registerTimer(self._end(int(times[first])))
                if self.idle_ms is not None:
                    self.handle.registerTimer(self._end(int(times[end - 1]) + self.idle_ms))
        return iter(())

    def _due(self, watermark: int) -> Iterator[pd.DataFrame]:
        """Rows of the slots that end by then, in order, some ``RELEASE_ROWS`` at once."""
        held: list[pa.RecordBatch] = []

        def ordered() -> pd.DataFrame:
            return pa.Table.from_batches(held).to_pandas().sort_values(self.order, ignore_index=True)

        for slot in sorted(slot for (slot,) in self.parts.keys() if (slot + 1) * self.slot_ms <= watermark):
            for part in range(self.parts.getValue((slot,))[0]):
                packed = self.waiting.getValue((slot, part))[0]
                held.append(pa.ipc.read_record_batch(pa.py_buffer(bytes(packed)), self.arrow))
                self.waiting.removeKey((slot, part))
            self.parts.removeKey((slot,))
            if sum(map(len, held)) >= RELEASE_ROWS:
                yield ordered()
                held.clear()
        if held:
            yield ordered()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.parts.containsKey((now // self.slot_ms - 1,)):
            state = self.state.get()
            for rows in self._due(timerValues.getCurrentWatermarkInMs()):
                state, out = self.fold(state, rows)
                last = int(rows[self.time].max())
                yield self._named(key, out)
            self.state.update(state)
            self.last.update((last,))
        if self.idle_ms is None:
            return
        known = self.last.get()
        if known and self._end(known[0] + self.idle_ms) <= now:
            yield self._named(key, self.expire(self.state.get()))
            self.last.clear()
            self.state.clear()

    @staticmethod
    def _named(key, out: pd.DataFrame) -> pd.DataFrame:
        return out.assign(**{name: value for name, value in zip(("named", "nameless", "closing"), key, strict=True)})

    def close(self) -> None:
        pass


def ordered_fold(
    stream: DataFrame,
    key: str,
    time: str,
    order: list[str],
    columns: list[str],
    state: str,
    out: str,
    fold: Fold,
    slot_ms: int = REPLAY_SLOT_MS,
    idle_ms: int | None = None,
    expire: Callable[[tuple], pd.DataFrame] | None = None,
) -> DataFrame:
    """A sequential fold per key over a stream whose triggers bring rows in any order.

    ``stream`` has a watermark on the timestamp ``time``: rows are held until it has passed their slot of ``slot_ms``, so a
    key's state is what arrived within the lateness that the watermark allows.  ``order`` must agree with event
    time between slots.  ``fold(state, rows)`` gets the ``columns`` of some slots, in order, with ``ms`` (the event time), and
    gives the new state and rows of the schema ``out``; ``expire(state)`` gives rows when a key was silent for ``idle_ms``.
    Null keys are one key.  A column ``closing`` keeps the sentinel row apart, see ``with_sentinel``.
    """
    kind = stream.schema[key].dataType
    closing = F.col("closing") if "closing" in stream.columns else F.lit(False)
    # a null in a key would make every row a group of its own in Python
    rows = stream.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("named"),
        F.col(key).isNull().alias("nameless"),
        closing.alias("closing"),
        F.col(time).alias("event_time"),
        F.floor(F.unix_micros(time) / 1000).alias("ms"),
        *columns,
    )
    held = T.StructType([rows.schema[c] for c in ("ms", *columns)])
    folded = rows.groupBy("named", "nameless", "closing").transformWithStateInPandas(
        OrderedState(held, order, "ms", slot_ms, state, fold, idle_ms, expire),
        outputStructType=f"named string, nameless boolean, closing boolean, {out}",
        outputMode="append",
        timeMode="EventTime",
    )
    results = T.StructType.fromDDL(out).names
    return folded.select(F.when(~F.col("nameless"), F.col("named").cast(kind)).alias(key), "closing", *results)


def drain_closed(spark: SparkSession, rows: DataFrame, close_all: Callable[[], None], purpose: str) -> DataFrame:
    """Drain, send the sentinel, drain again: the table of all rows, without those of the sentinel."""
    path, checkpoint = scratch(spark, purpose), scratch(spark, f"{purpose}-checkpoint")
    writer = rows.writeStream.format("parquet").option("path", path)
    with stateful(spark):
        # what the watermark of the first run releases can wait for the second
        with settings(spark, spark__sql__streaming__noDataMicroBatches__enabled="false"):
            drain(writer, checkpoint)
        close_all()
        drain(writer, checkpoint)
    return spark.read.schema(rows.schema).parquet(path).where("NOT closing").drop("closing")


def guarded_account_stream(
    stream: DataFrame, key: str, time: str, order: str, amount: str, slot_ms: int = REPLAY_SLOT_MS
) -> DataFrame:
    """Balance per key that rejects overdrafts, in the order of ``order`` whatever trigger a row comes with."""

    def fold(state: tuple | None, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        balance = state[0] if state else 0
        accepted, balances = [], []
        for change in rows[amount].tolist():
            ok = balance + change >= 0
            balance += change if ok else 0
            accepted.append(ok)
            balances.append(balance)
        return (balance,), rows[[order, amount]].assign(accepted=accepted, balance=balances)

    out = f"{order} bigint, {amount} bigint, accepted boolean, balance bigint"
    return ordered_fold(stream, key, time, [order], [order, amount], "balance bigint", out, fold, slot_ms)


def silence_stream(stream: DataFrame, key: str, time: str, idle_ms: int, slot_ms: int = REPLAY_SLOT_MS) -> DataFrame:
    """``expired_ms``: the instants at which a key has been silent for ``idle_ms``, by its rows in time order or by a timer."""

    def fold(state: tuple | None, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        before = rows["ms"].shift(1)
        if state:
            before = before.fillna(state[0])
        silent = rows["ms"] - before > idle_ms
        return (int(rows["ms"].iloc[-1]),), pd.DataFrame({"expired_ms": (before[silent] + idle_ms).astype("int64")})

    def expire(state: tuple) -> pd.DataFrame:
        return pd.DataFrame({"expired_ms": [state[0] + idle_ms]})

    return ordered_fold(stream, key, time, ["ms"], [], "last_ms bigint", "expired_ms bigint", fold, slot_ms, idle_ms, expire)
