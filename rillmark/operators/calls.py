"""User code on rows: external calls with bounded concurrency, user-written stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _in_flight(pool: ThreadPoolExecutor, call: Callable, values: Sequence, limit: int) -> list:
    """Results in input order; each of ``limit`` threads works through short runs of values."""
    size = max(1, min(256, -(-len(values) // limit)))
    runs = [values[i : i + size] for i in range(0, len(values), size)]
    return [result for done in pool.map(lambda run: [call(v) for v in run], runs) for result in done]


def async_call(
    df: DataFrame, call: Callable[[Any], Any], argument: str, result: str, kind: T.DataType, parallelism: int = 4
) -> DataFrame:
    """Call ``call`` per row, ``parallelism`` calls in flight per task, row order kept; errors fail."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(parallelism) as pool:
            for batch in batches:
                values = _in_flight(pool, call, batch[argument].tolist(), parallelism)
                yield batch.assign(**{result: pd.Series(values, index=batch.index, dtype=object)})

    schema = T.StructType([*df.schema.fields, T.StructField(result, kind)])
    return df.mapInPandas(run, schema)


def keyed_call(
    df: DataFrame, call: Callable[[Any], str], key: str, argument: str, parallelism: int = 4
) -> DataFrame:
    """Calls that carry a correlation id; each row reports success with a result or an error."""

    def attempt(value: Any) -> tuple[bool, str | None, str | None]:
        try:
            return True, call(value), None
        except Exception as error:  # any failure of the call is this row's result
            return False, None, str(error)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(parallelism) as pool:
            for batch in batches:
                done = _in_flight(pool, attempt, batch[argument].tolist(), parallelism)
                out = pd.DataFrame(done, columns=["ok", "result", "error"], index=batch.index)
                yield pd.concat([batch[[key]], out], axis=1)

    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("ok", T.BooleanType()),
            T.StructField("result", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )
    return df.select(key, argument).mapInPandas(run, schema)


class Stage(Protocol):
    """A user-written stage: gets the batches of one task in turn and may hold state between them."""

    def push(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]: ...

    def finish(self) -> Iterator[pa.RecordBatch]: ...


def stage(df: DataFrame, make: Callable[[], Stage], schema: T.StructType) -> DataFrame:
    """Run a stage of its own in every task over Spark's Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = make()
        for batch in batches:
            yield from mine.push(batch)
        yield from mine.finish()

    return df.mapInArrow(run, schema)


class KeepWhole:
    """Filter stage: keeps rows whose number divides evenly; batches too small to be worth sending wait for more."""

    def __init__(self, column: str, by: int, least: int = 1024) -> None:
        self.column, self.by, self.least = column, by, least
        self.held: list[pa.RecordBatch] = []

    def push(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        numbers = batch.column(self.column)
        divided = pc.multiply(pc.divide(numbers, self.by), self.by)
        self.held.append(batch.filter(pc.equal(divided, numbers)))
        if sum(map(len, self.held)) >= self.least:
            yield from self.finish()

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self.held
        self.held = []
