"""Table functions. Spark sends the module of a table function to its workers by value, so they have one of their own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


@F.arrow_udtf(returnType="id bigint, place bigint, value bigint")
class RangeToTriple:
    """Table function of (id, x), a batch at a time: x becomes x .. 3x; null and what is negative give nothing."""

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        known = rows.filter(pc.greater_equal(rows.column("x"), 0))
        x = known.column("x").to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = 2 * x + 1
        row = np.repeat(np.arange(len(x)), sizes)
        place = np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
        ids = known.column("id").cast(pa.int64()).take(pa.array(row))
        yield pa.table({"id": ids, "place": pa.array(place), "value": pa.array(x[row] + place)})
