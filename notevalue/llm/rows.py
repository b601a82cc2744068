"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Python's and the contracts' white space: space and \\t \\n \\v \\f \\r.
SPACE = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"
# Rows are handed to the step function in slices of about this many bytes of text.
SLICE_BYTES = 16 << 20


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once; SQL expressions have no local names."""
    return F.transform(F.array(value), use)[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """`batch` in pieces of bounded text size, at least one row each."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def map_text(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text") -> DataFrame:
    """`df` through `step`, a slice of rows at a time; `column` arrives as UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield step(part)

    return df.withColumn(column, F.col(column).cast("binary")).mapInArrow(run, schema)
