"""Arrow batches of long rows: bounded by bytes, not by rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch: the JVM, Arrow and Python each hold some copies of one for every running task.
BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession, size: int = BYTES) -> Iterator[None]:
    """What is run inside sends batches of at most ``size`` bytes (or one row); the session's own setting comes back."""
    before = spark.conf.get(KEY, None)
    spark.conf.set(KEY, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(KEY)
        else:
            spark.conf.set(KEY, before)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of a column of strings or bytes."""
    for b in batches:
        first, held = 0, 0
        for i, x in enumerate(b.column(column)):
            held += x.as_buffer().size if x.is_valid else 0
            if held >= size:
                yield b.slice(first, i + 1 - first)
                first, held = i + 1, 0
        if first < b.num_rows:
            yield b.slice(first)
