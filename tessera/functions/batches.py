"""How much text stands in Python's memory at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Rows and bytes that are handed to Python at once, and those of which it makes rows at once.
ARROW_ROWS, ARROW_BYTES = 2000, 8 << 20
PIECE_ROWS, PIECE_BYTES = 128, 1 << 20


def small(spark: SparkSession) -> SparkSession:
    """Batches for Python are bounded by their bytes too, so that its memory follows neither the table nor its texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def pieces(batch: pa.RecordBatch, column: str, rows: int = PIECE_ROWS, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, at most so many at once and, but for single rows, at most so many bytes of a column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for at, n in enumerate(lengths):
        if at > start and (held + n > size or at - start >= rows):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += n
    if len(lengths) > start:
        yield batch.slice(start)
