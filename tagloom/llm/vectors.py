"""Arrow batches and vectors between Spark and numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of texts that a task works on at once.
SLICE_ROWS = 256
BATCH_ROWS = 1_024


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session hold at most ``BATCH_ROWS`` rows from now on: texts are wide rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``SLICE_ROWS`` rows, which bounds what a task makes of them at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def usable(vector: Column) -> Column:
    """True unless ``vector`` is null or holds a null or non-finite component."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def width(df: DataFrame, column: str) -> int:
    """The largest number of components; shorter vectors count as padded with zeros."""
    return int(df.agg(F.max(F.size(column))).first()[0] or 0)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of ``dims`` doubles."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(rows)], pa.binary())


def unpacked(column, dims: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), dims)
