"""Embedding columns as vectors of integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def finite(vector: str) -> Column:
    """True for a vector without null, NaN or infinite entries; null and empty vectors are not."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & good


def quantised(df: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """The rows of ``df`` whose ``vector`` is finite, with the column ``x``, floor(scale * entry) of every entry, in place of it.

    Entries count as double.  Vectors of another length than the longest are left out, as they share no space with it.
    """
    rows = df.filter(finite(vector)).withColumn("x", F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(F.lit(float(scale)) * c))).drop(vector)
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    return rows.filter(F.size("x") == (longest or 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow list column of vectors of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def pieces(batch: pa.RecordBatch, numbers: int) -> list[pa.RecordBatch]:
    """The batch in pieces whose vectors of ``numbers`` entries fill about two megabytes."""
    rows = max(1, (1 << 18) // max(1, numbers))
    return [batch.slice(at, rows) for at in range(0, batch.num_rows, rows)]
