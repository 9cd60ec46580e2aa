"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_folder

MAX_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors see."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder; what follows no longer depends on executors that made it."""
    return cut_lineage(df)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in slices of about ``most`` bytes of ``column`` (one row at least), which bounds a worker's memory."""
    release_memory()  # of the task before, whose last slice was still held when its rows ended
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: workers and the driver live on, and what one stage has freed would add to what the next one takes."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as strings, null as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BROADCAST_ROWS = 1_000_000


def small(ids: DataFrame) -> DataFrame:
    """``ids``, written, with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows; otherwise Spark joins as it sees fit."""
    ids = written(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``ids`` (doc_id); rows without id stay."""
    return docs.join(small(ids.select("doc_id").distinct()), "doc_id", "left_anti").select(docs.columns)
