"""Helpers of the operators: columns by exact name, Arrow batches as numpy, shipping the package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ship


def col(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers can import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``limit`` bytes of column ``text`` each, or to one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            before, start = int(ends[stop - 1]), stop


def flat_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array one after the other, and its n + 1 offsets; a null is empty."""
    values = values.fill_null("").cast(pa.large_string())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def binary_rows(numbers: np.ndarray, at: np.ndarray) -> pa.Array:
    """Rows of 32-bit numbers, the i-th from at[i] to at[i + 1], as a binary array over one buffer."""
    offsets = pa.py_buffer((4 * at).astype(np.int64))
    rows = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(numbers))])
    return rows.cast(pa.binary())


def texts(values: pa.Array) -> list[str]:
    return values.fill_null("").to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit (two multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def give_back() -> None:
    """Return what a finished task has freed to the system; Spark goes on with the same worker for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library: nothing to ask for
        pass
