"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Batches = Iterator[pa.RecordBatch]

# Tables that reused workers keep from task to task.
_KEPT: list[dict] = []


def kept_table() -> dict:
    """A new table for what a worker keeps from task to task, until :func:`free_kept`."""
    _KEPT.append({})
    return _KEPT[-1]


def free_kept() -> None:
    """Give back what earlier tasks, maybe of other operators, have left in this worker."""
    if not any(_KEPT) and len(ByteHashes._powers) == 1:
        return
    for table in _KEPT:
        table.clear()
    ByteHashes._powers = ByteHashes._inverses = np.ones(1, np.uint64)
    gc.collect()
    pa.default_memory_pool().release_unused()
    # The C library keeps freed memory unless asked (glibc only).
    getattr(ctypes.CDLL(None), "malloc_trim", int)(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame, columns: list[str], fn: Callable[[Batches], Batches], schema: str
) -> DataFrame:
    """Run ``fn`` over Arrow batches of the named columns; other columns are not read.

    Only the named columns reach the function, so further columns of any name do no harm.
    """
    return df.select(*columns).mapInArrow(fn, schema)


def sliced(batches: Batches, rows: int = 512) -> Batches:
    """The same rows in smaller batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column as Python strings; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


# Fixed odd multiplier for hashes of byte strings modulo 2**64, and its inverse.
_BASE = 0x9E3779B97F4A7C15
_LENGTH_FACTOR = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
# A random 64-bit value per byte, so that runs of small byte values do not cancel out.
_BYTE_VALUES = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a finalizer, one to one)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class ByteHashes:
    """64-bit hashes of any slices of one byte array, each in constant time.

    The hash of ``data[s:e]`` is a sum of byte values times powers of an odd base, taken from
    prefix sums and divided by the power at ``s``; all arithmetic is modulo 2**64. The value
    depends on the slice's bytes alone, so equal slices of different arrays agree.
    """

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(ByteHashes._powers) <= n:
            size = max(n + 1, 1 << 16)
            for name, base in (("_powers", _BASE), ("_inverses", _BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(ByteHashes, name, np.cumprod(steps))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * ByteHashes._powers[:n], out=self.sums[1:])

    def rolling(self, width: int) -> np.ndarray:
        """Hashes of all slices of one width, by where they start."""
        n = len(self.sums) - width
        raw = (self.sums[width:] - self.sums[:n]) * ByteHashes._inverses[:n]
        return mix(raw + np.uint64(width * _LENGTH_FACTOR % (1 << 64)))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        raw = (self.sums[ends] - self.sums[starts]) * ByteHashes._inverses[starts]
        return mix(raw + lengths * np.uint64(_LENGTH_FACTOR))
