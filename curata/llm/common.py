"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space; everything between is a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a kernel works on at once.
CHUNK_BYTES = 2 << 20
#: Bytes of an Arrow batch between Spark and a kernel, and the setting for it with Spark's default.
BATCH_BYTES = 3 << 20
BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def release() -> None:
    """Give freed memory back to the system: workers are reused, and what one kernel kept another would add to."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another libc
        pass


def tidy(run: Callable) -> Callable:
    """A kernel for ``mapInArrow`` or ``mapInPandas`` that releases its memory when its task ends."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(doc_id: Column | str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % modulus


def as_bytes(text: str) -> Column:
    """UTF-8 bytes of a text column; null gives no bytes."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of a binary column each; a longer text is a slice of its own."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.array([len(x) if x is not None else 0 for x in _buffers(batch.column(column))], np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < n:
            base = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _buffers(column: pa.Array) -> Iterator[memoryview | None]:
    for x in column:
        yield x.as_buffer() if x.is_valid else None


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` in batches of ``BATCH_BYTES``: both processes hold a batch per task, and 10,000 texts can be 64 MB.

    A size that the session sets itself stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(tidy(run), schema)


def tidy_group(run: Callable) -> Callable:
    """A kernel for groups that releases its memory after each."""

    if run.__code__.co_argcount == 1:
        return lambda table: _released(run, table)
    return lambda left, right: _released(run, left, right)


def _released(run: Callable, *args):
    try:
        return run(*args)
    finally:
        release()


class Bounded(dict):
    """A memory of ``make(key)`` that starts again when it holds about ``most`` bytes; ``cost`` is an entry's beside its key."""

    def __init__(self, make: Callable, most: int = 24 << 20, cost: int = 150):
        super().__init__()
        self.make, self.most, self.cost, self.size = make, most, cost, 0

    def __missing__(self, key):
        value = self.make(key)
        self.size += len(key) + self.cost
        if self.size > self.most:
            self.clear()
            self.size = 0
        self[key] = value
        return value


def blob(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def run_count(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions that hold about ``each`` rows, and no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))
