"""What several operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliospark.session import scratch_path

# A Spark setting: shuffle files of a finished query go at once instead of when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Words are runs of bytes other than ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later steps read the files, so a lost executor costs a read and not the work
    above, and the shuffle files of that work are freed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    _PATHS[back] = path
    return back


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _files(df: DataFrame, path: str):
    target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()), target


def discarded(*tables: DataFrame) -> None:
    """Delete the files of tables that ``stored`` gave; nothing that is still to run may read them."""
    for df in tables:
        path = _PATHS.pop(df, None)
        if path:
            fs, target = _files(df, path)
            fs.delete(target, True)


#: Stored tables of at most so many bytes on disk may be broadcast.
BROADCAST_BYTES = 8 << 20


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a table that ``stored`` gave has at most so many bytes; the files are measured."""
    fs, target = _files(df, _PATHS[df])
    return fs.getContentSummary(target).getLength() <= most


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A table that ``stored`` gave, marked for broadcast if its measured size allows it, else left to Spark's own choice."""
    return F.broadcast(df) if is_small(df, most) else df


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's content; equal rows share it, nulls are values."""
    parts = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def binary_values(column: pa.Array) -> Iterator[np.ndarray]:
    """The values of a binary Arrow column as byte arrays, without a copy; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield raw[a:b]


def give_back() -> None:
    """Return freed memory to the system; Arrow and the C library keep it otherwise, in idle Python workers too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of 64-bit hashes."""
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h += b
    return mixed(h)


class Rows:
    """Gathers column chunks and gives Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 200_000):
        self.schema, self.most, self.size = schema, most, 0
        self.parts: list[list[np.ndarray]] = [[] for _ in schema]

    def add(self, *columns: np.ndarray) -> None:
        for part, column in zip(self.parts, columns):
            part.append(column)
        self.size += len(columns[0])

    def full(self) -> bool:
        return self.size >= self.most

    def take(self) -> pa.RecordBatch:
        arrays = [
            pa.array(np.concatenate(part) if part else np.zeros(0), type=field.type)
            for part, field in zip(self.parts, self.schema)
        ]
        self.parts, self.size = [[] for _ in self.schema], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)
