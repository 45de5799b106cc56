"""Shared helpers: table access, per-document Arrow mapping, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postscope.session import shared_dir

#: Rows handed to a per-document function at once: bounds a task's Python memory.
ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Hand what a finished task used back to the system: Python workers live
    on for later tasks of any kind, and their allocators keep freed memory."""
    del _powers[:]
    _powers.extend([np.ones(1, dtype=np.uint64)] * 2)
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def per_task(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, then ``give_back``."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema, rows: int = ROWS) -> DataFrame:
    """Apply ``fn`` to slices of at most ``rows`` rows of every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield fn(batch.slice(at, rows))

    return df.mapInArrow(per_task(run), schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves 2 modulo 4 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered per worker up to ``limit`` words."""

    def __init__(self, limit: int = 1 << 19):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over an array of uint64 (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Byte values and powers of the polynomial word hash; the powers grow with the longest text seen.
_BYTES = mix(np.arange(0x200, 0x300, dtype=np.uint64))
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of every word (run of anything but ASCII white space), in
    order: a polynomial over the word's bytes, from prefix sums of the text."""
    x = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[x]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    up, down = powers(len(x))
    sums = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[x] * up[: len(x)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


class Scratch:
    """Tables written to the shared folder named by ``spark.checkpoint.dir``.

    A written table cuts lineage and survives the loss of executors. ``keep``
    deletes the tables that no returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
        self.paths: dict[DataFrame, str] = {}
        self.written = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.written += 1
        path = f"{self.base}/{self.written}"
        df.write.parquet(path)
        # Shuffle files of finished steps go once the driver has dropped their plans.
        gc.collect()
        self.spark._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[out] = path
        return out

    def keep(self, *tables: DataFrame) -> None:
        wanted = {self.paths[t] for t in tables}
        for path in set(self.paths.values()) - wanted:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.paths = {t: p for t, p in self.paths.items() if p in wanted}
