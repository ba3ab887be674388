"""What the corpus operators share: tables, intermediate results, text as bytes.

Intermediate tables are Parquet under ``spark.checkpoint.dir``, the folder that
driver and executors share, so a lost executor costs a re-read and no more.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that the numpy kernels look at in one go.
CHUNK = 1 << 19

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Few rows at a time between the JVM and Python: texts are long, and both sides hold a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set (tests), one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="siftwell-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    spark.sparkContext._jvm.System.gc()  # Spark removes shuffle files once the driver has collected what names them
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
        _delete(spark, f)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session has already gone; its folder goes with it
            return


def release() -> None:
    """Gives memory that nothing holds any more back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidy(fn: Callable) -> Callable:
    """``fn`` for mapInArrow, giving memory back at its end: workers live on between stages."""

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    return run


#: Names of key columns beside a caller's own.
RESERVED = ("__siftwell_id", "__siftwell_text")


def row_key(id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = ("k_id", "k_text")) -> list[Column]:
    """Two columns that stand for a document: its id and a hash of its text.

    Rows with the same id and text are one document stated twice and always get
    the same result. A null id is a value of its own.
    """
    low = F.lit(-(2**63)).cast("long")
    return [F.coalesce(F.col(id_col).cast("long"), low).alias(names[0]), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias(names[1])]


def widened(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` with the columns of the DDL string ``more`` after it."""
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(more).fields])


def text_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    return column.cast(pa.large_string()).fill_null("")


def text_chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts.

    A run holds at most ``most`` bytes, or one text that is longer.
    """
    yield from byte_chunks(text_column(column), most)


def byte_chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same of a column of bytes or large strings without nulls."""
    if pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if not len(column):
        return
    offs = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


# --- hashing -----------------------------------------------------------------

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 2**64)
_pow: np.ndarray = np.ones(1, np.uint64)
_inv: np.ndarray = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal inputs stay equal, all bits count."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, CHUNK + 1)
        p, q = np.full(size, _BASE, np.uint64), np.full(size, _INV, np.uint64)
        p[0] = q[0] = 1
        _pow, _inv = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _pow, _inv


class SpanHash:
    """Rolling hash of a byte string: the hash of any span in constant time."""

    def __init__(self, raw: np.ndarray, table: np.ndarray = _BYTE):
        p, self.inv = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(table[raw] * p[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.inv[start] + length)


LOWER_BYTE = _BYTE[LOWER]


def word_spans(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``; first word of each text."""
    n = len(raw)
    inside = ~SPACE[raw]
    start, end = inside.copy(), inside.copy()
    if n:
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = offs[:-1][offs[:-1] < offs[1:]]
        start[edges] = inside[edges]
        last = offs[1:][offs[:-1] < offs[1:]] - 1
        end[last] = inside[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` word hashes; runs may cross texts."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total *= np.uint64(_BASE)
        total += words[j : j + n]
    return mix(total + np.uint64(k))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once. Only keys whose slot is shared get sorted."""
    n = len(keys)
    if n < 2:
        return np.zeros(n, bool)
    bits = max(10, int(n).bit_length() + 3)
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    _, where, counts = np.unique(keys[maybe], return_inverse=True, return_counts=True)
    out = np.zeros(n, bool)
    out[maybe] = counts[where] > 1
    return out
