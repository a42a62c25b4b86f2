"""Helpers that the operators of this package share.

Texts are handled as one byte array per slice with the offset of every text, so that words,
shingles and fingerprints are array operations. A slice is bounded in bytes; a text is never cut.
"""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Array operations on a byte take some hundred bytes of memory, so slices are small.
SLICE_BYTES = 1 << 19
ROWS_PER_BATCH = 2000
BYTES_PER_BATCH = 1 << 21

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


# ---- session ----------------------------------------------------------------------------------


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of these jobs, and this package on every executor.

    Arrow batches are bounded so that a batch of long documents stays small, and adaptive
    execution may split a join partition that one key has filled.
    """
    for name, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_PER_BATCH),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BYTES_PER_BATCH),
    }.items():
        spark.conf.set(name, value)
    _ship(spark)
    return spark


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors, which need not have the repository on their path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    folder = Path(tempfile.mkdtemp(prefix="rosterlens-"))
    copy = folder / "copy" / package.name
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(str(folder / "code"), "zip", folder / "copy"))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share.

    This is the folder of ``spark.checkpoint.dir``. Only a local session that has none gets a
    folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None and context.master.startswith("local") and "cluster" not in context.master:
        folder = tempfile.mkdtemp(prefix="rosterlens-")
        context.setCheckpointDir(folder)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{folder.rstrip('/')}/rosterlens-{uuid.uuid4().hex}"


def stored(table: DataFrame) -> DataFrame:
    """Write the table to the shared folder and go on from the written copy.

    Lost executors then cost only the tasks that read it again, and every reader sees the
    same rows.
    """
    spark = table.sparkSession
    path = shared_folder(spark)
    table.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for name in {os.path.dirname(f) for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_texts(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns and ``text``, null texts as empty ones."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


# ---- slices of texts --------------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and the n + 1 offsets of its rows."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    width = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    buf = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return buf, (ends - ends[0]).astype(np.int64)


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES, keep: bool = False
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, row after the last, bytes, offsets.

    A text longer than the limit is a slice of its own. ``keep`` leaves freed memory with the worker.
    """
    buf, offsets = text_bytes(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, buf[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high
    if not keep:
        give_back()


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system; a worker goes on to later stages and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


# ---- words and hashes -------------------------------------------------------------------------


def byte_class(members: bytes | None = None, others: bytes | None = None) -> np.ndarray:
    """A table that marks the given bytes, or all but the given ones."""
    table = np.zeros(256, bool) if members is not None else np.ones(256, bool)
    table[list(members if members is not None else others)] = members is not None
    return table


#: Words are separated by a space or one of the characters 0x09 to 0x0D.
BLANKS = b" \t\n\x0b\x0c\r"
WORD = byte_class(others=BLANKS)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of marked bytes; no run crosses an offset."""
    if len(mask) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(len(mask), bool)
    before[0], before[1:] = False, mask[:-1]
    after = np.empty(len(mask), bool)
    after[-1], after[:-1] = False, mask[1:]
    cut = offsets[(offsets > 0) & (offsets < len(mask))]
    before[cut] = False
    after[cut - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text each position belongs to."""
    return np.searchsorted(offsets, starts, side="right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
        return h ^ (h >> _U(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


@cache
def _powers(n: int, inverse: bool) -> np.ndarray:
    base = pow(int(_BASE), -1, 1 << 64) if inverse else int(_BASE)
    table = np.full(n, base, np.uint64)
    table[:1] = 1
    return np.cumprod(table, dtype=np.uint64)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """1, b, b*b, ... modulo 2**64, or the powers of its inverse. Short tables are kept."""
    if n <= SLICE_BYTES + 1:
        return _powers(SLICE_BYTES + 1, inverse)[:n]
    return _powers.__wrapped__(n, inverse)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every range of the values, by differences of one prefix sum."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(len(values)), out=total[1:])
        return mix((total[ends] - total[starts]) * powers(len(values) + 1, inverse=True)[starts])


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(BYTE_VALUES[buf], starts, ends)


def shingles(
    buf: np.ndarray, offsets: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of every text, the text of each, and words per text.

    A text with fewer words has its whole word sequence as its one run; one without words none.
    """
    starts, ends = spans(WORD[buf], offsets)
    n = len(offsets) - 1
    words = np.bincount(rows_of(starts, offsets), minlength=n)
    first = np.concatenate([[0], np.cumsum(words)])
    runs = np.where(words >= size, words - size + 1, (words > 0).astype(words.dtype))
    row = np.repeat(np.arange(n), runs)
    at = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs) + first[row]
    length = np.minimum(words, size)[row]
    return span_hashes(word_hashes(buf, starts, ends), at, at + length), row, words
