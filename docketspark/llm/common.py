"""Shared helpers: bounded Arrow batches, stored intermediates, vectorised text hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.session import scratch_dir

# Documents that Python works on at a time. Spark bounds its Arrow batches by bytes; the
# arrays made of a batch of 10,000 documents could outgrow a Python worker all the same.
BATCH_ROWS = 256
# Bytes of text that are hashed at a time; the arrays for it take some 30 bytes a byte.
BATCH_BYTES = 1 << 20


def stored(df: DataFrame, label: str, *partition: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost
    executors, and gives later joins inputs whose sizes Spark knows."""
    path = scratch_dir(df.sparkSession, label)
    df.write.partitionBy(*partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of about ``size`` bytes in the jobs that run meanwhile: Spark's own bound
    stands several times over in the JVM's buffers of each task. The setting is put back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def text_of(name: str = "text"):
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it new to ``df``."""
    known, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        out.append(name)
    return out


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a batch's texts and their ``n + 1`` offsets, without copying."""
    if column.type != pa.string():
        column = column.cast(pa.string())
    column = column.fill_null("") if column.null_count else column
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    size = int(ends[-1] - ends[0]) if len(column) else 0
    if not size:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))
_powers: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int, name: str) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n; kept for the next batch."""
    table = _powers.get(name)
    if table is None or len(table) < n:
        size = max(n, 1 << 16)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        _powers[name] = table
    return table[:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` for each range; equal content, equal hash.

    ``values`` are 64-bit codes. The sum over a range of code times a power of its place
    is a difference of two prefix sums; multiplying by a power of the inverse base makes
    it independent of the place.
    """
    n = len(values)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(_BASE, n, "base"), out=prefix[1:])
    sums = prefix[ends] - prefix[starts]
    sums *= powers(_INVERSE, n + 1, "inverse")[starts]
    return mix64(sums ^ mix64((ends - starts).astype(np.uint64)))


def word_ranges(data: np.ndarray, offsets: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch: document of each, first byte, end byte."""
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    inside = ~blank
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= blank[:-1]
    closes[:-1] &= blank[1:]
    opens[first], closes[last] = inside[first], inside[last]  # no word spans two documents
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    docs = np.searchsorted(offsets, starts, side="right") - 1
    return docs, starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hashes(_BYTE_VALUES[data], starts, ends)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, everything else as it is."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper * np.uint8(32)).astype(np.uint8)


def word_windows(docs: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words within one document, and the index of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = docs[:n] == docs[k - 1 :]
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
    return mix64(total[inside]), np.flatnonzero(inside)


def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without the empty ones."""
    return (b for b in frames if b.num_rows)


def sliced(
    frames: Iterator[pa.RecordBatch], text: str, size: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of ``text`` each, one row at least."""
    for batch in batches(frames):
        column = batch.column(text)
        ends = np.cumsum(np.diff(utf8_column(column)[1])) if batch.num_rows > 1 else np.zeros(1)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def small_batches(
    frames: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS
) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows. At the end a worker, which later tasks use again,
    gives memory that is free back to the system."""
    for batch in batches(frames):
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Give memory that is free back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)
