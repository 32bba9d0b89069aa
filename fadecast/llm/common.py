"""Reading, writing between steps, and numpy views of UTF-8 text shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.session import deleted, shared_path

CHUNK = 1 << 20  # bytes of text that one numpy step looks at
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
SPACE = _SPACE  # ASCII white space; UTF-8 keeps these bytes for these characters alone

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it is computed once, survives lost
    executors, and later reads take only the columns they need. The shuffle files of its
    computation are deleted at once, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    if (scope := _passing.get()) is not None:
        scope.append(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside are deleted at its end, but for those that the function it gives
    writes. Whatever is used afterwards has to be one of these, or read nothing written inside."""
    made, outer = [], _passing.get()
    token = _passing.set(made)

    def stays(df: DataFrame, name: str) -> DataFrame:
        out = written(df, name)
        path = made.pop()
        if outer is not None:
            outer.append(path)
        return out

    try:
        yield stays
    finally:
        _passing.reset(token)
        for path in made:
            deleted(spark, path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_chunks(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, end row, bytes, offsets`` of runs of rows with about CHUNK bytes.

    Null texts are empty. A longer text makes a run of its own.
    """
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_binary()).fill_null(b"")
    n = len(text)
    if not n:
        return
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(buf: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each row the number of words before it (one more
    entry than rows). ``gap`` marks the bytes between words; rows never share a word."""
    inside = ~gap[buf]
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(buf))]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, in pieces of bounded size. The spans are disjoint and sorted."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK, side="right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        up, down = _powers(b - a)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[buf[a:b]] * up, out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


_held: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _held or len(_held[0]) < n:
        size = max(n, CHUNK)
        both = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        if n > CHUNK:  # an odd long span: not kept
            return both[0][:n], both[1][:n]
        _held[:] = both
    return _held[0][:n], _held[1][:n]


def shingles(w: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Per row the hashes of its runs of ``width`` words; a shorter row that has words is one run."""
    full = w[: max(0, len(w) - width + 1)]
    for j in range(1, width):
        full = mix(full * _STEP + w[j : j + len(full)])
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(full[a : b - width + 1])
        elif b > a:
            h = w[a : a + 1]
            for j in range(a + 1, b):
                h = mix(h * _STEP + w[j : j + 1])
            out.append(mix(h + np.uint64(b - a)))
        else:
            out.append(w[:0])
    return out


def binaries(matrix: np.ndarray) -> pa.Array:
    """Rows of a byte matrix as a binary column."""
    n, size = matrix.shape
    data = np.ascontiguousarray(matrix, np.uint8)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), n, [None, pa.py_buffer(data)]).cast(pa.binary())


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The byte matrix of a binary column whose values all have ``size`` bytes."""
    if not len(column):
        return np.zeros((0, size), np.uint8)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    fixed = column.cast(pa.binary(size))
    data = np.frombuffer(fixed.buffers()[1], np.uint8)
    return data[fixed.offset * size : (fixed.offset + len(fixed)) * size].reshape(-1, size)


SMALL = 32 << 20  # bytes up to which a side is broadcast


def sized(df: DataFrame, width: int = 40) -> DataFrame:
    """``df``, with a broadcast hint if its rows have been counted to be few enough for
    rows of ``width`` bytes; else as it is, and the join shuffles."""
    df = written(df, "side")
    return F.broadcast(df) if df.count() * width <= SMALL else df
