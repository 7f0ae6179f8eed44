"""Shared helpers: reading tables, staging frames on shared storage, byte and word hashing in batches.

Texts travel to Python as UTF-8 bytes in Arrow batches. A batch is one
contiguous byte array plus offsets, so tokenising and hashing run as numpy
passes over many documents at once; slices of at most ``SLICE_BYTES`` (or one
document) bound the memory of a task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 20
BATCH_ROWS = "512"

_MULT = 0x9E3779B97F4A7C15
_MULT_INV = pow(_MULT, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for rows with very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage in a way that survives lost executors and lets several
    branches share one computation. The folder is fresh for each call.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of ``staged`` frames that nothing will read again."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


# ---------------------------------------------------------------- hashing

_pow_cache: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``M**i`` and ``M**-i`` modulo 2**64 for i in 0..n."""
    if not _pow_cache or len(_pow_cache[0]) <= n:
        size = max(1 << 16, 1 << (n + 1).bit_length())
        up, down = np.full(size, _MULT, np.uint64), np.full(size, _MULT_INV, np.uint64)
        up[0] = down[0] = 1
        _pow_cache[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _pow_cache[0], _pow_cache[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))


class PrefixHash:
    """Polynomial hashes of any byte range of ``data`` in constant time each."""

    def __init__(self, data: np.ndarray):
        self._up, self._down = _powers(len(data) + 1)
        self._sums = np.empty(len(data) + 1, np.uint64)
        self._sums[0] = 0
        np.cumsum(_BYTE_VALUES[data] * self._up[: len(data)], out=self._sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + length)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the ``k`` bytes at every position."""
        n = len(self._sums) - k
        return mix((self._sums[k:] - self._sums[:n]) * self._down[:n])


def hash_string(text: str) -> int:
    """The hash ``PrefixHash.spans`` gives to one whole byte string."""
    data = np.frombuffer(text.encode(), np.uint8)
    return int(PrefixHash(data).spans(np.array([0]), np.array([len(data)]))[0])


# ---------------------------------------------------------------- batches

def column_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(data, offsets)`` of a binary Arrow column without nulls."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_large_binary(arr.type):
        kind = np.int64
    else:
        kind = np.int32
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, kind)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay under ``limit`` (a longer row stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SPACE_WORDS = ~_SPACE
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, word_offsets)``: byte ranges of words; words never cross documents."""
    inside = in_word[data]
    n = len(data)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def roll(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Ordered hash of ``k`` consecutive words at every word position."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = word_hashes[:n].copy()
    for i in range(1, k):
        out *= np.uint64(0xA0761D6478BD642F)
        out ^= out >> np.uint64(32)
        out += word_hashes[i: i + n]
    return mix(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word; long texts are taken in slices, so memory stays bounded."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + SLICE_BYTES, side="right")), i + 1)
        lo, hi = starts[i], ends[j - 1]
        out[i:j] = PrefixHash(data[lo:hi]).spans(starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return out
