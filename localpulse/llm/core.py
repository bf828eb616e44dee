"""Shared helpers: scratch tables, Arrow text buffers, and word scanning on bytes."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL = threading.local()
_OWN_DIR: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder the cluster shares (``spark.checkpoint.dir``); where it is unset, a folder of our own in local mode, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="localpulse-"))
    return f"file://{_OWN_DIR[0]}"


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/localpulse/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, *, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: lost executors cost a re-read, not a re-computation, and
    values that depend on the partition layout stay fixed.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path, compression=compression)
    _scratch().append(path)
    return spark.read.schema(df.schema).parquet(path)


def _scratch() -> list[str]:
    """Scratch tables of this thread, in the order of writing; operators of other threads have their own list."""
    if not hasattr(_LOCAL, "paths"):
        _LOCAL.paths = []
    return _LOCAL.paths


def scratch_count() -> int:
    return len(_scratch())


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables; only for callers that have stored what they read from them."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release_since(spark: SparkSession, mark: int, *, but: int = 0) -> None:
    """Delete the scratch tables written since ``scratch_count`` was ``mark``, but not the last ``but`` of them.

    An operator calls it when its result reads none of those tables any more.
    """
    paths = _scratch()
    stop = len(paths) - but
    release(spark, paths[mark:stop])
    del paths[mark:stop]


def row_key(doc_id: str, text: str) -> Column:
    """A hash of a row's id and text: what is decided by the text holds for all rows of a key.

    Two rows of unlike texts share a key with a chance of 2^-64.
    """
    return F.xxhash64(F.col(doc_id).cast("string"), F.col(text).cast("string"))


def without(docs: DataFrame, bad: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is a ``doc_id`` of ``bad``."""
    keys = bad.select(F.col("doc_id").alias("__lp_bad")).distinct()
    return docs.join(keys, row_key(doc_id, text) == F.col("__lp_bad"), "left_anti")


BATCH_BYTES = 4 << 20


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_BYTES``; the number of rows says little about a batch of texts."""
    for batch in batches:
        step = max(1, batch.num_rows * BATCH_BYTES // max(batch.nbytes, 1))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def trimmed(run):
    """``run`` (for mapInArrow) for whole texts: with batches of ``BATCH_BYTES``, and freed memory given back when a task ends, since workers live on for other stages."""

    def task(batches):
        try:
            yield from run(_pieces(batches))
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return task


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    buf = np.frombuffer(data, np.uint8, int(offs[-1] - offs[0]), int(offs[0])) if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def byte_table(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


#: Words between the ASCII separators space and \t \n \v \f \r.
NOT_SPACE = byte_table(lambda b: b not in (32, 9, 10, 11, 12, 13))
#: Digits, lower-case ASCII letters (upper-case ones are lowered first) and every byte of a non-ASCII character.
ALNUM = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_runs(buf: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the maximal runs of ``inside`` bytes; no run crosses a row."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = inside[buf]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    heads = offs[:-1][np.diff(offs) > 0]
    tails = offs[1:][np.diff(offs) > 0] - 1
    first[heads] = m[heads]
    last[tails] = m[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_INV = pow(_STEP, -1, 2**64)
_SLICE = 1 << 19
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * _SLICE)
        _POWERS[:] = []
        for base in (_STEP, _STEP_INV):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each run's bytes (after ``fold``, a byte table), by a rolling sum that is the same anywhere in a text."""
    out = np.empty(len(starts), np.uint64)
    values = _BYTE if fold is None else _BYTE[fold]
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, base + _SLICE)))
        n = int(ends[j - 1]) - base
        power, inverse = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[buf[base : base + n]] * power[:n], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * inverse[a]
        i = j
    return mix64(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on; only the positions that have ``n`` words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9FB21C651E98DF25) + words[k : k + m]
        h ^= h >> np.uint64(28)
    return mix64(h)


def int64_binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


class HashTable:
    """Open-addressing table from non-zero 64-bit hashes to row numbers, probed for whole arrays at once."""

    def __init__(self, bits: int = 21) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.full(1 << bits, -1, np.int32)
        self.size = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row number of each hash, -1 where it is unknown."""
        slot = (hashes & self.mask).astype(np.int64)
        found = self.rows[slot]
        open_ = np.flatnonzero((self.keys[slot] != hashes) & (found >= 0))
        found[self.keys[slot] != hashes] = -1
        while len(open_):
            slot[open_] = (slot[open_] + 1) & int(self.mask)
            key, row = self.keys[slot[open_]], self.rows[slot[open_]]
            hit = key == hashes[open_]
            found[open_[hit]] = row[hit]
            open_ = open_[~hit & (row >= 0)]
        return found

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Give new, distinct hashes the next row numbers, in order."""
        while 2 * (self.size + len(hashes)) > len(self.keys):
            taken = self.rows >= 0
            keys = self.keys[taken][np.argsort(self.rows[taken])]
            self.__init__(len(self.keys).bit_length())
            self.add(keys)
        rows = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        self.size += len(hashes)
        slot = (hashes & self.mask).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            free = open_[self.rows[slot[open_]] < 0]
            self.keys[slot[free]] = hashes[free]
            won = free[self.keys[slot[free]] == hashes[free]]
            self.rows[slot[won]] = rows[won]
            done = np.zeros(len(hashes), bool)
            done[won] = True
            open_ = open_[~done[open_]]
            slot[open_] = (slot[open_] + 1) & int(self.mask)
        return rows
