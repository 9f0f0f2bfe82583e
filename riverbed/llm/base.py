"""Helpers shared by the operators: session set-up, tables, hashing of byte ranges.

The numpy helpers work on one Arrow batch cut into chunks of about
``CHUNK`` bytes (a longer document is a chunk of its own), so a task's
memory follows the longest document, never the partition.
"""

from __future__ import annotations

import gc
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir, shared_path, ship_package

CHUNK = 1 << 20
#: white space between words, as a class of Java, RE2 and Python patterns
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """UTC, the shared folder for lineage cuts, and the package on the workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # a batch of whole documents, not of 10,000: tasks hold one batch in memory
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    Later jobs read finished files, so a lost executor costs no more than its
    own running tasks, and every reader sees the same rows. ``options`` are the
    writer's.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._riverbed_path = path
    return out


def finished(spark: SparkSession, *tables: DataFrame) -> None:
    """Free what a step whose result is written no longer needs: the tables named,
    and the shuffle files of finished jobs, which Spark drops once the driver has
    collected the objects that stood for them. A long chain of steps would
    otherwise hold all of its shuffles on the executors' disks to the end."""
    fs = spark._jvm.org.apache.hadoop.fs
    for table in tables:
        path = fs.Path(table._riverbed_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def n_words(text: str = "text") -> F.Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: str, m: int) -> F.Column:
    """``crc32(doc_id as text) mod m``; a null id falls in no class (-1)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % m,
                      F.lit(-1)).cast("int")


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the n + 1 offsets; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def chunks(col: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, end, bytes, offsets)`` of runs of documents of about ``limit`` bytes."""
    buf, off = text_buffer(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


_U = np.uint64
_rng = np.random.default_rng(20240229)
#: a fixed 64-bit random value per byte
BYTE_KEY = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n (kept for the next call)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK + 1), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 8 * CHUNK:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_hash(buf: np.ndarray, lut: np.ndarray | None = None) -> np.ndarray:
    """Prefix sums from which :func:`range_hash` hashes any byte range."""
    out = np.empty(len(buf) + 1, np.uint64)
    out[0] = 0
    np.cumsum((BYTE_KEY if lut is None else lut)[buf] * powers(_BASE, len(buf)), out=out[1:])
    return out


def range_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``buf[start:end]``; equal bytes give equal hashes anywhere."""
    return mix((pre[end] - pre[start]) * powers(_INV, len(pre))[start]
               + (end - start).astype(np.uint64) * _U(_BASE))


def verified_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``keys`` (hashes of the ranges) changed so that equal keys mean equal bytes.

    Every range is compared with the first one of its key; those that differ (hashes that
    collide) get keys of their own, by their bytes."""
    if not len(keys):
        return keys
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    twin = first[which.reshape(-1)]
    size = end - start
    wrong = size[twin] != size
    same = np.flatnonzero(~wrong & (twin != np.arange(len(keys))))
    step = max(1, len(same) // max(1, int(size[same].sum()) >> 22)) if len(same) else 1
    for lo in range(0, len(same), step):            # some 4 MB of indices at a time
        part = same[lo:lo + step]
        n = size[part]
        at = np.repeat(start[part] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        gap = np.repeat(start[twin[part]] - start[part], n)
        off = np.flatnonzero(buf[at] != buf[at + gap])
        wrong[part[np.searchsorted(np.cumsum(n), off, "right")]] = True
    if wrong.any():
        keys, own = keys.copy(), {}
        for i in np.flatnonzero(wrong).tolist():
            raw = buf[start[i]:end[i]].tobytes()
            keys[i] = own.setdefault(raw, _U(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest())))
    return keys


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 9, 10, 11, 12, 13]] = True


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, document`` of every word of a chunk; words end with their document."""
    solid = ~_SPACES[buf]
    edge = np.empty(len(buf) + 1, bool)
    edge[0] = True
    edge[-1] = True
    edge[1:-1] = solid[1:] != solid[:-1]
    edge[off] = True
    cuts = np.flatnonzero(edge)
    start, end = cuts[:-1], cuts[1:]
    keep = solid[start] if len(start) else np.zeros(0, bool)
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(off, start, "right") - 1


def local_path(name: str) -> str:
    """A vocabulary file of the installed ``public_tokenizers`` package (on every worker)."""
    import public_tokenizers
    return public_tokenizers.path(os.path.basename(name))
