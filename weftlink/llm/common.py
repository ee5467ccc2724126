"""Helpers shared by the operators: sessions, scratch tables, vectorised byte scanning.

Texts reach Python as Arrow buffers and are scanned as byte arrays, so one NumPy
call handles megabytes of text.  All word patterns used by the operators split
on ASCII bytes only; UTF-8 never uses those bytes inside other characters, so
scanning bytes gives the same words as scanning code points.
"""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows in one Arrow batch and text bytes handled by one NumPy pass; they bound a worker's memory.
BATCH_ROWS = 1000
PASS_BYTES = 2 << 20

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_OWN: dict[str, str] = {}

U64 = np.uint64


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and make this package importable in Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in os.environ.get("PYTHONPATH", "").split(":") and root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def shielded(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with columns called like one of ``names`` renamed, and the columns' original names in order."""
    renamed = {c: f"kept_{uuid.uuid4().hex}_{i}" for i, c in enumerate(df.columns) if c.lower() in {n.lower() for n in names}}
    return df.withColumnsRenamed(renamed), list(df.columns)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:  # as in tests: one folder of this driver's own, which only tasks on this machine can see
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _OWN.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="weftlink-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps survive lost executors and don't recompute it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weftlink_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored() tables that nothing reads any more, and let Spark drop the shuffles behind them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._weftlink_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    spark = SparkSession.getActiveSession()
    spark.range(1).collect()  # Spark holds the plan, and so the shuffles, of the last query until the next one
    gc.collect()
    spark._jvm.System.gc()


def trim() -> None:
    """Give freed memory of a Python worker back to the system, and what this module keeps, since workers stay for later tasks and stages."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def shard_count(spark: SparkSession) -> int:
    """Shards for exchanges made here: follows the session's shuffle partitions, which follow the input."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def crc_remainder(doc_ids, modulus: int) -> np.ndarray:
    """crc32 of the id's decimal text, modulo ``modulus``; -1 for a null id."""
    return np.array([-1 if i is None else zlib.crc32(str(i).encode()) % modulus for i in doc_ids], dtype=np.int64)


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Table of the bytes inside ``ranges`` (inclusive)."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED_WORD = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z are lower-cased.
PLAIN_WORD = byte_class([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column and its row offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def passes(column, limit: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes: first row, end row, bytes, offsets."""
    data, at = text_buffer(column)
    rows, low = len(at) - 1, 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        high = min(high, rows)
        yield low, high, data[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def spans(data: np.ndarray, at: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the number of the first word (one more entry at the end)."""
    inside = word[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    edges = at[:-1][at[:-1] < len(data)]
    if len(before):
        before[0] = False
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(after):
        after[-1] = False
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        size = max(n, 1 << 16)
        for key, base in (("p", _P), ("i", _PINV)):
            x = np.full(size, base, dtype=U64)
            x[0] = 1
            _POWERS[key] = np.cumprod(x)
    return _POWERS["p"][:n], _POWERS["i"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def running(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which the hash of any span follows in constant time."""
    p, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * p[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal spans have equal hashes wherever they lie."""
    _, inv = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(U64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(running(data), starts, ends)


def hash_bytes(text: bytes) -> int:
    """The hash that span_hashes gives ``text``."""
    data = np.frombuffer(text, dtype=np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts, with the length at the end."""
    if not len(sorted_values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block; unpack() gives them back."""
    import zstandard

    head = b"".join(np.array([ord(a.dtype.kind), a.dtype.itemsize, len(a)], dtype=np.int64).tobytes() for a in arrays)
    body = b"".join(a.tobytes() if a.dtype.itemsize == 1 else np.frombuffer(a.tobytes(), np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if a.dtype.kind in "iu" else a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(np.int64(len(arrays)).tobytes() + head + body)


def unpack(block: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    heads, at, out = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(n, 3), 8 + 24 * n, []
    for kind, width, length in heads.tolist():
        dtype = np.dtype(f"{chr(kind)}{width}")
        size = width * length
        flat = np.frombuffer(raw, np.uint8, size, at)
        if width > 1 and chr(kind) in "iu":
            flat = np.ascontiguousarray(flat.reshape(width, length).T).reshape(-1)
        out.append(flat.view(dtype))
        at += size
    return out


def cut(values: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit hash."""
    return ((values >> U64(40)) % U64(shards)).astype(np.int64)
