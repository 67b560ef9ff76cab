"""Helpers shared by the operators: staged tables, whole-text word arrays, shingle hashes."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.session import shared_dir

#: A word is a run of anything but these bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Ids of up to this many rows (8 bytes each) may be broadcast; more are joined by shuffle.
BROADCAST_IDS = 1_000_000


_STAGED: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_staged() -> None:
    """What this process has staged goes when it ends; on a cluster that is the application's end."""
    for spark, path in _STAGED:
        with contextlib.suppress(Exception):
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(df: DataFrame, name: str, arrow_rows: int = 1000, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors.

    ``arrow_rows``: rows handed to Python at a time while it is written; texts may be long, and the buffers stay.
    ``group_bytes``: size of the file's row groups, where single rows are large; readers hold a batch of these.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    _STAGED.append((spark, path))
    usual = spark.conf.get(ARROW_ROWS)
    try:
        spark.conf.set(ARROW_ROWS, str(min(arrow_rows, int(usual))))
        (df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write).parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, usual)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and let the driver find the shuffles of jobs that are over:
    Spark removes a shuffle's files once the driver has collected its last reference as garbage."""
    for t in tables:
        where = spark._jvm.org.apache.hadoop.fs.Path(t._staged_path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
        _STAGED.remove((spark, t._staged_path))
    gc.collect()
    spark._jvm.System.gc()


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """An aggregate dealt by another hash of its key, so that a join on the key shuffles both its sides itself and
    Spark may split a key that the other side has very often."""
    return df.repartition(F.xxhash64(*key))


def with_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the distinct ``ids``; broadcasts them only if they are counted to be few."""
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")


def fraction(share: float, *columns: str) -> Column:
    """Whether a row is among about ``share`` of all, by a hash of these columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(min(share, 1.0) * (1 << 40))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_ascii(col: Column | str) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(col, UPPER, UPPER.lower())


def arrow_schema(df_schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_()}
    pairs = [c.strip().rsplit(" ", 1) for c in df_schema.split(",")]
    return pa.schema([pa.field(n.strip().strip("`"), kinds[t]) for n, t in pairs])


def record_batch(schema: str, *columns) -> pa.RecordBatch:
    s = arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(columns, s)], schema=s)


def sliced(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``max_bytes`` of text (one row at least)."""
    for b in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + max_bytes, "right")))
            yield b.slice(at, to - at)
            at = to


def handed_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; then the memory freed goes back to the system, as Python workers are kept for later tasks."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can do it
        ctypes.CDLL(None).malloc_trim(0)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null: empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse mod 2**64, kept for the longest text seen."""
    if not _POWERS or len(_POWERS[0]) < n + 1:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[:] = out
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a slice of documents: 64-bit hashes in text order, and where each document's begin."""

    hashes: np.ndarray
    first: np.ndarray  # of n_docs + 1
    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def words(texts: list[bytes], separators: np.ndarray = _IS_SPACE) -> Words:
    """Lower-cased (A-Z) words of whole texts, without a Python object per word."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    buf = _LOWER[raw]
    gap = separators[buf]
    starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    ends = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
    power, inverse = _powers(len(buf))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * power[: len(buf)], dtype=np.uint64)))
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return Words(hashes, np.searchsorted(starts, edges), buf, starts, ends)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``size`` words, and where each document's begin. A document of fewer words has its
    whole sequence as one; without words it has none."""
    n = np.diff(w.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.concatenate(([0], np.cumsum(count)))
    at = np.arange(first[-1]) - np.repeat(first[:-1] - w.first[:-1], count)
    length = np.minimum(np.repeat(n, count), size)
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        inside = j < length
        out += np.where(inside, w.hashes[np.minimum(at + j, max(len(w.hashes) - 1, 0))] * _STEP[j], np.uint64(0))
    return mix(out + length.astype(np.uint64) * _STEP[63]), first
