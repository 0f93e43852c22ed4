"""Helpers shared by the operators of this package.

Text reaches Python as Arrow batches.  ``text_blocks`` cuts a batch into
blocks of bounded size and hands out the bytes of the text column as one
array with the documents' offsets, so that the numpy code of the operators
works on whole blocks and never on single rows.
"""

from __future__ import annotations

import gc
import hashlib
import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.session import scratch_path, ship_package

#: Bytes of text that one block holds (a longer document is a block of its own).
BLOCK_BYTES = 1 << 21

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = 0x9E3779B97F4A7C15  # multiplier of the word hash
_U = np.uint64


def documents(spark: SparkSession, sf_dir: str, name: str = "documents", *cols: str) -> DataFrame:
    """A given table, projected to ``cols`` at the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


#: Files per core of a table that is written from a shuffle.
FILES_PER_CORE = 4


def written(df: DataFrame, name: str, per_core: int | None = None) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder and
    read again: cuts the lineage, so a lost executor costs one stage, and no
    later step computes it a second time.  ``per_core``: that many files for
    each of the cluster's cores at most, each made from several shuffle partitions one
    after the other, instead of one file per shuffle partition.  The driver lets go of
    the statement."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    if per_core:
        df = df.coalesce(max(1, per_core * spark.sparkContext.defaultParallelism))
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """The driver gives up the plans, generated classes and broadcasts of the
    statements before, of which an operator runs up to a hundred; Python's references to
    them go first, and memory that Arrow holds for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark._jvm.System.gc()


@contextmanager
def batch_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Statements that run inside hand Python Arrow batches of about ``limit`` bytes (a
    longer row is a batch of its own), not of ten thousand rows whatever their size: an
    executor holds a batch per core several times, in the JVM's native memory and in the worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ready(spark: SparkSession) -> None:
    """Ship the package to the Python tasks (once per application), and let
    Spark drop the shuffle files of a statement when it ends: every operator
    here writes its intermediate results, so none is read again."""
    ship_package(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    os.environ.setdefault("OMP_NUM_THREADS", "1")


def held_out(doc_id, modulus: int, remainder: int):
    """True where ``crc32(doc_id as text) mod modulus`` is ``remainder`` (a
    null id counts as crc32 of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def text_blocks(batch: pa.RecordBatch, column: str = "text",
                limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` of blocks of whole rows;
    ``offsets`` has one entry more than the block has rows and starts at 0.
    A null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = pc.fill_null(col, "")
    if pa.types.is_large_string(col.type):
        width = np.int64
    else:
        col, width = col.cast(pa.string()), np.int32
    n = len(col)
    if not n:
        return
    _, off, data = col.buffers()
    off = np.frombuffer(off, dtype=width)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, raw[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the bits of ``x`` (uint64)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def words_of(raw: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of the words of a block, in order; ``gap`` marks the
    bytes that part words."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~gap[raw]
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | cut[1:])) + 1
    row = np.searchsorted(off, start, side="right") - 1
    return start, end, row


#: Longest word, in bytes, that is hashed eight bytes at a time with all others.
_STEPPED = 64
#: Masks that keep the first 0 to 8 bytes of a little-endian integer.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands.  Every eight
    bytes are mixed into the state before the next eight, so no pattern of letters
    cancels out; words over ``_STEPPED`` bytes are hashed one by one, by BLAKE2."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.zeros(len(low) + 8, np.uint8)
    padded[:len(low)] = low
    eight = np.ndarray(len(low) + 1, dtype="<u8", buffer=padded, strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) + _U(_ODD))
    at, todo = start, np.flatnonzero(size <= _STEPPED)
    left, at = size[todo], start[todo]
    while len(todo):
        h[todo] = mix(h[todo] ^ (eight[at] & _FIRST[np.minimum(left, 8)]))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _STEPPED):
        digest = hashlib.blake2b(low[start[i]:end[i]].tobytes(), digest_size=8).digest()
        h[i] = _U(int.from_bytes(digest, "little"))
    return h


def shingle_hashes(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of all windows of ``k`` words within a row; a row
    with fewer words (but one at least) gives one hash of all its words."""
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = _U(0xD6E8FEB86659FD93)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    count = np.diff(np.r_[first, n])
    acc = h.copy()
    for j in range(1, min(k, n)):
        acc[:n - j] = acc[:n - j] * m + h[j:]
    full = np.zeros(n, dtype=bool)
    if n >= k:
        full[:n - k + 1] = row[k - 1:] == row[:n - k + 1]
    short = count < k
    if not short.any():
        return mix(acc[full]), row[full]
    at, size = first[short], count[short]
    few = h[at]
    for j in range(1, k - 1):
        have = size > j
        few[have] = few[have] * m + h[at[have] + j]
    out_h = np.concatenate([mix(acc[full]), mix(few + size.astype(np.uint64))])
    out_r = np.concatenate([row[full], row[at]])
    order = np.argsort(out_r, kind="stable")
    return out_h[order], out_r[order]


def distinct_per_row(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, row, count)`` of the distinct hashes of each row, rows in order."""
    if not len(h):
        return h, row, np.zeros(0, np.int64)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])]
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.r_[at, len(h)])
