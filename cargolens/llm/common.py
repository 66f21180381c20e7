"""Helpers shared by the training-data operators.

* ``materialise`` cuts lineage by writing a table under the cluster's
  shared folder (``spark.checkpoint.dir``) and reading it back, so a lost
  executor never takes the only copy along.
* ``TextBlock`` gives numpy views over a batch of texts: one byte buffer,
  document offsets, word starts and ends, and 64-bit word hashes that do
  not depend on the process or the machine.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.session import checkpoint_dir

#: ASCII white space, as in the word pattern [^\x20\x09-\x0D]+
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_CLASS = "[^\\x20\\x09-\\x0D]"
MULT = np.uint64(0x9E3779B97F4A7C15)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MAX_BATCH_ROWS = 2000


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back; the
    shuffle files of the write go when it is done."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    if int(spark.conf.get(BATCH_ROWS)) > MAX_BATCH_ROWS:      # whole texts travel in these batches
        spark.conf.set(BATCH_ROWS, str(MAX_BATCH_ROWS))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def trimmed(mapper: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``mapper``, handing freed memory back to the system at the end of each
    task: Python workers are reused and would hold their peak otherwise."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from mapper(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return run


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def words_col(text: Column) -> Column:
    """The words of a text as an array (null text: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+"), "")


def n_words_col(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_CLASS}+")), F.lit(0)).cast("long")


def global_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``idx``, the 0-based position in ``order`` over the whole table,
    without sorting the table in one task: range partitions are numbered
    locally and shifted by the sizes of the partitions before them (one
    row per partition)."""
    from pyspark.sql import Window
    n = shuffle_partitions(df)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    local = materialise(ranged.select("*", F.spark_partition_id().alias("_pid"),
                                      F.monotonically_increasing_id().alias("_mono")), name)
    low = F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    return (local.join(before, "_pid")
            .withColumn("idx", F.col("_before") + low).drop("_pid", "_mono", "_before"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def utf8_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) \
        if off is not None and len(col) else np.zeros(len(col) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, target: int) -> Iterator[tuple[int, int]]:
    """Runs of whole rows holding about ``target`` bytes each (one row may
    hold more)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + target, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class TextBlock:
    """Words of a run of texts: ``starts``/``ends`` (byte positions in
    ``data``), ``doc`` (row of each word), ``counts`` (words of each row).
    ``breaks`` tells which bytes part words."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = True, breaks: np.ndarray = _IS_SPACE):
        self.data = _LOWER[data] if lower else data
        self.off = off
        n = len(data)
        if n == 0:
            self.starts = self.ends = self.doc = np.zeros(0, np.int64)
        else:
            word = ~breaks[self.data]
            first = word.copy()
            first[1:] &= ~word[:-1]
            last = word.copy()
            last[:-1] &= ~word[1:]
            inner = off[1:-1]
            inner = inner[(inner > 0) & (inner < n)]
            first[inner] = word[inner]          # a row's text starts a new word
            last[inner - 1] = word[inner - 1]
            self.starts = np.flatnonzero(first)
            self.ends = np.flatnonzero(last) + 1
            self.doc = np.searchsorted(off, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(off) - 1)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight bytes at a time."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        chunk = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        at, left = self.starts, self.ends - self.starts
        h = mix64((chunk[at] & _MASKS[np.minimum(left, 8)]) ^ (left.astype(np.uint64) * MULT))
        rows = np.flatnonzero(left > 8)
        at, left = at[rows] + 8, left[rows] - 8
        while len(rows):
            h[rows] = mix64((h[rows] * MULT) ^ (chunk[at] & _MASKS[np.minimum(left, 8)]))
            more = left > 8
            rows, at, left = rows[more], at[more] + 8, left[more] - 8
        return h


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
