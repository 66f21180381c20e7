"""Importance resampling towards a target set, by bit-sliced aggregation.

A text's features are its runs of one to three words, hashed into a fixed
number of buckets. The log ratio of a bucket's share among the target's
features to its share among the documents' is its gain, an integer; a
document's weight is the sum of the gains over its features.

The sum is taken bit by bit. A document's bucket counts become bit planes
of one bit a bucket (plane i holds bit i of every count), and so do the
gains, positive and negative ones apart. Plane i of a document AND plane j
of the gains, counted with popcount, is worth 2^(i+j); summing that over
all pairs of planes gives the weight exactly, in integers.

Feature counts are combined per task (``buckets`` rows each) before the
shuffle. The gain table has ``buckets`` rows whatever the corpus. A row of
words costs no Python step: the CRC of a run comes from the CRCs of its
words, since appending bytes acts linearly on a CRC. Documents are drawn by
a range-partitioned position in the order of their noisy scores.

Edge cases: a null or empty text has no features and weight 0; a null
doc_id takes part and hashes as the empty text; repeated rows each stand
for themselves, ties going to the smaller doc_id (null first) and then to
the earlier row; an empty target gives every bucket the gain of an absent
one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import TextBlock, global_index, materialise, slices, trimmed, utf8_parts

BUCKETS = 10000
MAX_RUN = 3
SLICE_BYTES = 1 << 20
SLICE_ROWS = 256        # documents whose dense counts are held at once
SHIFTS = 64             # zero bytes that one lookup can append

_BREAKS = np.ones(256, bool)
_BREAKS[0x30:0x3A] = _BREAKS[0x61:0x7B] = _BREAKS[0x80:] = False


#: what each low byte leaves in the CRC register when it is shifted out
_STEP = np.array([zlib.crc32(bytes([v ^ 255])) ^ 0xFF000000 for v in range(256)], np.uint32)


def _shift_tables() -> np.ndarray:
    """[n, p, v]: what byte value v at place p of a CRC becomes when n zero
    bytes follow."""
    out = np.zeros((SHIFTS + 1, 4, 256), np.uint32)
    for p in range(4):
        out[0, p] = np.arange(256, dtype=np.uint32) << np.uint32(8 * p)
    for n in range(SHIFTS):
        out[n + 1] = _STEP[out[n] & 255] ^ (out[n] >> np.uint32(8))
    return out


_SHIFT = _shift_tables().ravel()


def appended(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part of crc(a + b) that comes from crc(a), where b has n bytes."""
    crc, n = crc.copy(), n.copy()
    rows = slice(None)
    while True:
        x, k = crc[rows], np.minimum(n[rows], SHIFTS)
        at = k << 10
        crc[rows] = (_SHIFT[at + (x & 255)] ^ _SHIFT[at + 256 + ((x >> np.uint32(8)) & 255)]
                     ^ _SHIFT[at + 512 + ((x >> np.uint32(16)) & 255)] ^ _SHIFT[at + 768 + (x >> np.uint32(24))])
        n[rows] -= k
        rows = np.flatnonzero(n)
        if not len(rows):
            return crc


def word_crcs(block: TextBlock) -> np.ndarray:
    """crc32 of each word, a byte of all words at a time; words of more than
    ``SHIFTS`` bytes one by one."""
    length = block.ends - block.starts
    crc = np.full(len(length), 0xFFFFFFFF, np.uint32)
    rows = np.flatnonzero(length <= SHIFTS)
    k = 0
    while len(rows):
        x = crc[rows]
        crc[rows] = _STEP[(x ^ block.data[block.starts[rows] + k]) & 255] ^ (x >> np.uint32(8))
        k += 1
        rows = rows[length[rows] > k]
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > SHIFTS).tolist():
        crc[i] = zlib.crc32(block.data[block.starts[i]:block.ends[i]].tobytes())
    return crc


def features(block: TextBlock, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every feature of a run of texts."""
    word = word_crcs(block)
    length = block.ends - block.starts
    spaced = appended(np.full(len(word), zlib.crc32(b" "), np.uint32), length) ^ word
    rows, found = [block.doc], [word % np.uint32(buckets)]
    run = word
    for n in range(2, MAX_RUN + 1):
        same = block.doc[n - 1:] == block.doc[:-(n - 1)]
        run = appended(run[:-1], length[n - 1:] + 1) ^ spaced[n - 1:]     # runs that end at each word
        rows.append(block.doc[n - 1:][same])
        found.append(run[same] % np.uint32(buckets))
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


def blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, TextBlock]]:
    """(first row, end row, words) over runs of few rows and bytes."""
    data, off = utf8_parts(batch.column(column))
    for a, b in slices(off, SLICE_BYTES):
        for lo in range(a, b, SLICE_ROWS):
            hi = min(b, lo + SLICE_ROWS)
            yield lo, hi, TextBlock(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], breaks=_BREAKS)


def feature_counts(texts: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """How many features of the table fall into each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, block in blocks(batch, 0):
                total += np.bincount(features(block, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = (texts.select(F.col(text_col).cast("string").alias("text"))
            .mapInArrow(trimmed(run), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())      # at most `buckets` rows
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of (target share / raw share)), shares with one added to each bucket."""
    n = len(raw)
    s_all, t_all = int(raw.sum()) + n, int(target.sum()) + n
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def planes_of(values: np.ndarray, bit: int) -> np.ndarray:
    """Bit ``bit`` of each value, a row of values a row of 64-bit words."""
    packed = np.packbits((values >> bit) & 1 == 1, axis=-1)
    pad = -packed.shape[-1] % 8
    return np.pad(packed, [*[(0, 0)] * (packed.ndim - 1), (0, pad)]).view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(worth, plane) for each bit of the positive and of the negative gains."""
    out = []
    for sign in (1, -1):
        part = np.maximum(sign * gain, 0)
        out += [(sign << j, planes_of(part, j)) for j in range(int(part.max(initial=0)).bit_length())]
    return out


def weights_of(counts: np.ndarray, sliced: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Sum of counts times gains for each row of counts, plane by plane."""
    out = np.zeros(len(counts), np.int64)
    top = counts.max(axis=1, initial=0)
    for i in range(int(top.max(initial=0)).bit_length()):
        rows = np.flatnonzero(top >> i)
        plane = planes_of(counts[rows], i)
        for worth, gain in sliced:
            out[rows] += (worth << i) * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
    return out


def weighed(sliced: list[tuple[int, np.ndarray]], buckets: int):
    """Arrow mapper (doc_id, text) -> doc_id, n_words, n_features, weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch, 1):
                row, bucket = features(block, buckets)
                counts = np.bincount(row * buckets + bucket, minlength=(hi - lo) * buckets).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(block.counts.astype(np.int64)),
                     pa.array(np.bincount(row, minlength=hi - lo).astype(np.int64)),
                     pa.array(weights_of(counts.reshape(hi - lo, buckets), sliced))],
                    names=["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(doc_id: Column, seed: int) -> Column:
    """floor of 1000 times a Gumbel variate drawn by hashing the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = 42, min_words: int = 20,
             percent: int = 5, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank per document; rank counts the
    drawn ones from 1 and is null for the others."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sliced = gain_planes(gains(feature_counts(src, "text", buckets), feature_counts(target, target_col, buckets)))
    scored = materialise(
        src.mapInArrow(trimmed(weighed(sliced, buckets)), "doc_id long, n_words long, n_features long, weight long")
        .select("doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
                (F.col("n_words") >= min_words).alias("fit"), F.monotonically_increasing_id().alias("row")),
        "resampling-weights")
    drawn = scored.where("fit").count() * percent // 100
    placed = global_index(scored, [F.desc("fit"), F.desc("score"), F.asc("doc_id"), F.asc("row")], "resampling-order")
    return placed.select("doc_id", "n_features", "weight", "score",
                         F.when(F.col("fit") & (F.col("idx") < drawn), F.col("idx") + 1).alias("rank"))
