"""Best-fit packing with exact complements.

Documents are tokenised whole (ids of the word tokenizer, then one end id)
and only documents longer than a sequence are cut. The plan depends on the
piece lengths alone: for the largest remaining length the gap it leaves is
looked up among single lengths, then among sums of pairs, then of triples
of lengths still available, and as many equal sequences as the counts
allow are closed at once. What has no exact complement is packed
best-fit-decreasing, again many equal sequences at a time.

The plan is made from the histogram of lengths (at most ``capacity`` rows,
whatever the number of documents) and its size is bounded by the capacity
too. Pieces are matched to their place by their number among pieces of
equal length: a local number per task, shifted by the counts of the tasks
before, so no length is gathered anywhere. Tokenised pieces are written to
the shared folder first, which fixes the numbers should a task run again.

Edge cases: a null or empty text is the end id alone; equal rows are
packed each on its own; an empty table gives an empty result; other
columns are ignored. Ids are compared by checksum only, never stored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.common import TextBlock, materialise, slices, trimmed, utf8_parts

END_ID = 1
MAX_CACHED_WORDS = 1 << 18
MAX_CACHED_PARTS = 1 << 16
SLICE_BYTES = 1 << 20

#: fixed value: the tokenizer's word pattern, for lower-case text of ASCII and Latin letters
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
SIMPLE = re.compile(r"[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")


def byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters for themselves, the others counted on from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return "".join(chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256))


class WordIds:
    """Ids of distinct words, keyed by word hash: a bounded memo of sorted
    keys with their places in one pool of ids. Words of printable ASCII and
    composed Latin letters go part by part through the tokenizer's model,
    all others through its whole pipeline."""

    def __init__(self, path: str, max_words: int = MAX_CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.max_words = max_words
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.parts: dict[str, list[int]] = {}
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def part(self, text: str) -> list[int]:
        ids = self.parts.get(text)
        if ids is None:
            raw = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(raw)]
            if len(self.parts) < MAX_CACHED_PARTS:
                self.parts[text] = ids
        return ids

    def encode(self, word: bytes) -> list[int]:
        text = word.decode()
        if word.isalpha():
            return self.part(text.lower())
        if SIMPLE.fullmatch(text) and "<|" not in text:
            parts = PARTS.findall(text.lower())
            return self.part(parts[0]) if len(parts) == 1 else [i for p in parts for i in self.part(p)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of(self, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pool, number of ids) of each of the sorted keys."""
        if len(self.keys) + len(keys) > self.max_words:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            ids, size = array("I"), []
            for s, e in zip(starts[new].tolist(), ends[new].tolist()):
                got = self.encode(data[s:e])
                ids.extend(got)
                size.append(len(got))
            size = np.array(size, np.int64)
            begin = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, np.frombuffer(ids, np.uint32)])
            spot = np.searchsorted(self.keys, keys[new])
            self.keys, self.begin, self.size = (np.insert(old, spot, add) for old, add in (
                (self.keys, keys[new]), (self.begin, begin), (self.size, size)))
            at = np.searchsorted(self.keys, keys)
        return self.begin[at], self.size[at]


def document_ids(data: np.ndarray, off: np.ndarray, memo: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows one after the other, each closed by the end id; row offsets)."""
    block = TextBlock(data, off, lower=False)
    keys, first, which = np.unique(block.hashes(), return_index=True, return_inverse=True)
    begin, size = memo.of(keys, block.starts[first], block.ends[first], data.tobytes())
    n = size[which]
    place = np.cumsum(n) - n
    ids = memo.pool[np.repeat(begin[which] - place, n) + np.arange(int(n.sum()))]
    per_row = np.bincount(block.doc, weights=n, minlength=len(off) - 1).astype(np.int64)
    ends = np.cumsum(per_row)
    return np.insert(ids, ends, END_ID), np.concatenate([[0], np.cumsum(per_row + 1)])


_MEMOS: dict[str, WordIds] = {}


def tokenised_pieces(path: str, capacity: int):
    """Arrow mapper (doc_id, text) -> one row per piece. White space
    separates tokens and leaves none, so a text's ids are those of its
    ASCII-space-delimited words one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _MEMOS.get(path)
        if memo is None:
            memo = _MEMOS[path] = WordIds(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            data, off = utf8_parts(batch.column(1))
            for lo, hi in slices(off, SLICE_BYTES):
                ids, at = document_ids(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], memo)
                pieces = -(-np.diff(at) // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                size = np.minimum(capacity, np.diff(at)[row] - start)
                raw, from_ = memoryview(ids.astype("<u4").tobytes()), 4 * (at[row] + start)
                crc = [zlib.crc32(raw[f:f + 4 * n]) for f, n in zip(from_.tolist(), size.tolist())]
                local = np.empty(len(size), np.int64)
                order = np.argsort(size, kind="stable")
                run_at = np.searchsorted(size[order], size[order], side="left")
                local[order] = seen[size[order]] + np.arange(len(size)) - run_at
                seen += np.bincount(size, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(np.full(len(size), part, np.int32)), pa.array(local)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"])
    return run


def pack_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences as (how many, [(length, pieces of it), ...])."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[int, list[tuple[int, int]]]] = []

    def take(parts: list[int]) -> int:
        """Close as many sequences of these lengths as the counts allow."""
        need: dict[int, int] = {}
        for p in parts:
            need[p] = need.get(p, 0) + 1
        m = min(int(left[p]) // k for p, k in need.items())
        if m:
            for p, k in need.items():
                left[p] -= m * k
            plan.append((m, sorted(need.items(), reverse=True)))
        return m

    if left[capacity]:
        take([capacity])
    pair_sums, stale = None, 0
    for a in range(capacity - 1, 0, -1):
        gap = capacity - a
        if left[a]:
            take([a, gap])
        if left[a] and gap >= 2:                        # two more pieces
            b = np.arange(gap - 1, (gap - 1) // 2, -1)
            for x in b[(left[b] > 0) & (left[gap - b] > 0)]:
                if not left[a]:
                    break
                take([a, int(x), gap - int(x)])
        if left[a] and gap >= 3:                        # three more pieces
            if pair_sums is None or stale >= 64:        # lengths that two available pieces sum to
                have = (left > 0).astype(np.float64)
                size = 2 * (capacity + 1)
                pair_sums = np.fft.irfft(np.fft.rfft(have, size) ** 2, size)[:capacity + 1] > 0.5
                stale = 0
            stale += 1
            b = np.arange(gap - 2, 0, -1)
            for x in b[(left[b] > 0) & pair_sums[gap - b]]:
                if not left[a]:
                    break
                rest = gap - int(x)
                c = np.arange(rest - 1, (rest - 1) // 2, -1)
                for y in c[(left[c] > 0) & (left[rest - c] > 0)]:
                    if not left[a] or not left[x]:
                        break
                    take([a, int(x), int(y), rest - int(y)])

    # Best fit for the rest, longest first; open[g] holds groups of sequences with g ids free.
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    gaps = np.zeros(capacity + 1, bool)

    def put(free: int, m: int, parts: list[tuple[int, int]]) -> None:
        if free == 0:
            plan.append((m, parts))
        else:
            open_.setdefault(free, []).append((m, parts))
            gaps[free] = True

    for a in range(capacity, 0, -1):
        n = int(left[a])
        while n:
            fit = np.flatnonzero(gaps[a:])
            if len(fit):
                g = a + int(fit[0])
                m, parts = open_[g].pop()
                if not open_[g]:
                    gaps[g] = False
                per = min(g // a, n)
                used = min(m, n // per)
                if used < m:
                    put(g, m - used, parts)
                put(g - per * a, used, [*parts, (a, per)])
                n -= used * per
            else:
                per = capacity // a
                if n >= per:
                    put(capacity - per * a, n // per, [(a, per)])
                    n %= per
                else:
                    put(capacity - n * a, 1, [(a, n)])
                    n = 0
    for groups in open_.values():
        plan.extend(groups)
    return plan


def plan_table(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Intervals (length, first number) -> (per sequence, first sequence, offset)."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for m, parts in plan:
        offset = 0
        for length, per in parts:
            first = used.get(length, 0)
            rows.append((length, first, per, base, offset))
            used[length] = first + m * per
            offset += length * per
        base += m
    t = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (t[:, 0] << 44) + t[:, 1], "first": t[:, 1], "per": t[:, 2], "base": t[:, 3], "offset": t[:, 4]}


def place_pieces(table: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            i = np.searchsorted(table["key"], (length << 44) + number, side="right") - 1
            k = number - table["first"][i]
            per = table["per"][i]
            seq = table["base"][i] + k // per
            offset = table["offset"][i] + (k % per) * length
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(seq), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = materialise(src.mapInArrow(
        trimmed(tokenised_pieces(tokenizer_path, capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"), "pack-pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    hist = pieces.groupBy("length").count().collect()       # at most `capacity` rows
    table = plan_table(pack_plan({r["length"]: r["count"] for r in hist}, capacity))
    numbered = pieces.join(before, ["part", "length"]).withColumn("number", F.col("before") + F.col("local"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        place_pieces(table),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
