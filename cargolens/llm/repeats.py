"""Removal of repeated byte strings with an enhanced suffix array.

A byte goes if a ``min_length``-byte string covers it that also starts in
a document with a smaller id. The strings are found in three steps.

1. *Anchors.* In each window of ``min_length`` bytes the smallest k-gram
   hash (the rightmost of ties) is its anchor; equal windows have equal
   anchors at the same offset. Anchors (about one in 16 positions, 6-byte
   hashes packed in binary blocks) are exchanged by hash, and those found
   in at least two documents come back to their texts. False repeats of a
   short hash only cost work later.
2. *Suffix arrays.* A run of windows with one repeated anchor is a chunk of
   at most 2 * min_length - k bytes. Equal chunks are combined before the
   exchange, which carries them to the task of their anchor - together with
   every other text around that anchor, so with all occurrences of all its
   windows. There the suffixes (one for each window) are sorted, the common
   prefixes of neighbours computed, and a stack scan walks the tree of
   common-prefix intervals. An interval whose suffixes are preceded by
   different bytes is a maximal repeat group; its strings go wherever a
   smaller document holds one of the group. An interval with one preceding
   byte is part of the one that starts a byte earlier.
3. *Removal.* Marks join the chunks' occurrences by chunk hash (a join that
   adaptive execution can split), are collected per document and united.

A passage that a third of all documents hold is therefore one chunk for
each task, not one row for each document, in the task of its anchor.

Edge cases: a null text is empty; texts shorter than ``min_length`` keep
all bytes; a null id counts as the largest id; rows with one id
(copies of a row) do not remove each other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import MULT, materialise, mix64, shuffle_partitions, slices, trimmed, utf8_parts

GRAM = 20
WORK_BYTES = 1 << 20        # texts worked on at once
COMBINE_BYTES = 32 << 20     # texts whose anchors and chunks are combined
LAST_ID = (1 << 63) - 1
SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64))
_LOW = np.uint64((1 << 24) - 1)
SIX = np.uint64((1 << 48) - 1)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position on (by doubling)."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = {1: _LETTER[data]}
    size, factors = 1, {1: MULT}
    while 2 * size <= k:
        h = powers[size]
        powers[2 * size] = h[:len(h) - size] * factors[size] + h[size:]
        size *= 2
        factors[size] = np.uint64(int(factors[size // 2]) ** 2 % (1 << 64))
    out, done = powers[size][:n], size
    while done < k:                              # the bits of k below the highest
        step = 1 << ((k - done).bit_length() - 1)
        out = out * factors[step] + powers[step][done:done + n]
        done += step
    out = (out ^ (out >> np.uint64(32))) * MULT
    return out ^ (out >> np.uint64(29))


def anchor_runs(data: np.ndarray, off: np.ndarray, length: int, k: int = GRAM):
    """Runs of windows with one anchor: (row, first window, last window,
    anchor position, anchor hash), positions in ``data``."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    n = len(data) - length + 1
    if n <= 0:
        return none
    grams = gram_hashes(data, k)
    at = np.arange(len(grams), dtype=np.uint64)
    key = (grams & ~_LOW) | (_LOW - (at & _LOW))
    span, size, low = length - k + 1, 1, key
    while 2 * size <= span:
        low = np.minimum(low[:len(low) - size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[span - size:span - size + n])
    start = np.arange(n)
    anchor = start + (((_LOW - (low & _LOW)).astype(np.int64) - start) & int(_LOW))
    inside = np.zeros(n, bool)
    sizes = np.diff(off)
    rows = np.flatnonzero(sizes >= length)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, off[rows], 1)
    np.add.at(edge, off[rows] + sizes[rows] - length + 1, -1)
    inside = np.cumsum(edge[:-1]) > 0
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    new[off[rows]] = True
    first = np.flatnonzero(new)
    ends = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    m = anchor[first]
    return np.searchsorted(off, first, side="right") - 1, first, ends, m, grams[m]


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray((values & SIX).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw) -> np.ndarray:
    cells = np.zeros((len(raw) // 6, 8), np.uint8)
    cells[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return cells.view("<u8").ravel()


def _work(batch: pa.RecordBatch, column: int):
    """Sub-slices of a batch: (first row, data, offsets) of about WORK_BYTES."""
    data, off = utf8_parts(batch.column(column))
    for lo, hi in slices(off, WORK_BYTES):
        for a in range(lo, hi, 60000):
            b = min(hi, a + 60000)
            yield a, data[off[a]:off[b]], off[a:b + 1] - off[a]


def _send_anchors(length: int, buckets: int):
    """(id, th, text) -> packed anchors for each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if held:
                ids, ths, fps = (np.concatenate(x) for x in zip(*held))
                yield _pack("bucket", (fps >> np.uint64(48)).astype(np.int64) % buckets, ids, ths, fps)
            held, size = [], 0

        for batch in batches:
            ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, data, off in _work(batch, 2):
                row, _, _, _, fps = anchor_runs(data, off, length)
                if len(fps):                     # each anchor once for each document
                    order = np.lexsort((fps, row))
                    row, fps = row[order], fps[order]
                    keep = np.concatenate([[True], (row[1:] != row[:-1]) | (fps[1:] != fps[:-1])])
                    row, fps = row[keep], fps[keep]
                    held.append((ids[a + row], ths[a + row], fps))
                size += len(data)
                if size >= COMBINE_BYTES:
                    yield from flush()
        yield from flush()
    return run


PACKED = "{} int, ids binary, ths binary, counts binary, anchors binary"


def _pack(name: str, group: np.ndarray, ids: np.ndarray, ths: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    """One row per group: runs of equal (id, th) with their anchors."""
    order = np.lexsort((ths, ids, group))
    group, ids, ths, fps = group[order], ids[order], ths[order], fps[order]
    cut = np.append(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), len(group)) if len(group) else [0]
    rows = []
    for a, b in zip(cut[:-1], cut[1:]):
        change = np.flatnonzero(np.concatenate([[True], (ids[a + 1:b] != ids[a:b - 1]) | (ths[a + 1:b] != ths[a:b - 1])]))
        n = np.diff(np.append(change, b - a)).astype("<i4")
        rows.append((int(group[a]), ids[a:b][change].astype("<i8").tobytes(), ths[a:b][change].astype("<i8").tobytes(),
                     n.tobytes(), _six(fps[a:b])))
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                      names=[name, "ids", "ths", "counts", "anchors"])


def _unpack(batches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, ths, fps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for b in batches:
        for i, t, n, f in zip(*(b.column(c).to_pylist() for c in ("ids", "ths", "counts", "anchors"))):
            n = np.frombuffer(n, "<i4")
            ids.append(np.repeat(np.frombuffer(i, "<i8"), n))
            ths.append(np.repeat(np.frombuffer(t, "<i8"), n))
            fps.append(_from_six(f))
    return np.concatenate(ids), np.concatenate(ths), np.concatenate(fps)


def _repeated_anchors(blocks: int):
    """Packed anchors of a partition -> those found in two documents, packed
    for the block of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ths, fps = _unpack(batches)
        if len(ids):
            order = np.argsort(fps, kind="stable")
            s = fps[order]
            begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            low, high = np.minimum.reduceat(ids[order], begin), np.maximum.reduceat(ids[order], begin)
            rep = np.zeros(len(s), bool)
            rep[order] = np.repeat(low != high, np.diff(np.append(begin, len(s))))
            ids, ths, fps = ids[rep], ths[rep], fps[rep]
            yield _pack("blk", np.mod(ids ^ ths, blocks), ids, ths, fps)
    return run


def _chunks(length: int):
    """A block's documents and their repeated anchors -> one row per run
    whose anchor repeats; of equal chunks only the one of the smallest
    document carries the bytes."""
    def run(docs: pa.Table, flags: pa.Table) -> pa.Table:
        key = lambda i, t: mix64(i.astype(np.uint64) ^ mix64(t.astype(np.uint64)))
        fi, ft, ff = _unpack(flags.to_batches())
        fk = key(fi, ft)
        order = np.argsort(fk, kind="stable")
        fk, ff = fk[order], ff[order]
        ids, ths = docs["id"].to_numpy(), docs["th"].to_numpy()
        own = key(ids, ths)
        lo, hi = np.searchsorted(fk, own, side="left"), np.searchsorted(fk, own, side="right")
        some = np.flatnonzero(hi > lo)
        docs, ids, ths, lo, hi = docs.take(pa.array(some)).combine_chunks(), ids[some], ths[some], lo[some], hi[some]
        held = []
        for batch in docs.select(["text"]).to_batches():
            for a, data, off in _work(batch, 0):
                rows = len(off) - 1
                n = hi[a:a + rows] - lo[a:a + rows]
                at = np.repeat(lo[a:a + rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                known = np.sort(ff[at] | (np.repeat(np.arange(rows), n).astype(np.uint64) << np.uint64(48)))
                row, first, last, _, fps = anchor_runs(data, off, length)
                mine = (fps & SIX) | (row.astype(np.uint64) << np.uint64(48))
                spot = np.minimum(np.searchsorted(known, mine), max(0, len(known) - 1))
                hit = np.flatnonzero(known[spot] == mine) if len(known) and len(mine) else np.zeros(0, np.int64)
                row, first, last, fps = row[hit], first[hit], last[hit], fps[hit]
                whole = data.tobytes()
                text = [whole[f:e + length] for f, e in zip(first.tolist(), last.tolist())]
                keys = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in text), "<i8").reshape(-1, 2)
                held.append((ids[a + row], ths[a + row], first - off[row], fps, keys[:, 0], keys[:, 1], pa.array(text, pa.binary())))
        ids, ths, pos, fps, keys, more = (np.concatenate([h[i] for h in held] or [np.zeros(0, np.int64)]) for i in range(6))
        text = pa.chunked_array([h[6] for h in held], pa.binary())
        lead, most = np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        if len(ids):
            order = np.lexsort((ids, more, keys))
            begin = np.flatnonzero(_starts(keys[order], more[order]))
            lead[order[begin]] = True
            most[order[begin]] = np.maximum.reduceat(ids[order], begin)
        return pa.table([pa.array(ids), pa.array(ths), pa.array(pos, pa.int64()), pa.array(keys), pa.array(more),
                         pa.array((fps.astype(np.uint64) & SIX).astype(np.int64)), pa.array(most),
                         pc.if_else(pa.array(lead), text, pa.scalar(None, pa.binary()))],
                        names=["id", "th", "pos", "chunk", "chunk2", "anchor", "high", "bytes"])
    return run


def repeat_groups(texts: list[bytes], owners: np.ndarray, length: int):
    """Maximal repeats of at least ``length`` bytes in ``texts``.

    Yields (common length, smallest owner, [(text, start), ...]) for every
    common-prefix interval whose occurrences differ in the byte before them
    (the start of a text differs from everything)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    count = np.maximum(0, sizes - length + 1)
    if not count.sum():
        return
    text = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    width = int(sizes.max())
    flat = np.frombuffer(b"".join(t.ljust(2 * width, b"\0") for t in texts), np.uint8)
    view = np.lib.stride_tricks.as_strided(flat, (len(flat) - width + 1, width), (1, 1))
    suffix = np.ascontiguousarray(view[text * 2 * width + start])
    order = np.argsort(suffix.view(f"S{width}").ravel(), kind="stable")
    suffix, text, start = suffix[order], text[order], start[order]
    differ = suffix[1:] != suffix[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    left_over = sizes[text] - start
    lcp = np.minimum(common, np.minimum(left_over[1:], left_over[:-1]))
    before = np.where(start > 0, flat[text * 2 * width + start - 1].astype(np.int64), -1 - np.arange(len(start)))
    own = owners[text]
    long = lcp >= length
    edges = np.flatnonzero(np.diff(np.concatenate([[False], long, [False]]).astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):      # suffixes a..b share `length` bytes
        if b == a + 1:
            if before[a] != before[b]:
                yield int(lcp[a]), int(min(own[a], own[b])), [(int(text[i]), int(start[i])) for i in (a, b)]
            continue
        stack: list[list[int]] = []      # [common length, first suffix, preceding byte or None]
        heights = lcp[a:b].tolist() + [length - 1]
        for i, h in enumerate(heights):
            first, byte = a + i, int(before[a + i])
            while stack and stack[-1][0] > h:
                height, begin, prior = stack.pop()
                prior = prior if prior == byte else None
                if prior is None:
                    members = range(begin, a + i + 1)
                    yield height, int(own[begin:a + i + 1].min()), [(int(text[j]), int(start[j])) for j in members]
                first, byte = begin, prior
            if stack and stack[-1][0] == h:
                if stack[-1][2] != byte:
                    stack[-1][2] = None
            elif h >= length:
                stack.append([h, first, byte])
    return


def _marks(length: int):
    """Chunks of a partition's anchors -> (chunk, chunk2, from, to, smallest id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [[], [], [], [], [], []]
        for b in batches:
            for c, name in zip(cols, ("anchor", "chunk", "chunk2", "id", "high", "bytes")):
                c.append(b.column(name))
        if not cols[0]:
            return
        anchor, chunk, chunk2, low, high = (np.concatenate([x.to_numpy() for x in c]) for c in cols[:5])
        raw = pa.chunked_array(cols[5])
        del cols
        order = np.lexsort((chunk2, chunk, anchor))
        anchor, chunk, chunk2, low, high = anchor[order], chunk[order], chunk2[order], low[order], high[order]
        begin = np.flatnonzero(_starts(chunk, chunk2))
        low, high = np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin)
        anchor, text = anchor[begin], raw.take(pa.array(order[begin]))
        chunk = list(zip(chunk[begin].tolist(), chunk2[begin].tolist()))
        del raw
        sizes = pc.binary_length(text).to_numpy()
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        single = new & np.append(new[1:], True)
        out = [(*chunk[i], 0, int(sizes[i]), int(low[i])) for i in np.flatnonzero(single & (low != high))]
        mixed = np.flatnonzero(~single)
        bounds = np.flatnonzero(np.concatenate([new[mixed], [True]])) if len(mixed) else np.zeros(0, np.int64)
        at = 0
        while at < len(bounds) - 1:              # whole anchors, some thousand chunks at a time
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 4000, side="right")) - 1)
            some = mixed[bounds[at]:bounds[to]]
            at = to
            for size, least, places in repeat_groups(text.take(pa.array(some)).to_pylist(), low[some], length):
                for t, s in places:
                    if high[some[t]] > least:
                        out.append((*chunk[some[t]], s, s + size, least))
            solo = some[low[some] != high[some]]  # what copies of one chunk share among themselves
            out += [(*chunk[i], 0, int(sizes[i]), int(low[i])) for i in solo]
            if len(out) > 100000:
                yield _mark_batch(out)
                out = []
        if out:
            yield _mark_batch(out)
    return run


def _mark_batch(out: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
    c, d, a, b, low = zip(*set(out))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                       pa.array(low, pa.int64())], names=["chunk", "chunk2", "from", "to", "low"])


def _starts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a run of equal (a, b) begins."""
    return np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])


def removed_spans(docs: DataFrame, min_length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, spans): the byte ranges to remove of every document that has
    any; th is the hash of its text. Each step is written to the shared
    folder, so only one shuffle of the texts is on disk at a time."""
    n = shuffle_partitions(docs)
    src = _keyed(docs, id_col, text_col)
    packed = src.mapInArrow(trimmed(_send_anchors(min_length, n)), PACKED.format("bucket"))
    repeated = materialise(packed.repartition(n, "bucket").mapInArrow(trimmed(_repeated_anchors(2 * n)), PACKED.format("blk")), "repeat-anchors")
    dealt = src.withColumn("blk", F.pmod(F.col("id").bitwiseXOR(F.col("th")), F.lit(2 * n)).cast("int"))
    chunks = dealt.groupBy("blk").cogroup(repeated.groupBy("blk")).applyInArrow(
        _chunks(min_length), "id long, th long, pos long, chunk long, chunk2 long, anchor long, high long, bytes binary")
    chunks = materialise(chunks, "repeat-chunks")
    marks = (chunks.where(F.col("bytes").isNotNull()).select("anchor", "chunk", "chunk2", "id", "high", "bytes")
             .repartition(n, "anchor")
             .mapInArrow(trimmed(_marks(min_length)), "chunk long, chunk2 long, from int, to int, low long"))
    marks = materialise(marks, "repeat-marks")
    places = chunks.select(F.col("id"), "th", "pos", "chunk", "chunk2")
    spans = (places.join(marks, ["chunk", "chunk2"]).where(F.col("low") < F.col("id"))
             .select("id", "th", F.struct((F.col("pos") + F.col("from")).alias("s"), (F.col("pos") + F.col("to")).alias("e")).alias("span"))
             .groupBy("id", "th").agg(F.collect_set("span").alias("spans")))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, s, e = united_lists(b.column(2))
            pairs = pa.StructArray.from_arrays([pa.array(s), pa.array(e)], names=["s", "e"])
            out = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), out.cast(SPANS)], names=["id", "th", "spans"])

    return materialise(spans.mapInArrow(trimmed(unite), "id long, th long, spans array<struct<s:bigint,e:bigint>>"), "repeat-spans")


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64(text).alias("th"), text.alias("text"), *more)


def united(spans) -> list[tuple[int, int]]:
    """Overlapping and touching ranges joined."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in (() if spans is None else spans)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def united_lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``united`` for every row of a column of span lists (null: empty):
    (row offsets, starts, ends)."""
    flat = col.flatten()
    s, e = (flat.field(i).to_numpy() for i in range(2))
    row = np.repeat(np.arange(len(col)), pc.fill_null(pc.list_value_length(col), 0).to_numpy())
    order = np.lexsort((s, row))
    s, row = s[order], row[order]
    reach = np.maximum.accumulate((row << 32) | e[order])
    begin = np.flatnonzero(np.append(True, ((row << 32) | s)[1:] > reach[:-1])) if len(s) else np.zeros(0, np.int64)
    last = np.append(begin[1:], len(s)) - 1 if len(s) else begin
    return np.searchsorted(row[begin], np.arange(len(col) + 1)), s[begin], reach[last] & ((1 << 32) - 1)


def remove_repeats(docs: DataFrame, min_length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row."""
    spans = removed_spans(docs, min_length, id_col, text_col)
    src = _keyed(docs, id_col, text_col, F.col(id_col).cast("long").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8_parts(b.column(1))
            cut, s, e = united_lists(b.column(2))
            removed = np.concatenate([[0], np.cumsum(e - s)])
            s, e, digests = s.tolist(), e.tolist(), []
            for begin, end, i, j in zip(off[:-1].tolist(), off[1:].tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                raw, digest, at = memoryview(data[begin:end]), hashlib.sha256(), 0
                for k in range(i, j):
                    digest.update(raw[at:s[k]])
                    at = e[k]
                digest.update(raw[at:])
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), pa.array(removed[cut[1:]] - removed[cut[:-1]]),
                                              pa.array(np.diff(cut)), pa.array(digests, pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return src.join(spans, ["id", "th"], "left").select("doc_id", "text", "spans").mapInArrow(
        trimmed(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, min_length: int = 50) -> DataFrame:
    """``docs`` (its own columns) with the repeated strings cut from the
    text, whole characters only; ``n_chars`` follows. A text left without a
    word leaves the table. The columns travel as one struct, so none can
    clash with the helpers."""
    spans = removed_spans(docs, min_length)

    @F.pandas_udf("string")
    def cut(text, marks):
        import pandas as pd
        out = []
        for t, m in zip(text, marks):
            if m is None or not len(m):
                out.append(t)
                continue
            raw, kept, at = t.encode(), [], 0
            for s, e in united(m):
                while s < e and raw[s] & 0xC0 == 0x80:
                    s += 1                       # a character cut in part stays
                while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
                    e -= 1
                kept.append(raw[at:s])
                at = e
            kept.append(raw[at:])
            out.append(b"".join(kept).decode())
        return pd.Series(out, dtype=object)

    had = _keyed(docs, "doc_id", "text", F.struct("*").alias("own"))
    marked = F.col("spans").isNotNull()
    new = had.join(spans, ["id", "th"], "left").withColumn(
        "new", F.when(marked, cut("text", F.coalesce(F.col("spans"), F.array().cast("array<struct<s:bigint,e:bigint>>")))))

    def column(c: str) -> Column:
        old = F.col("own").getField(c)
        if c == "text":
            return F.when(marked, F.col("new")).otherwise(old).alias(c)
        if c == "n_chars":
            return F.when(marked, F.char_length("new")).otherwise(old).cast(docs.schema[c].dataType).alias(c)
        return old.alias(c)

    return new.where(~marked | F.col("new").rlike("[^\\x20\\x09-\\x0D]")).select(*[column(c) for c in docs.columns])
