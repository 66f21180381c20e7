"""Token counts by heap-and-linked-list byte-pair merging.

A segment's characters form a doubly linked list; every adjacent pair that
spells a piece of the vocabulary waits in a heap by (rank, position). The
lowest is popped again and again, merged into its left symbol, and the two
new neighbouring pairs are pushed. The count is the initial symbols less
the merges; a symbol outside the vocabulary counts its UTF-8 bytes (byte
fallback). No ids are produced.

No piece holds a word mark after another character and none holds a line
feed, so merges never cross those places: texts are cut there and each
distinct segment is merged once per worker (a bounded memo).

Edge cases: null and empty texts have 0 tokens; a text of white space
counts its marks; equal rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"     # the word mark that stands for a space
MAX_CACHED = 1 << 20


def piece_ranks(path: str) -> dict[str, float]:
    """Rank (lower merges first) of every ordinary piece of a model file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return {sp.id_to_piece(i): -sp.get_score(i) for i in range(sp.get_piece_size()) if not skip(i)}


def merged_count(segment: str, ranks: dict[str, float]) -> int:
    """Tokens of one segment."""
    n = len(segment)
    symbol = list(segment)
    count = n
    if n > 1:
        get = ranks.get
        heap = []
        for i in range(n - 1):
            r = get(segment[i:i + 2])
            if r is not None:
                heap.append((r, i, 1, 1))
        if heap:
            heapq.heapify(heap)
            nxt = list(range(1, n + 1))
            prv = list(range(-1, n - 1))
            size = [1] * n                      # 0: merged away
            while heap:
                _, i, a, b = heapq.heappop(heap)
                j = nxt[i]
                if size[i] != a or j >= n or size[j] != b:
                    continue                    # one side has changed since
                symbol[i] += symbol[j]
                size[i] = a + b
                size[j] = 0
                count -= 1
                k = nxt[i] = nxt[j]
                if k < n:
                    prv[k] = i
                    r = get(symbol[i] + symbol[k])
                    if r is not None:
                        heapq.heappush(heap, (r, i, a + b, size[k]))
                h = prv[i]
                if h >= 0:
                    r = get(symbol[h] + symbol[i])
                    if r is not None:
                        heapq.heappush(heap, (r, h, size[h], a + b))
            symbol = [s for s, z in zip(symbol, size) if z]
    return count + sum(len(s.encode()) - 1 for s in symbol if s not in ranks)


class SegmentCounts(dict):
    """Memo of counts. A key is a segment without its first mark; further
    leading marks are spaces; a leading line feed stands for itself and for
    no mark."""

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, key: str) -> int:
        if key[:1] == "\n":
            n = 1 + (merged_count(key[1:], self.ranks) if len(key) > 1 else 0)
        else:
            n = merged_count(MARK + key.replace(" ", MARK), self.ranks)
        if len(self) >= MAX_CACHED:
            self.clear()
        self[key] = n
        return n


def keys_of(text: str) -> list[str]:
    """Keys of the segments of a text."""
    parts = text.replace(MARK, " ").replace("\n", " \n").split(" ")
    if "" not in parts:
        return parts
    keys, marks = [], 0
    for p in parts:
        if p == "":
            marks += 1
        elif p[0] == "\n":
            if marks:
                keys.append(" " * (marks - 1))
            keys.append(p)
            marks = 0
        else:
            keys.append(" " * marks + p)
            marks = 0
    if marks:
        keys.append(" " * (marks - 1))
    return keys


def count_text(text: str | None, memo: SegmentCounts) -> int:
    return sum(map(memo.__getitem__, keys_of(text))) if text else 0


_MEMOS: dict[str, SegmentCounts] = {}


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _MEMOS.get(model_path)
        if memo is None:
            memo = _MEMOS[model_path] = SegmentCounts(piece_ranks(model_path))
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n = [count_text(t, memo) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("doc_id"),
                      F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
                      F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["doc_id"]
    return (src.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
