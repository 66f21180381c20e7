"""Alignment of two tokenisations of the same text, by divide and conquer.

Token bytes of both sides spell the same string (a space and the text), so
a byte offset where a token of either side ends is a cut that both share.
An interval of tokens is split at the shared cut nearest its middle: the
ends of the tokens around the middle are looked up among the other side's
ends by bisect, in windows that double until one is found, and both halves
go on. An interval without a shared cut inside is a leaf, one group of
tokens. All intervals of a run of documents go down together, a level a
round.

Every cut links the two tokens that end there. A pair of ids counts the
links it has in the whole corpus, and a link is best if no other pair with
its second id counts more. Pairs are counted per block of documents before
the shuffle; the corpus-wide counts travel back to each block once per
distinct pair of that block, never once per link, and no table of pairs is
held by the driver or broadcast. A block ends after ``BLOCK_LINKS`` links
(one document may have more).

Edge cases: texts that are null, empty or not spelled byte for byte by both
tokenisers have no tokens (zeros and an empty digest); null doc_ids and
repeated rows stand for themselves; ties of counts are all best; an empty
table gives an empty result; other columns are ignored. Texts with very
long runs of one kind go through the slower of two equal encoders, whose
time grows in proportion.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import materialise, slices, trimmed, utf8_parts
from cargolens.llm.packing import byte_letters

#: fixed value: how byte-level vocabularies of this kind part a text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"          # stands for a space in pieces
LONG_RUN = re.compile(r"\S{400}|\s{400}")
SLICE_BYTES = 1 << 18
BLOCK_LINKS = 1 << 20
BLOCK_ROWS = 1 << 14


class ByteTokens:
    """Ids of a byte-level vocabulary file, special strings as plain text.
    Where the merges are numbered like the ids (checked here), a rank table
    gives the same ids faster."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letter = {c: b for b, c in enumerate(byte_letters())}
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        entry = {i: bytes(letter[c] for c in t) for t, i in model["vocab"].items() if t not in special}
        self.bytes = [entry.get(i, b"") for i in range(max(model["vocab"].values()) + 1)]
        made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        first = len(entry) - len(made)
        self.ranks = None
        if all(model["vocab"][t] == first + k for k, t in enumerate(made)):
            import tiktoken
            self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={},
                                           mergeable_ranks={b: i for i, b in entry.items()})

    def encode(self, text: str) -> list[int]:
        if self.ranks is not None and not LONG_RUN.search(text):
            return self.ranks.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Ids of a piece model, which sets a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self.spelled(i) for i in range(self.model.get_piece_size())]

    def spelled(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of all integers in each [lo, hi)."""
    n = np.maximum(hi - lo, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + lo[owner]


def middle_cuts(a_ends: np.ndarray, b_ends: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each interval of tokens [lo, hi) of the first side the token
    whose end is the shared cut inside it that is nearest its middle, or -1."""
    middle = (lo + hi - 2) // 2
    cut = np.full(len(lo), -1)
    left, start, width = np.arange(len(lo)), 0, 1
    while len(left):
        m = middle[left]
        last = np.maximum(m - start + 1, 0) if start else m     # the middle itself counts once
        owner, token = ranges(np.concatenate([m + start, np.maximum(m - start - width + 1, lo[left])]),
                              np.concatenate([np.minimum(m + start + width, hi[left] - 1), last]))
        end = a_ends[token]
        hit = np.flatnonzero(b_ends[np.searchsorted(b_ends, end)] == end)
        owner, token = owner[hit] % len(left), token[hit]
        far = np.abs(token - m[owner]) * 2 + (token < m[owner])
        best = np.full(len(left), np.iinfo(np.int64).max)
        np.minimum.at(best, owner, far)
        near = far == best[owner]
        cut[left[owner[near]]] = token[near]
        start += width
        width *= 2
        over = (middle[left] + start >= hi[left] - 1) & (middle[left] - start < lo[left])
        left = left[(cut[left] < 0) & ~over]
    return cut


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_off: np.ndarray, b_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of either side that end at the shared cuts, in order. Ends
    rise over all documents; ``a_off``/``b_off`` bound each document's tokens
    (none are empty)."""
    lo, hi, b_lo, b_hi = a_off[:-1], a_off[1:], b_off[:-1], b_off[1:]
    found = [hi - 1]
    while True:
        whole = (hi - lo > 1) & (b_hi - b_lo > 1)
        lo, hi, b_lo, b_hi = lo[whole], hi[whole], b_lo[whole], b_hi[whole]
        if not len(lo):
            break
        cut = middle_cuts(a_ends, b_ends, lo, hi)
        split = np.flatnonzero(cut >= 0)
        lo, hi, b_lo, b_hi, cut = lo[split], hi[split], b_lo[split], b_hi[split], cut[split]
        found.append(cut)
        b_cut = np.searchsorted(b_ends, a_ends[cut]) + 1
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut + 1, hi])
        b_lo, b_hi = np.concatenate([b_lo, b_cut]), np.concatenate([b_cut, b_hi])
    a = np.sort(np.concatenate(found))
    return a, np.searchsorted(b_ends, a_ends[a])


def digits(size: int, inner: str, last: str) -> np.ndarray:
    """Each id in decimal with the mark after it, then each with the mark of a group's last."""
    return np.array([f"{i}{c}".encode() for c in (inner, last) for i in range(size)], object)


class Aligner:
    """Both tokenisers with their tables."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokens(a_path), PieceTokens(b_path)
        self.a_len = np.array([len(x) for x in self.a.bytes])
        self.b_len = np.array([len(x) for x in self.b.bytes])
        self.a_text = digits(len(self.a.bytes), ",", "|")
        self.b_text = digits(len(self.b.bytes), ",", ";")

    def tokens(self, text: bytes) -> tuple[list[int], list[int]]:
        """Ids of both sides, none unless both spell the text."""
        if not text:
            return [], []
        plain, spelled = text.decode(), b" " + text
        a, b = self.a.encode(" " + plain), self.b.encode(plain)
        if b"".join(map(self.a.bytes.__getitem__, a)) != spelled or b"".join(map(self.b.bytes.__getitem__, b)) != spelled:
            return [], []
        return a, b

    def align(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, digests, first ids of the links, second ids of the links)."""
        pairs = [self.tokens(t) for t in texts]
        n_a = np.array([len(a) for a, _ in pairs], np.int64)
        n_b = np.array([len(b) for _, b in pairs], np.int64)
        n_groups, digest = np.zeros(len(texts), np.int64), [""] * len(texts)
        docs = np.flatnonzero(n_a)
        if not len(docs):
            return n_a, n_b, n_groups, digest, docs, docs
        a = np.concatenate([np.array(pairs[d][0], np.int64) for d in docs])
        b = np.concatenate([np.array(pairs[d][1], np.int64) for d in docs])
        a_off, b_off = np.concatenate([[0], np.cumsum(n_a[docs])]), np.concatenate([[0], np.cumsum(n_b[docs])])
        a_cut, b_cut = shared_cuts(np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b]), a_off, b_off)
        n_groups[docs] = np.diff(np.searchsorted(a_cut, a_off))
        # each group's tokens of the first side, then of the second, all in one line
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[a_cut] = b_last[b_cut] = 1
        line = np.empty(len(a) + len(b), object)
        group = np.cumsum(a_last) - a_last
        line[np.arange(len(a)) + np.concatenate([[0], b_cut + 1])[group]] = self.a_text[a + a_last * len(self.a_len)]
        group = np.cumsum(b_last) - b_last
        line[np.arange(len(b)) + (a_cut + 1)[group]] = self.b_text[b + b_last * len(self.b_len)]
        line = line.tolist()
        for d, lo, hi in zip(docs.tolist(), (a_off + b_off)[:-1].tolist(), (a_off + b_off)[1:].tolist()):
            digest[d] = hashlib.sha256(b"".join(line[lo:hi])[:-1]).hexdigest()
        return n_a, n_b, n_groups, digest, a[a_cut], b[b_cut]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligned(a_path: str, b_path: str, kind: str):
    """Arrow mapper (doc_id, text) -> one row per document with its block and links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _ALIGNERS.get((a_path, b_path))
        if aligner is None:
            aligner = _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
        block, links, rows = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            data, off = utf8_parts(batch.column(1))
            for lo, hi in slices(off, SLICE_BYTES):
                raw = data[off[lo]:off[hi]].tobytes()
                at = (off[lo:hi + 1] - off[lo]).tolist()
                n_a, n_b, n_groups, digest, a, b = aligner.align([raw[i:j] for i, j in zip(at[:-1], at[1:])])
                pair = memoryview((a * len(aligner.b.bytes) + b).astype(kind).tobytes())
                step = np.dtype(kind).itemsize
                ends = np.cumsum(n_groups)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, block)), batch.column(0).slice(lo, hi - lo), pa.array(n_a), pa.array(n_b),
                     pa.array(n_groups), pa.array(digest, pa.string()),
                     pa.array([pair[step * i:step * j] for i, j in zip((ends - n_groups).tolist(), ends.tolist())], pa.binary())],
                    names=["block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])
                links, rows = links + len(a), rows + hi - lo
                if links >= BLOCK_LINKS or rows >= BLOCK_ROWS:
                    block, links, rows = block + 1, 0, 0
    return run


def pair_counts(kind: str):
    """Arrow mapper (block, pairs) -> (block, pair, n), a block's rows of a task together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(block: int, held: list[np.ndarray]) -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), block)), pa.array(pair.astype(np.int64)), pa.array(n)], names=["block", "pair", "n"])

        now, held = None, []
        for batch in batches:
            data, off = utf8_parts(batch.column(1))
            block = batch.column(0).to_numpy()
            first = np.flatnonzero(np.diff(block, prepend=-1))
            for i, j in zip(first.tolist(), [*first[1:].tolist(), len(block)]):
                if block[i] != now and held:
                    yield told(now, held)
                    held = []
                now = int(block[i])
                held.append(data[off[i]:off[j]].view(kind).copy())
        if held:
            yield told(now, held)
    return run


def link_sums(kind: str):
    """Cogroup of a block's documents with its pairs' corpus-wide counts."""
    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        data, _ = utf8_parts(docs.column("pairs"))
        key = pairs.column("pair").to_numpy()
        order = np.argsort(key)
        at = order[np.searchsorted(key, data.view(kind), sorter=order)] if len(key) else np.zeros(0, np.int64)
        ends = np.cumsum(docs.column("n_groups").to_numpy())

        def per_document(x: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(x[at])])[ends]
            return pa.array(np.diff(total, prepend=0).astype(np.int64))

        best = per_document(pairs.column("best").to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.table([docs.column("doc_id"), docs.column("n_a"), docs.column("n_b"), docs.column("n_groups"),
                         docs.column("n_groups"), best, per_document(pairs.column("n").to_numpy()),
                         docs.column("groups_sha256")],
                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document."""
    from tokenizers import Tokenizer
    import sentencepiece
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    kind = "<u4" if Tokenizer.from_file(a_path).get_vocab_size() * b_size < 1 << 32 else "<u8"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialise(src.mapInArrow(
        trimmed(aligned(a_path, b_path, kind)),
        "block long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary"), "alignment-links")
    by_block = materialise(rows.where("n_groups > 0").select("block", "pairs").mapInArrow(
        trimmed(pair_counts(kind)), "block long, pair long, n long"), "alignment-pairs")
    counts = by_block.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % b_size)
    highest = counts.groupBy("b").agg(F.max("n").alias("top"))
    known = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    told = by_block.select("block", "pair").distinct().join(known, "pair").select("block", "pair", "n", "best")
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        link_sums(kind), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                         "count_sum long, groups_sha256 string")
