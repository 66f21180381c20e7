"""Token ids in Huffman-coded files.

Documents are tokenised whole (an end id closes each), ordered by doc_id and
written as files of blocks. The ids' code is a canonical Huffman code of at
most ``MAX_BITS`` bits, made by package-merge from the counts of the whole
table, so the codebook is just (id, bits) and has at most as many rows as
the vocabulary. A block holds up to ``BLOCK_TOKENS`` ids, can be decoded
alone, and notes the bit offset of every ``STEP``-th id: decoding starts at
all of these offsets at once, each step looking the next ``MAX_BITS`` bits
of every lane up in one table. A lane that does not end where the next one
starts is an error.

Files are written by Spark's own writer (one record a row, one file a task),
so the commit of a job is atomic on any file system, and a task that runs
again replaces its file. A document never spans two files.

One record, little-endian, then a line feed that the writer adds::

    4 bytes  b"HTI1"
    5 * u32  ids, documents that end here, checkpoints, bytes of code, STEP
    i64 * d  doc_id of each document that ends here (0 where it is null)
    u8 * d   1 where the doc_id is null
    u32 * d  ids of this block up to and with the document's last
    u32 * c  bit offset of each checkpoint
    bytes    code, most significant bit first

Edge cases: a null or empty text is the end id alone; null doc_ids come
first; repeated ids are ordered by checksum, length and place; an empty
table gives no file and an empty result; other columns are ignored; a text
of any length is encoded in blocks, its ids being held by one task.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens.llm.common import materialise, shuffle_partitions, slices, trimmed, utf8_parts
from cargolens.llm.packing import WordIds, document_ids
from cargolens.session import checkpoint_dir

MAX_BITS = 16
BLOCK_TOKENS = 1 << 18
STEP = 64
MAGIC = b"HTI1"
SLICE_BYTES = 1 << 20
MEMO_WORDS = 1 << 20

_MEMOS: dict[str, WordIds] = {}


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol (all counts positive) in the shortest prefix code
    of at most ``max_bits`` bits, by package-merge: ``max_bits`` rounds pair
    the cheapest items of the round before and merge them with the symbols;
    a symbol's length is the number of rounds in which it is taken."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    single = items = counts[order].astype(np.int64)
    is_symbol = [np.ones(n, bool)]              # of each round's items, cheapest first
    for _ in range(max_bits - 1):
        pairs = items[:len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        items = np.concatenate([single, pairs])
        by_weight = np.argsort(items, kind="stable")
        is_symbol.append(by_weight < n)
        items = items[by_weight]
    length, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_symbol):
        symbols = int(flags[:take].sum())
        length[:symbols] += 1
        take = 2 * (take - symbols)
    out = np.empty(n, np.int64)
    out[order] = length
    return out


class Code:
    """A canonical code: symbols in order of (bits, id), codes counted up."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        ids, bits = ids[order].astype(np.int64), bits[order].astype(np.int64)
        share = np.int64(1) << (MAX_BITS - bits)
        size = int(ids.max(initial=-1)) + 1
        self.bits, self.code = np.zeros(size, np.int64), np.zeros(size, np.uint64)
        self.bits[ids] = bits
        self.code[ids] = ((np.cumsum(share) - share) >> (MAX_BITS - bits)).astype(np.uint64)
        table = np.repeat(ids << 5 | bits, share)
        self.table = np.zeros(1 << MAX_BITS, np.int64)
        self.table[:len(table)] = table

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(code, bit offset of each id)."""
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        at = ends - bits
        word = at >> 5
        value = self.code[ids] << (64 - (at & 31) - bits).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        value, word = np.bitwise_or.reduceat(value, first), word[first]
        out = np.zeros(int(word[-1]) + 2, np.uint32)
        out[word] = value >> np.uint64(32)
        out[word + 1] |= (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return out.astype(">u4").tobytes()[:(int(ends[-1]) + 7) // 8], at

    def decode(self, code: np.ndarray, n: int, points: np.ndarray, step: int) -> np.ndarray:
        """``n`` ids from bytes of code, all checkpoints in step."""
        padded = np.concatenate([code, np.zeros(step * MAX_BITS // 8 + 3, np.uint8)]).astype(np.int64)
        window = padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:]
        at = points.astype(np.int64)
        out = np.empty((step, len(at)), np.uint32)
        last = n - step * (len(at) - 1)                 # ids of the last lane
        end = int(at[-1])
        for k in range(step):
            found = self.table[window[at >> 3] >> (24 - MAX_BITS - (at & 7)) & ((1 << MAX_BITS) - 1)]
            out[k] = found >> 5
            at = at + (found & 31)
            if k == last - 1:
                end = int(at[-1])
        if (at[:-1] != points[1:]).any() or (end + 7) // 8 != len(code):
            raise ValueError("a block's code does not match its checkpoints")
        return out.T.ravel()[:n]


def record(code: Code, ids: np.ndarray, doc: np.ndarray, null: np.ndarray, ends: np.ndarray) -> bytes:
    """One block with the documents that end in it."""
    coded, at = code.encode(ids)
    points = at[::STEP]
    head = np.array([len(ids), len(doc), len(points), len(coded), STEP], "<u4")
    return b"".join([MAGIC, head.tobytes(), doc.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(),
                     ends.astype("<u4").tobytes(), points.astype("<u4").tobytes(), coded])


def records(content: np.ndarray, code: Code) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, doc_ids, nulls, ends) of each block of a file."""
    i = 0

    def part(kind: str, n: int) -> np.ndarray:
        nonlocal i
        size = np.dtype(kind).itemsize * n
        if i + size > len(content):
            raise ValueError("a block is cut short")
        i += size
        return content[i - size:i].view(kind)

    while i < len(content):
        if part("u1", 4).tobytes() != MAGIC:
            raise ValueError("not a block of token ids")
        n, docs, points, size, step = part("<u4", 5).tolist()
        doc, null, ends, at = part("<i8", docs), part("u1", docs), part("<u4", docs), part("<u4", points)
        yield code.decode(part("u1", size), n, at, step), doc, null, ends.astype(np.int64)
        i += 1                                          # the writer's line feed


def tokenised(path: str, kind: str):
    """Arrow mapper (doc_id, text) -> doc_id, n_tokens, crc, ids (as ``kind``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _MEMOS.get(path)
        if memo is None:
            memo = _MEMOS[path] = WordIds(path, MEMO_WORDS)
        for batch in batches:
            data, off = utf8_parts(batch.column(1))
            for lo, hi in slices(off, SLICE_BYTES):
                ids, at = document_ids(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], memo)
                raw, own, size = memoryview(ids.astype("<u4").tobytes()), memoryview(ids.astype(kind).tobytes()), np.dtype(kind).itemsize
                bounds = list(zip(at[:-1].tolist(), at[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)),
                     pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in bounds], pa.int64()),
                     pa.array([own[size * a:size * b] for a, b in bounds], pa.binary())],
                    names=["doc_id", "n_tokens", "crc", "ids"])
    return run


def id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    """(id, n) over the whole table, combined per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            got = np.bincount(utf8_parts(batch.column(0))[0].view(kind), minlength=len(total))
            got[:len(total)] += total
            total = got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(trimmed(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def encoded(code: Code, block: int, kind: str):
    """Arrow mapper: sorted (doc_id, ids) -> one row per record of the task's file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, doc, null, ends = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

        def cut(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, doc, null, ends
            at = d = 0
            while len(ids) - at >= block or (final and at < len(ids)):
                hi = min(len(ids), at + block)
                e = int(np.searchsorted(ends, hi, side="right"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([record(code, ids[at:hi], doc[d:e], null[d:e], ends[d:e] - at)], pa.binary())],
                    names=["record"])
                at, d = hi, e
            ids, doc, null, ends = ids[at:], doc[d:], null[d:], ends[d:] - at

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw, off = utf8_parts(part.column(1))
                ends = np.concatenate([ends, len(ids) + off[1:] // np.dtype(kind).itemsize])
                ids = np.concatenate([ids, raw.view(kind)])
                doc = np.concatenate([doc, part.column(0).fill_null(0).to_numpy()])
                null = np.concatenate([null, part.column(0).is_null().to_numpy(zero_copy_only=False)])
                yield from cut(False)
        yield from cut(True)
    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, block: int = BLOCK_TOKENS,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``path/codebook`` (Parquet: id, n, bits) and ``path/data`` (the
    files of blocks, in ascending doc_id order from file to file)."""
    spark = docs.sparkSession
    from tokenizers import Tokenizer
    kind = "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = materialise(
        src.mapInArrow(trimmed(tokenised(tokenizer_path, kind)), "doc_id long, n_tokens long, crc long, ids binary")
        .withColumn("row", F.monotonically_increasing_id()), "token-files-ids")
    counts = sorted((r["id"], r["n"]) for r in id_counts(tokens, kind).collect())     # at most the vocabulary
    ids, n = np.array(counts, np.int64).reshape(-1, 2).T
    bits = code_lengths(n)
    book = spark.createDataFrame(list(zip(ids.tolist(), n.tolist(), bits.tolist())), "id long, n long, bits int")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    order = [F.asc_nulls_first("doc_id"), F.asc("crc"), F.asc("n_tokens"), F.asc("row")]
    (tokens.repartitionByRange(shuffle_partitions(tokens), *order).sortWithinPartitions(*order)
     .select("doc_id", "ids").mapInArrow(trimmed(encoded(Code(ids, bits), block, kind)), "record binary")
     .select(F.col("record").cast("string").alias("value"))         # the bytes as they are
     .write.text(f"{path}/data"))


def file_number(path: Column) -> Column:
    """The place of a written file among the others."""
    return F.regexp_extract(path, r"part-(\d+)-[^/]*$", 1).cast("int")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """file, local_start (ids before it in its file), doc_id, n_tokens,
    ids_crc32 per document, decoded from the files."""
    book = spark.read.parquet(f"{path}/codebook").select("id", "bits").collect()    # at most the vocabulary
    code = Code(np.array([r["id"] for r in book], np.int64), np.array([r["bits"] for r in book], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in range(batch.num_rows):
                number = batch.column(0)[f].as_py()
                done = crc = n = 0                      # ids before the open document; its checksum and ids so far
                for ids, doc, null, ends in records(utf8_parts(batch.column(1).slice(f, 1))[0], code):
                    raw, lo = memoryview(ids.astype("<u4").tobytes()), 0
                    starts, sizes, sums = [], [], []
                    for hi in ends.tolist():
                        starts.append(done)
                        sizes.append(n + hi - lo)
                        sums.append(zlib.crc32(raw[4 * lo:4 * hi], crc))
                        done, crc, n, lo = done + sizes[-1], 0, 0, hi
                    crc, n = zlib.crc32(raw[4 * lo:], crc), n + len(ids) - lo
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(doc), number, np.int32)), pa.array(starts, pa.int64()),
                         pa.array(doc.astype(np.int64), mask=null.astype(bool)), pa.array(sizes, pa.int64()),
                         pa.array(sums, pa.int64())],
                        names=["file", "local_start", "doc_id", "n_tokens", "ids_crc32"])
                if n:
                    raise ValueError(f"file {number} ends inside a document")

    files = spark.read.format("binaryFile").load(f"{path}/data")
    return files.select(file_number(F.col("path")).alias("file"), "content").mapInArrow(
        trimmed(run), "file int, local_start long, doc_id long, n_tokens long, ids_crc32 long")


def document_checksums(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Write the documents' ids as files, read the files back, and give
    doc_id, start, n_tokens, ids_crc32 per document."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer_path, path, id_col=id_col, text_col=text_col)
    rows = materialise(read_token_files(spark, path), "token-files-read")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))              # one row a file
    before = totals.select("file", F.coalesce(F.sum("n").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(before, "file").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
