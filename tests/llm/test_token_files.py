"""Huffman-coded token files: code lengths against exhaustive search, round
trips, and the documents read back against the tokenizers library."""

import itertools
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cargolens.llm import queries, token_files
from cargolens.session import checkpoint_dir
from tests.conftest import SF_SMALL
from tests.llm.test_operators import CLASH, ODD

BPE = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    """(doc_id, start, n_tokens, crc) of rows in file order."""
    tok = Tokenizer.from_file(BPE)
    made = []
    for i, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        made.append((i is not None, i or 0, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)))
    at, out = 0, Counter()
    for known, i, crc, n in sorted(made):
        out[(i if known else None, at, n, crc)] += 1
        at += n
    return out


def test_files_hold_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op11_huffman_token_files(spark, SF_SMALL)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "start", "n_tokens", "ids_crc32")]
    assert Counter(map(tuple, got.collect())) == expected(rows)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in ODD] + [(None, "x"), (-(1 << 63), "low"), ((1 << 63) - 1, "high")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in [*CLASH, "ids", "crc"]])
    assert Counter(map(tuple, token_files.document_checksums(docs, BPE).collect())) == expected(rows)
    assert token_files.document_checksums(docs.limit(0), BPE).count() == 0
    one = spark.createDataFrame([(5, None)], "doc_id long, text string")           # a code of one symbol
    assert Counter(map(tuple, token_files.document_checksums(one, BPE).collect())) == expected([(5, None)])


def test_documents_span_blocks_and_damage_is_seen(spark):
    path = f"{checkpoint_dir(spark)}/blocks-{uuid.uuid4().hex}"
    rows = [(i, " ".join(f"w{(i * 31 + k) % 97}" for k in range(i * 7 % 200))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    token_files.write_token_files(docs, BPE, path, block=100)
    sizes = spark.read.format("binaryFile").load(f"{path}/data").collect()
    assert sum(bytes(r.content).count(token_files.MAGIC) for r in sizes) > 60
    got = token_files.read_token_files(spark, path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, n, c) for i, _, n, c in expected(rows))
    book = spark.read.parquet(f"{path}/codebook").collect()
    code = token_files.Code(np.array([r.id for r in book]), np.array([r.bits for r in book]))
    raw = np.frombuffer(bytes(max((r.content for r in sizes), key=len)), np.uint8)
    assert len(list(token_files.records(raw, code))) > 1
    for damaged in (raw[:-2], np.concatenate([raw[:1], raw[2:]])):
        with pytest.raises(ValueError):
            list(token_files.records(damaged, code))


def test_lengths_are_shortest():
    rng = random.Random(4)
    for _ in range(60):
        n, limit = rng.randint(2, 6), rng.randint(3, 4)
        counts = [rng.choice([1, 2, 3, 10, 50, 400]) for _ in range(n)]
        best = min(sum(c * b for c, b in zip(counts, bits)) for bits in itertools.product(range(1, limit + 1), repeat=n)
                   if sum(2.0 ** -b for b in bits) <= 1)
        bits = token_files.code_lengths(np.array(counts), limit)
        assert (bits >= 1).all() and (bits <= limit).all() and (2.0 ** -bits).sum() <= 1
        assert int((bits * counts).sum()) == best


@pytest.mark.parametrize("n_symbols, n", [(1, 1), (1, 200), (2, 63), (2, 64), (2, 65), (300, 5000), (65536, 70000)])
def test_code_round_trip(n_symbols, n):
    rng = np.random.default_rng(n)
    ids = rng.permutation(80000)[:n_symbols]
    counts = (1e9 / (1 + np.arange(n_symbols)) ** 1.5).astype(np.int64) + 1
    code = token_files.Code(ids, token_files.code_lengths(counts))
    text = rng.choice(ids, n).astype(np.uint32)
    coded, at = code.encode(text)
    assert (code.decode(np.frombuffer(coded, np.uint8), n, at[::64].astype("<u4"), 64) == text).all()
