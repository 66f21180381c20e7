"""Alignment of two tokenisations against a brute-force version."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cargolens.llm import alignment, queries
from cargolens.llm.packing import byte_letters
from tests.conftest import SF_SMALL
from tests.llm.test_operators import CLASH, ODD

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(rows, library):
    tok, sp = library
    letter = {c: i for i, c in enumerate(byte_letters())}
    a_bytes = {i: bytes(letter[c] for c in t) for t, i in json.load(open(A))["model"]["vocab"].items() if t != "<|endoftext|>"}
    b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
               for i in range(sp.get_piece_size())]
    made, count = [], Counter()
    for i, text in rows:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        spelled = b" " + (text or "").encode()
        if not text or b"".join(a_bytes[x] for x in a) != spelled or b"".join(b_bytes[x] for x in b) != spelled:
            made.append((i, 0, 0, [], ""))
            continue
        a_end = np.cumsum([len(a_bytes[x]) for x in a]).tolist()
        b_end = np.cumsum([len(b_bytes[x]) for x in b]).tolist()
        groups, links, p, q = [], [], 0, 0
        for end in sorted(set(a_end) & set(b_end)):
            r, s = a_end.index(end) + 1, b_end.index(end) + 1
            groups.append(",".join(map(str, a[p:r])) + "|" + ",".join(map(str, b[q:s])))
            links.append((a[r - 1], b[s - 1]))
            p, q = r, s
        count.update(links)
        made.append((i, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return Counter((i, na, nb, len(ls), len(ls), sum(count[x] == top[x[1]] for x in ls), sum(count[x] for x in ls), h)
                   for i, na, nb, ls, h in made)


def test_alignment_matches_brute_force(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op12_shared_cut_alignment(spark, SF_SMALL)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert Counter(map(tuple, got.collect())) == brute(rows, library)


def test_odd_rows(spark, library):
    rng = random.Random(8)
    letters = [*"ab é梦😀 \n\t'.\x00 ▁Ω9", "the ", " é", "<s>", "<|endoftext|>", "  ", "…", "​", "ﬁ", "\r\n", "word", "don't "]
    rows = [(r[0], r[1]) for r in ODD if r[1] is None or len(r[1]) < 10000]
    rows += [(200 + i, "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))) for i in range(400)]
    rows += [(700, "x" * 3000), (701, "梦" * 700 + "a" * 500), (702, " " * 900 + "end"), (703, "ab" * 3000 + "\n" * 600), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit(1).alias(c) for c in [*CLASH, "pair", "b", "n_a", "pairs"]])
    assert Counter(map(tuple, alignment.align_documents(docs, A, B).collect())) == brute(rows, library)
    assert alignment.align_documents(docs.limit(0), A, B).count() == 0


def test_small_blocks(spark, library):
    rows = [(i, f"the cat {i % 3} sat on don't {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, library)
    assert Counter(map(tuple, alignment.align_documents(docs.repartition(5), A, B).collect())) == want


def test_shared_cuts_are_the_common_ends():
    rng = random.Random(2)
    for _ in range(200):
        a_off, b_off, a_ends, b_ends, base = [0], [0], [], [], 0
        for _ in range(rng.randint(1, 4)):
            size = rng.randint(1, 200)
            share = rng.random()
            common = {x for x in range(1, size) if rng.random() < share * rng.random() ** 3}
            a = sorted(common | {x for x in range(1, size) if rng.random() < .3} | {size})
            b = sorted(common | {x for x in range(1, size) if rng.random() < .3} | {size})
            a_ends += [base + x for x in a]
            b_ends += [base + x for x in b]
            a_off.append(len(a_ends))
            b_off.append(len(b_ends))
            base += size
        i, j = alignment.shared_cuts(np.array(a_ends), np.array(b_ends), np.array(a_off), np.array(b_off))
        want = sorted(set(a_ends) & set(b_ends))
        assert np.array(a_ends)[i].tolist() == np.array(b_ends)[j].tolist() == want


def test_rank_table_parts_texts_like_the_file(library):
    """Every code point between letters, digits and spaces."""
    tok = library[0]
    ours = alignment.ByteTokens(A)
    assert ours.ranks is not None
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 64):
        text = "".join(f"a{c}b1{c}2 {c} .{c}." for c in points[at:at + 64])
        assert ours.encode(text) == tok.encode(text, add_special_tokens=False).ids, hex(at)
