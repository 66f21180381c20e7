"""Extra columns named like any internal name of an operator, ids at the end
of their range, repeated ids, and the pipeline's stages one by one."""

import inspect
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cargolens.llm import (alignment, common, html_main, lm_mixing, mixing, near_dup, packing, quality, repeats, resampling, shards,
                           token_files, tokens, topk)
from tests.llm.test_operators import LONG, ODD, PASSAGE

BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LAST = (1 << 63) - 1
COLUMNS = "doc_id text lang source n_chars".split()


def internal_names(module, own):
    """Every identifier that the module (or the shared helpers) has in quotes."""
    source = inspect.getsource(module) + inspect.getsource(common)
    return sorted({n for n in re.findall(r"[\"']([A-Za-z_]\w*)[\"']", source) if n.lower() not in own})


def with_clashes(df, module):
    return df.select("*", *[F.lit(-5).alias(n) for n in internal_names(module, df.columns)])


@pytest.fixture(scope="module")
def plain(spark):
    rows = [*ODD, (LAST, "x y z. " + PASSAGE, "en", "b"), (-(1 << 63), PASSAGE, None, "b")]
    rows = [r if r[1] != LONG and r[1] != LONG + " tail" else (r[0], r[1][:30000], r[2], r[3]) for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").cache()


OPERATORS = [
    (lm_mixing, lm_mixing.score_documents), (shards, shards.shard_documents), (quality, quality.line_quality),
    (packing, lambda d: packing.pack_documents(d, BPE)), (tokens, lambda d: tokens.count_tokens(d, PIECES)),
    (near_dup, near_dup.near_duplicates), (mixing, mixing.pareto_mix), (repeats, repeats.remove_repeats),
    (token_files, lambda d: token_files.document_checksums(d, BPE)), (alignment, lambda d: alignment.align_documents(d, BYTES, PIECES)),
    (resampling, lambda d: resampling.resample(d, d.select("text").limit(3)))]


@pytest.mark.parametrize("module, operator", OPERATORS, ids=[m.__name__.split(".")[-1] for m, _ in OPERATORS])
def test_operators_ignore_other_columns(plain, module, operator):
    named = operator(with_clashes(plain, module))
    alone = operator(plain.select(*COLUMNS))
    skip = {"row", "sequence_id", "offset", "slot"}         # numbers that depend on where rows land
    cols = [c for c in alone.columns if c not in skip]
    assert named.columns == alone.columns
    assert Counter(map(str, named.select(*cols).collect())) == Counter(map(str, alone.select(*cols).collect()))


@pytest.mark.parametrize("module, stage", [(quality, quality.keep_good), (near_dup, near_dup.keep_one),
                                           (repeats, repeats.without_repeats), (mixing, mixing.mix_documents)],
                         ids=["keep_good", "keep_one", "without_repeats", "mix_documents"])
def test_stages_keep_other_columns(plain, module, stage):
    named = with_clashes(plain, module)
    got = stage(named)
    assert got.columns == named.columns
    rows = got.collect()
    assert Counter(map(str, (tuple(r)[:5] for r in rows))) == Counter(map(str, map(tuple, stage(plain).select(*COLUMNS).collect())))
    assert all(v == -5 for r in rows for v in tuple(r)[5:])


def test_pages_with_other_columns(spark):
    df = spark.createDataFrame([(1, "http://h/1", "<p>a<p>b"), (2, None, None)], "page_id long, url string, html string")
    got = html_main.main_text(with_clashes(df, html_main)).collect()
    assert Counter((r.page_id, r.text) for r in got) == Counter({(1, "a\nb"): 1, (2, ""): 1})


def test_last_id_stays(spark):
    docs = spark.createDataFrame([(1, PASSAGE), (LAST, PASSAGE + " tail"), (None, PASSAGE + " end")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs).collect()}
    assert set(got) == {1, LAST, None} and got[1] == 0 and min(got[LAST], got[None]) >= len(PASSAGE)


def test_equal_chunks_need_equal_digests():
    assert repeats._starts(np.array([1, 1, 1, 2]), np.array([7, 7, 8, 8])).tolist() == [True, False, True, True]


@pytest.mark.parametrize("shard_rows", [16384, 7])
def test_repeated_vector_ids(spark, shard_rows):
    rng = np.random.default_rng(3)
    base = rng.integers(-3, 4, (12, 4)) / 2
    rows = [(i % 9 * 10, base[i % 12].tolist()) for i in range(60)] + [(0, base[0].tolist())] * 9 + [(50, base[0].tolist())] * 3
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), topk)
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    want = Counter()
    for q, v in ints:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ints if c != q)[:5]
            want.update((q, r + 1, c, -s) for r, (s, c) in enumerate(best))
    assert Counter(map(tuple, topk.top_k(df, shard_rows=shard_rows).collect())) == want


def test_pipeline_stages_one_by_one(spark, plain):
    docs = plain
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == COLUMNS, name
        empty = stage(spark, docs.limit(0), "")
        assert empty.columns == COLUMNS and empty.count() == 0, name
        docs = after
    assert docs.count() > 0
