"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cargolens.llm import queries, resampling
from cargolens.llm.common import TextBlock
from tests.conftest import SF_SMALL
from tests.llm.test_operators import CLASH, ODD

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORDS.findall((text or "").translate(LOWER))


def buckets_of(text):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    """(doc_id, n_features, weight, score, rank) of each of the (doc_id, text) rows."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text))
    for text in target:
        t.update(buckets_of(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        got = buckets_of(text)
        weight = sum(gain[b] for b in got)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = [r for r, (_, text) in zip(rows, docs) if len(words_of(text)) >= 20]
    fit.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(fit[:5 * len(fit) // 100]):
        r[4] = k + 1
    return Counter(map(tuple, rows))


def test_resample_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = queries.op13_bit_sliced_resampling(spark, SF_SMALL)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(map(tuple, got.collect())) == brute(docs, target)


def test_resample_odd_rows(spark):
    rng = random.Random(3)
    long_word = "é" * 90 + "x" * 300
    rows = [(r[0], r[1]) for r in ODD] + [(7, ODD[6][1]), (50, f"{long_word} a {long_word}"), (51, long_word)]
    rows += [(100 + i, " ".join(rng.choice("AB cd 9ü, 🙂 x-y".split()) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in [*CLASH, "idx", "weight", "score", "_pid"]])
    target = spark.createDataFrame([("cd ab 9ü x",), (None,), ("",)], "text string")
    assert Counter(map(tuple, resampling.resample(docs, target).collect())) == brute(rows, ["cd ab 9ü x"])
    none = target.limit(0)
    assert Counter(map(tuple, resampling.resample(docs, none).collect())) == brute(rows, [])
    assert resampling.resample(docs.limit(0), target).count() == 0


def test_planes_give_exact_sums():
    rng = np.random.default_rng(1)
    gain = rng.integers(-70000, 70000, 10000)
    counts = rng.integers(0, 3, (6, 10000))
    counts[2, 17], counts[3] = 1_000_003, 0
    assert (resampling.weights_of(counts, resampling.gain_planes(gain)) == counts @ gain).all()


def test_run_checksums():
    texts = ["a bc def", "", "é" * 200 + " x", "one"]
    raw = [t.encode() for t in texts]
    block = TextBlock(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), breaks=resampling._BREAKS)
    row, bucket = resampling.features(block, 10000)
    assert Counter(zip(row.tolist(), bucket.tolist())) == Counter((i, b) for i, t in enumerate(texts) for b in buckets_of(t))
