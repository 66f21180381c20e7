"""Each operator against a brute-force version on the sf0.001 tables, and on
a small table of odd rows (nulls, empty and long texts, ties, copies of
rows, clashing column names) and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

import corpus_pipeline
from cargolens.llm import html_main, lm_mixing, mixing, near_dup, packing, quality, queries, repeats, shards, tokens, topk
from cargolens.llm.common import utf8_parts
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30000))
PASSAGE = " ".join(f"p{i}" for i in range(80))
ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "Ä ö\x00ü 梦😀 '§", "de", None),
    (5, LONG, "en", "b"), (6, LONG + " tail", "en", "b"), (7, LONG, "en", "b"), (7, LONG, "en", "b"),
    (8, "x y z. " + PASSAGE, "en", "a"), (9, PASSAGE + " q r", "en", None), (10, "same same same same same same", "fr", "c"),
    (None, "no id here at all, but some words to count in it", None, "c"), (12, "a\n" * 50, "en", "a"), (13, "<|endoftext|> <s> ▁x  y", "en", "a")]
CLASH = "id th row key size n words lines label bucket blk class host text_key u rank bin".split()


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(-5).alias(c) for c in CLASH])


def windows(words, n=5):
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def test_main_text(spark):
    page = ('<body class="has-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use</div><main id="c1">'
            '<article class="post-12"><h1>T &amp; u</h1><div class="body"><p>One <b>two</b> &lt;x&gt;.<p>Three\n four<div class="ad-slot">Buy</div></div>'
            '</article><section id="comments"><p>I think so too, and I will tell everybody about it at length.</p></section></main>'
            '<form><p>Mail</p></form><footer>&copy; x</footer><script>var a="</div><p>no</p>";</script>')
    assert html_main.extract(page, [])[0] == "T & u\nOne two <x>.\nThree four"
    assert html_main.extract(None, []) == html_main.extract("", []) == ("", "")
    rows = queries.op1_consensus_main_text(spark, SF_SMALL).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert len(rows) == len(html) and all(r.n_chars == len(r.text) > 0 for r in rows)
    df = spark.createDataFrame([(1, None, None), (2, "x", ""), (2, "http://h/1", "<p>a<p>b")], "page_id long, url string, html string")
    assert sorted((r.page_id, r.text) for r in html_main.main_text(df).collect()) == [(1, ""), (2, ""), (2, "a\nb")]
    assert html_main.main_text(df.limit(0)).count() == 0


def test_scores(spark, docs, odd):
    words = {i: WORD.findall(t.translate(LOWER)) for i, t in docs.items()}
    train = [i for i in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for i in train for w in words[i])
    n, v = sum(count.values()) + len(train), len(count) + 1
    sums = Counter()
    for r in queries.op2_context_mixing_score(spark, SF_SMALL).collect():
        w = words[r.doc_id]
        base = sum(np.log10((count[x] + .5) / (n + .5 * (v + 1))) for x in w) + np.log10((len(train) + .5) / (n + .5 * (v + 1)))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(x in count for x in w) + 1, n)
        assert abs(base - r.base_score) < 1e-6 * abs(base) and r.score < 0
        sums["score"] += r.score
        sums["base"] += r.base_score
    assert sums["score"] > sums["base"]
    assert lm_mixing.score_documents(odd).count() == len(ODD)
    assert lm_mixing.score_documents(odd.limit(0)).count() == 0


def test_spelling_is_a_distribution():
    words = [b"the", b"then", b"they", b"on", b"one"] * 20
    data = np.frombuffer(b"".join(words), np.uint8)
    tables = lm_mixing.count_contexts(data, np.array([len(w) for w in words])).astype(np.float32)
    mixer = lm_mixing.Mixer()
    one = np.arange(256, dtype=np.uint8)            # all words of one byte and the share that goes on
    p = 2.0 ** mixer.log2_words(tables, one, np.ones(256, np.int64))
    assert 0 < p.sum() < 1


def test_shards(spark, docs, odd):
    rows = queries.op3_minimax_shards(spark, SF_SMALL).collect()
    slots, sizes, of = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        of[docs[r.doc_id]].add(r.shard)
        assert (r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 8, zlib.crc32(docs[r.doc_id].encode()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, of.values())) == 1
    assert set(sizes) == set(range(24)) and max(sizes.values()) < 1.6 * sum(sizes.values()) / 24
    assert shards.shard_documents(odd).count() == len(ODD) and shards.shard_documents(odd.limit(0)).count() == 0


def test_minimax_is_smallest(spark):
    rng = random.Random(5)
    sizes = [rng.randint(1, 60) for _ in range(400)]
    keys = sorted({rng.randint(-(1 << 62), 1 << 62) for _ in range(400)})
    df = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long")
    cuts = shards.minimax_cuts(df, 7, max_atoms=16)
    parts = Counter()
    for k, s in zip(keys, sizes):
        parts[sum(c < k for c in cuts)] += s
    ends = np.cumsum(sizes)
    assert max(parts.values()) == shards._smallest(ends, max(-(-sum(sizes) // 7), max(sizes)), 7)


def test_quality(spark, docs, odd):
    for r in queries.op4_line_quality(spark, SF_SMALL).collect():
        t = docs[r.doc_id]
        w = WORD.findall(t)
        c = windows(w)
        covered = {j for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r.kept and r.base_failed)
    assert quality.line_quality(odd).count() == len(ODD) and quality.keep_good(odd).columns == odd.columns
    assert quality.line_quality(odd.limit(0)).count() == 0


def test_quality_rejects_depleted(spark):
    words = lambda s: " ".join(f"{s}{i}" for i in range(12))
    rows = [(i, f"{words(f'own{i}')}\n{words('menu')}", "h") for i in range(40)]            # half their own
    rows += [(100 + i, f"{words('menu')}\n{words('foot')}\nx{i}", "h") for i in range(40)]  # hardly anything
    rows += [(200 + i, words("copy"), "h") for i in range(30)]                              # copies are one text
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality.line_quality(df).where("kept").collect()}
    assert kept == set(range(40)) | set(range(200, 230))


def test_quality_same_verdict_at_every_size(spark):
    """A line in half of a host's texts goes at 8, 40 and 400 texts; one in two texts or in few of many stays."""
    own = lambda s: " ".join(f"{s}w{i}" for i in range(12))
    rows = []
    for n in (8, 40, 400):
        for i in range(n):
            tail = own(f"menu{n}") if i % 2 else own(f"pair{n}") if i in (0, 2) else own(f"x{n}t{i}")
            rows.append((n * 1000 + i, f"{own(f'h{n}d{i}')}\n{tail}", f"host{n}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in quality.line_quality(df).collect():
        n, i = divmod(r.doc_id, 1000)
        assert r.removed_chars == (len(own(f"menu{n}")) if i % 2 else 0)


def test_packing(spark, docs, odd):
    from tokenizers import Tokenizer
    tok, where, lengths = Tokenizer.from_file(BPE), defaultdict(list), 0
    pieces = {(r.doc_id, r.piece): r for r in queries.op5_exact_fit_packing(spark, SF_SMALL).collect()}
    for i, t in docs.items():
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        for p, start in enumerate(range(0, len(ids), 4096)):
            r, chunk = pieces.pop((i, p)), ids[start:start + 4096]
            assert (r.start, r.length, r.ids_crc32) == (start, len(chunk), zlib.crc32(np.array(chunk, "<u4").tobytes()))
            where[r.sequence_id].append((r.offset, r.length))
            lengths += len(chunk)
    assert not pieces and len(where) <= -(-lengths // 4096) + 1
    for spots in where.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(odd, BPE).where("piece = 0").count() == len(ODD)
    assert packing.pack_documents(odd.limit(0), BPE).count() == 0


def test_word_ids_match_library():
    rng, memo = random.Random(3), packing.WordIds(BPE)
    bits = ["a", "b", " ", "\n", "É", "the", "é", "<|endoftext|>", "　", "\t", "\x00", "1", ".", "'s", "'LL", "梦", "😀", "Σ", "A", "\x85", "\x1c", "̈", "’"]
    for _ in range(300):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(5)]
        ids, at = packing.document_ids(*utf8_parts(pa.array(texts)), memo)
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == memo.tokenizer.encode(t, add_special_tokens=False).ids + [1]


def test_token_counts(spark, docs, odd):
    import sentencepiece
    sp, memo, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), tokens.SegmentCounts(tokens.piece_ranks(PIECES)), random.Random(3)
    bits = ["a", "b", " ", "  ", "\n", "▁", "the", "é", "<s>", "　", "\t", "\x00", "1", ".", "梦", "😀", "\r", "<0x0A>"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert tokens.count_text(t, memo) == len(sp.encode(t)), repr(t)
    for r in queries.op6_heap_token_counts(spark, SF_SMALL).collect():
        n = len(sp.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)
    assert tokens.count_tokens(odd, PIECES).count() == len(ODD) and tokens.count_tokens(odd.limit(0), PIECES).count() == 0


def test_near_duplicates(spark, docs, odd):
    items, where = {}, defaultdict(list)
    for i, t in docs.items():
        w = WORD.findall(t.translate(LOWER))
        items[i] = {(g, k) for g, n in windows(w).items() for k in range(n)}
        for g in items[i]:
            where[g].append(i)
    shared = Counter((a, b) for v in where.values() for a in v for b in v if a < b)
    rows = {r.doc_id: r for r in queries.op7_order_minhash(spark, SF_SMALL).collect()}
    for (a, b), m in shared.items():
        if m / (len(items[a]) + len(items[b]) - m) >= 0.8:
            assert rows[a].class_id == rows[b].class_id
    kept = Counter(r.class_id for r in rows.values() if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.class_id for r in rows.values()}
    found = near_dup.near_duplicates(odd).collect()
    assert len(found) == len(ODD) and {r.class_id for r in found if r.doc_id in (5, 6, 7)} == {5}
    assert near_dup.keep_one(odd).count() == len({r.class_id for r in found}) and near_dup.near_duplicates(odd.limit(0)).count() == 0


def star(rng, name, copies, n_words=204, changed=4):
    """An original among copies that are each like it, but not like each other."""
    base = [f"{name}{i}" for i in range(n_words)]
    out = []
    for c in range(copies):
        w = list(base)
        for at in rng.sample(range(0, n_words - 4, 5), changed):
            w[at + 4] = f"{name}x{c}x{at}"
        out.append(" ".join(w))
    return out[:copies // 2] + [" ".join(base)] + out[copies // 2:]


@pytest.mark.parametrize("copies, block", [(20, 4), (300, 32)])
def test_near_duplicates_star(spark, monkeypatch, copies, block):
    monkeypatch.setattr(near_dup, "BLOCK", block, raising=False)
    texts = star(random.Random(copies), "s", copies)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartitionByRange(6, "doc_id")
    assert {(r.class_id, r.class_size) for r in near_dup.near_duplicates(df).collect()} == {(0, len(texts))}


def test_near_duplicates_leave_no_pair_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = random.Random(11)
    base = [f"t{i}" for i in range(120)]
    texts = []
    for g in range(12):                         # templates: far from each other, but they share sketches
        own = list(base)
        for at in rng.sample(range(120), 9):
            own[at] = f"g{g}x{at}"
        for c in range(8):
            w = list(own)
            for at in rng.sample(range(120), 2):
                w[at] = f"c{g}x{c}x{at}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartitionByRange(6, "doc_id")
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    items, ko = near_dup.labelled_kmers(near_dup.TextBlock(*utf8_parts(pa.array(texts))))
    own = [items[ko[i]:ko[i + 1]] for i in range(len(texts))]
    sk = [set(near_dup.order_min_hash(x, near_dup.sketch_factors(28, 1), 5).tolist()) for x in own]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sk[a] & sk[b] and near_dup.aligned(own[a], own[b], 0.8) >= 0.8 and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    assert [found[i] for i in range(len(texts))] == label


def test_mix(spark, odd):
    rows = queries.op8_pareto_mix(spark, SF_SMALL).collect()
    src = {r.doc_id: r.source for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = src[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}
    want, open_ = {}, set(size)
    while open_:
        rest = (1.5 * sum(size.values()) - sum(want.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] > 2 * size[s]}
        want |= {s: 2.0 * size[s] for s in over} or {s: rest * weight[s] for s in open_}
        open_ = open_ - over if over else set()
    for s in size:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= max(r.size for r in rows if src[r.doc_id] == s)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op8_pareto_mix(spark, SF_SMALL).collect()))
    drawn = mixing.pareto_mix(odd).selectExpr("sum(copies)").first()[0]
    assert mixing.mix_documents(odd).count() == drawn and mixing.pareto_mix(odd).count() == len(ODD)
    assert mixing.pareto_mix(odd.limit(0)).count() == 0


def test_top_k_ties_and_odd_vectors(spark):
    rng = random.Random(2)
    vec = [(i, [rng.choice([0.0, 0.25, -0.5]) for _ in range(3)]) for i in range(300)]
    vec += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan"), 0.0, 0.0]), (350, [float("inf"), 0.0, 0.0]), (400, [1.0]), (401, [2.0]), (402, [])]
    vec += [(i, [0.25, 0.25, 0.25]) for i in range(500, 600)]
    df = spark.createDataFrame(vec, "vec_id long, embedding array<float>")
    ok = {i: [int(np.floor(256 * x)) for x in v] for i, v in vec if v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in ok if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(ok[q], ok[c])), c) for c in ok if c != q and len(ok[c]) == len(ok[q]))[:5]
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    for rows in (16384, 40):
        assert sorted(map(tuple, topk.top_k(df, shard_rows=rows).collect())) == sorted(want)
    assert topk.top_k(df.limit(0)).count() == 0


def brute_repeats(texts, length=50):
    seen, out = set(), {}
    for i in sorted(texts):
        x, starts = texts[i], []
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - length + 1):
            if x[p:p + length] in seen:
                gone[p:p + length] = True
            starts.append(x[p:p + length])
        seen.update(starts)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(x) else 0
        out[i] = (len(x), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(x, gone) if not g)).hexdigest())
    return out


def test_repeats(spark, docs, odd):
    want = brute_repeats({i: t.encode() for i, t in docs.items()})
    got = {r.doc_id: tuple(r)[1:] for r in queries.op10_interval_tree_repeats(spark, SF_SMALL).collect()}
    assert got == want
    rows = repeats.remove_repeats(odd).collect()
    assert len(rows) == len(ODD) and {r.n_removed for r in rows if r.doc_id == 7} == {len(LONG)}
    assert repeats.remove_repeats(odd.limit(0)).count() == 0 and repeats.without_repeats(odd).columns == odd.columns


def test_maximal_repeat_groups():
    texts = [b"xabcabcabcy", b"zabcabcq", b"zabcabcr"]
    found = {(n, tuple(sorted(p))) for n, _, p in repeats.repeat_groups(texts, np.arange(3), 3)}
    want = set()
    every = {t[i:j] for t in texts for i in range(len(t)) for j in range(i + 3, len(t) + 1)}
    for s in every:
        spots = [(k, i) for k, t in enumerate(texts) for i in range(len(t)) if t.startswith(s, i)]
        left = {texts[k][i - 1] if i else -k - 1 for k, i in spots}
        right = {texts[k][i + len(s)] if i + len(s) < len(texts[k]) else -k - 1 for k, i in spots}
        if len(spots) > 1 and len(left) > 1 and len(right) > 1:
            want.add((len(s), tuple(sorted(spots))))
    assert found == want


def test_pipeline(spark, docs):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and {r.doc_id for r in rows} <= set(docs)
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for spots in at.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 4096
