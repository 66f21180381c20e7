"""Near-duplicate documents with Order MinHash and banded alignment.

Words are white-space tokens in lower case (A-Z); k-mers are five words.
Equal k-mers of a document are told apart by their occurrence number, so
k-mers are a sequence of distinct items. Each of ``sketches`` hash
functions picks the ``per_sketch`` smallest items and hashes them *in text
order*: two documents share a sketch if those items and their order agree,
which follows edit similarity rather than set overlap. Short documents
also get sketches of two items, as a single edit touches a large part of
their few k-mers.

Documents equal word for word are one class from the start and only their
first row goes on. Documents that share a sketch are candidates. A pair is
verified by alignment of the two item sequences inside the band that a
similar pair cannot leave: similarity = aligned items / (items of both -
aligned items), a Jaccard similarity that counts order; 0.8 or more links.

Every pair of candidates ends inside one class or is refuted. Each bucket
has a centre, the member that is in most buckets (the original of a group of
copies shares more sketches with them than they do with each other). First
each row is aligned with one anchor alone, the centre of its largest bucket,
and linked documents are joined into classes (minimum labels with pointer
jumping). In ``ROUNDS`` further rounds (fewer where one finds no
link) each row that is not yet in the class of one of its buckets' centres is
aligned with one such centre. So a round has at most one pair a row, however
many sketches rows share; rounds only spare the full comparison work.
What is left, members of one bucket in different classes, is compared
in full: the pair of a bucket of two by alignment; larger buckets are cut
into blocks of members, and each pair of blocks is one group of bounded
size, where a pair is looked at in the first sketch it shares, counted
(common items bound the alignment from above) and aligned only if the count
allows a link. Candidates of very different length cannot reach the
similarity and are not aligned. Texts are shuffled once, to become the item
sequences of the rows that share a sketch; pairs and blocks read those.

Edge cases: null and empty texts are one class of copies; texts of fewer
than five words are near-duplicates only if equal; rows that repeat an id
are rows of their own, and the class id is the smallest id of the class
(null if it has no other); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import MULT, TextBlock, materialise, mix64, slices, trimmed, utf8_parts

WORDS_PER_KMER = 5
SHORT = 8              # k-mers up to which a document also gets the short sketches
SLICE_BYTES = 2 << 20
BLOCK = 256            # members of a bucket that are compared with as many at once
ROUNDS = 2             # rounds of one pair a row after the first
BLOCK_ITEMS = 1 << 20  # items of a block, but for a longer single member


def labelled_kmers(block: TextBlock, width: int = WORDS_PER_KMER) -> tuple[np.ndarray, np.ndarray]:
    """(items of all rows one after the other, row offsets)."""
    h = block.hashes()
    n = np.maximum(block.counts - width + 1, 0)
    off = np.concatenate([[0], np.cumsum(n)])
    if not off[-1]:
        return np.zeros(0, np.uint64), off
    row = np.repeat(np.arange(len(n)), n)
    first = (np.cumsum(block.counts) - block.counts)[row] + np.arange(off[-1]) - off[row]
    key = np.zeros(off[-1], np.uint64)
    for i in range(width):
        key = (key ^ h[first + i]) * MULT
        key ^= key >> np.uint64(29)
    order = np.lexsort((key, row))              # stable: text order among equals
    k, r = key[order], row[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])])
    begin = np.flatnonzero(new)
    nth = np.arange(len(k)) - np.repeat(begin, np.diff(np.append(begin, len(k))))
    occurrence = np.empty(len(k), np.uint64)
    occurrence[order] = nth.astype(np.uint64)
    return mix64(key + occurrence * np.uint64(0x9FB21C651E98DF25)), off


def order_min_hash(items: np.ndarray, factors: np.ndarray, take: int) -> np.ndarray:
    """One sketch per factor: the ``take`` smallest items hashed in text order."""
    take = min(take, len(items))
    values = items[None, :] * factors[:, None]
    if take < len(items):
        at = np.sort(np.argpartition(values, take - 1, axis=1)[:, :take], axis=1)
    else:
        at = np.broadcast_to(np.arange(take), (len(factors), take))
    out = factors.copy()
    for i in range(take):
        out = mix64(out * MULT ^ items[at[:, i]])
    return out


def sketch_factors(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1000003)) | np.uint64(1)


def _signatures(sketches: int, per_sketch: int):
    """(id, th, text) -> id, th, k-mers, whole-text hashes, sketches."""
    factors, short = sketch_factors(sketches, 1), sketch_factors(sketches, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8_parts(batch.column(2))
            for lo, hi in slices(off, SLICE_BYTES):
                block = TextBlock(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                words = block.hashes()
                at = np.concatenate([[0], np.cumsum(block.counts)])
                rank = np.arange(len(words)) - at[block.doc]
                whole = []
                for salt in (1, 2):             # order-sensitive sums over a row's words
                    terms = np.append(mix64(words ^ mix64(rank.astype(np.uint64) + np.uint64(salt << 40))), np.uint64(0))
                    sums = np.cumsum(terms) - terms
                    whole.append((sums[at[1:]] - sums[at[:-1]]).astype(np.int64))
                items, ko = labelled_kmers(block)
                found = []
                for i in range(hi - lo):
                    own = items[ko[i]:ko[i + 1]]
                    s = order_min_hash(own, factors, per_sketch) if len(own) else own
                    if 0 < len(own) <= SHORT:
                        s = np.concatenate([s, order_min_hash(own, short, 2)])
                    found.append(s.astype(np.int64))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(s) for s in found])]), pa.int32()),
                    pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(ko), pa.int64()),
                     pa.array(whole[0]), pa.array(whole[1]), lists], names=["id", "th", "n", "w1", "w2", "sketches"])
    return run


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Order-counting Jaccard similarity of two item sequences, or 0.0 when
    it is below the threshold."""
    if not len(a) or not len(b):
        return 0.0
    least = int(np.ceil(threshold / (1 + threshold) * (len(a) + len(b)) - 1e-9))
    if min(len(a), len(b)) < least:
        return 0.0
    order = np.argsort(b)
    spot = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    j = order[spot]
    i = np.flatnonzero(b[j] == a)
    j = j[i]
    band = max(len(a), len(b)) - least          # aligned items of a similar pair lie this near
    near = np.abs(i - j) <= band
    j = j[near]
    if len(j) < least:
        return 0.0
    if (np.diff(j) > 0).all():
        m = len(j)
    else:
        tails: list[int] = []                   # longest increasing run of places
        for x in j.tolist():
            p = bisect_left(tails, x)
            if p == len(tails):
                tails.append(x)
            else:
                tails[p] = x
        m = len(tails)
    return m / (len(a) + len(b) - m) if m >= least else 0.0


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, sketches, text) -> row, sketches, items."""
    for batch in batches:
        data, off = utf8_parts(batch.column(2))
        for lo, hi in slices(off, SLICE_BYTES):
            items, at = labelled_kmers(TextBlock(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]))
            raw = memoryview(items.astype("<u8").tobytes())
            own = [raw[8 * i:8 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                                              pa.array(own, pa.binary())], names=["row", "sketches", "items"])


def _item_lists(col) -> list[np.ndarray]:
    data, off = utf8_parts(col)
    items, at = data.view("<u8"), (off // 8).tolist()
    return [items[i:j] for i, j in zip(at[:-1], at[1:])]


def _verified(threshold: float):
    """(a, b, items of a, items of b) -> the similar pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [aligned(x, y, threshold) >= threshold for x, y in zip(_item_lists(batch.column(2)), _item_lists(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok, pa.bool_())) for c in (0, 1)], names=["a", "b"])
    return run


def _blocks_compared(threshold: float):
    """Arrow group mapper over (sk, x, y, block, row, label, sketches, items),
    members of the blocks x and y of one bucket: links that join their
    classes."""
    def run(table: pa.Table) -> pa.Table:
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        sk = table["sk"][0].as_py()
        block, row = table["block"].to_numpy(), table["row"].to_numpy()
        _, root = np.unique(table["label"].to_numpy(), return_inverse=True)
        own = [np.asarray(v, np.int64) for v in table["sketches"].to_pylist()]
        wide = max(len(v) for v in own)
        sketch = np.zeros((len(own), wide), np.int64)
        held = np.zeros((len(own), wide), bool)
        for i, v in enumerate(own):
            sketch[i, :len(v)], held[i, :len(v)] = v, True
        items, at = _item_lists(table["items"]), []
        n = np.array([len(v) for v in items])
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        for a in left.tolist():
            b = right[right > a] if x == y else right
            b = b[(root[b] != root[a]) & (np.minimum(n[b], n[a]) >= np.maximum(n[b], n[a]) * threshold - 1e-9)]
            if not len(b):
                continue
            same = (sketch[b] == sketch[a]) & held[b] & held[a]
            b = b[same.any(axis=1) & (sketch[a][same.argmax(axis=1)] == sk)]
            if not len(b):
                continue
            mine = np.sort(items[a])
            theirs = np.concatenate([items[i] for i in b.tolist()])
            hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
            common = np.add.reduceat(hit, np.cumsum(n[b]) - n[b], dtype=np.int64)
            least = np.ceil(threshold / (1 + threshold) * (n[a] + n[b]) - 1e-9)
            for i in b[common >= least].tolist():
                if root[i] != root[a] and aligned(items[a], items[i], threshold) >= threshold:
                    at.append((min(row[a], row[i]), max(row[a], row[i])))
                    root[root == root[i]] = root[a]
        return pa.table({"a": pa.array([p[0] for p in at], pa.int64()), "b": pa.array([p[1] for p in at], pa.int64())})
    return run


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component, by
    minimum labels with pointer jumping; a few small shuffles per round."""
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    while True:
        labels = materialise(labels, "near-labels")
        heard = (both.join(labels.withColumnRenamed("node", "b"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard")))
        low = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        after = materialise(low.join(up, "low").select("node", "label", F.least("low", "jump").alias("new")), "near-step")
        if after.where(F.col("new") != F.col("label")).isEmpty():
            return after.select("node", F.col("new").alias("label"))
        labels = after.select("node", F.col("new").alias("label"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, sketches: int = 28, per_sketch: int = 5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th, class_id, class_size, n_links and kept (one row of each class) per row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    rows = materialise(src.mapInArrow(trimmed(_signatures(sketches, per_sketch)),
                                      "id long, th long, n long, w1 long, w2 long, sketches array<long>")
                       .withColumn("row", F.monotonically_increasing_id()), "near-rows")
    exact = rows.groupBy("w1", "w2").agg(F.min("row").alias("node"))
    firsts = rows.join(exact.select(F.col("node").alias("row")), "row").where(F.size("sketches") > 0)
    seen = firsts.select("row", "n", F.explode("sketches").alias("sk"))
    shared = seen.groupBy("sk").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialise(seen.join(shared, "sk"), "near-members")
    cover = members.groupBy("row").agg(F.count(F.lit(1)).alias("cover"))
    centre = members.join(cover, "row").groupBy("sk").agg(F.max(F.struct("cover", "row", "n")).alias("c"))
    placed = materialise(members.join(centre, "sk").select(
        "sk", "row", "n", "size", F.col("c.row").alias("centre"), F.col("c.n").alias("centre_n")), "near-placed")

    whose = F.struct("id", "th")                # rows equal in both are copies
    asked = rows.join(placed.select("row").distinct(), "row", "left_semi").select("row", "sketches", whose.alias("k"))
    texts = src.select(whose.alias("k"), "text").join(asked.select("k"), "k", "left_semi").dropDuplicates(["k"])
    items = materialise(asked.join(texts, "k").select("row", "sketches", "text").mapInArrow(
        trimmed(_sequences), "row long, sketches array<long>, items binary"), "near-items")

    def verified(pairs: DataFrame) -> DataFrame:
        first = items.select(F.col("row").alias("a"), F.col("items").alias("ia"))
        second = items.select(F.col("row").alias("b"), F.col("items").alias("ib"))
        return materialise(pairs.join(first, "a").join(second, "b").select("a", "b", "ia", "ib").mapInArrow(
            trimmed(_verified(threshold)), "a long, b long"), "near-verified")

    a, b = F.least("row", "centre").alias("a"), F.greatest("row", "centre").alias("b")
    meets = (F.col("row") != F.col("centre")) & (
        F.least("n", "centre_n") >= F.greatest("n", "centre_n") * F.lit(threshold))
    anchor = F.max_by("centre", F.struct("size", "sk")).alias("centre")
    tested = materialise(placed.where(meets).groupBy("row").agg(anchor).select(a, b).distinct(), "near-pairs")
    links = verified(tested)

    def open_pairs(labels: DataFrame) -> DataFrame:
        """Members that are not in the class of their bucket's centre, untested."""
        own, other = labels.select(F.col("node").alias("row"), "label"), labels.select(F.col("node").alias("centre"), F.col("label").alias("goal"))
        named = (placed.where(meets).join(own, "row", "left").join(other, "centre", "left")
                 .withColumn("label", F.coalesce("label", "row")).withColumn("goal", F.coalesce("goal", "centre")))
        return named.where("label <> goal").select("row", "centre", "size", "sk", a, b).join(tested, ["a", "b"], "left_anti")

    labels = connected(links)
    for _ in range(ROUNDS):
        more = materialise(open_pairs(labels).groupBy("row").agg(anchor).select(a, b).distinct(), "near-pairs")
        found = verified(more)
        tested = tested.union(more)
        if found.isEmpty():
            break
        links = links.union(found)
        labels = connected(links)

    # The rest, in full: the pair of a bucket of two, and blocks of the larger buckets.
    couples = verified(open_pairs(labels).where("size = 2").select("a", "b").distinct())
    named = materialise(placed.where("size > 2").join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "sk", "row", "n", F.coalesce("label", "row").alias("label")), "near-named")
    several = named.groupBy("sk").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_ITEMS)).alias("blocks")).where("x <> y").select("sk", "blocks")
    cells = (named.join(several, "sk").withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))
             .select("sk", "row", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o"))
             .select("sk", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"), "block", "row", "label"))
    blocks = materialise(cells.join(items, "row").groupBy("sk", "x", "y").applyInArrow(
        _blocks_compared(threshold), "a long, b long").distinct(), "near-verified")
    last = couples.union(blocks)
    if not last.isEmpty():
        links = links.union(last)
        labels = connected(links)

    degree = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).groupBy("node").agg(
        F.count(F.lit(1)).alias("n_links"))
    node = exact.join(labels, "node", "left").join(degree, "node", "left").select(
        "w1", "w2", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    placed = rows.select("row", "id", "th", "w1", "w2").join(node, ["w1", "w2"])
    by_class = placed.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                                           F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    return placed.join(by_class, "label").select(
        F.col("id").alias("doc_id"), "th", "class_id", "class_size", "n_links", (F.col("row") == F.col("first.row")).alias("kept"))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """One row of ``docs`` (its own columns) for each class. The columns
    travel as one struct, so none can clash with the helpers."""
    kept = near_duplicates(docs, **params).where("kept").select(F.struct(F.col("doc_id").alias("id"), "th").alias("key"))
    key = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th"))
    own = docs.select(key.alias("key"), F.struct("*").alias("own"))
    return own.dropDuplicates(["key"]).join(kept, "key", "left_semi").select("own.*")
