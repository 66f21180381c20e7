"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Vectors are turned into integers, floor(scale * x), and dealt to shards by
hash; each shard keeps, of equal vectors, the rows of the
k + 1 smallest ids, at most k of each (no other copy can enter a result),
and builds a ball tree over the distinct vectors. A batch of queries walks the tree, the child
of the higher bound first, bound = q . centre + |q| radius; each query
leaves a node whose bound is below the current kth score (or equal to it with no smaller
id to offer).

The kth score is shared: a first pass answers every query in one home
shard; the second pass, over all other shards, starts from that score. The
final k of each query come from the per-shard lists, at most k rows each.

Queries are streamed past a shard in batches after its vectors, so memory
holds one shard and one batch; a shard holds about ``shard_rows`` vectors.

Edge cases: vectors that are null, or hold null or non-finite components,
take no part; vectors of other lengths than the query's do not meet it;
ties go to the smaller id; a query meets fewer than k rows if fewer exist;
rows that repeat an id are rows of their own, but never an answer to that
id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.common import materialise

LEAF = 128
QUERY_BATCH = 512
EXACT = float(1 << 53)


class BallTree:
    """Distinct integer vectors of one shard, split at the median along the
    line between two far points. ``ids[i]`` are the ids of vector i."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        self.v, self.f = vectors, vectors.astype(np.float64)
        self.least = np.array([i[0] for i in ids], np.int64)
        self.centres, self.radii, self.firsts = [], [], []
        self.leaves: dict[int, tuple] = {}
        self.children: dict[int, tuple[int, int]] = {}
        self.ids = ids
        self._build(np.arange(len(vectors)))
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)
        self.firsts = np.array(self.firsts)
        self.widest = float(np.abs(self.f).max())

    def _build(self, rows: np.ndarray) -> int:
        at, pts = len(self.radii), self.f[rows]
        centre = pts.mean(axis=0)
        dist = np.sqrt(((pts - centre) ** 2).sum(axis=1))
        self.centres.append(centre)
        self.radii.append(float(dist.max()))
        self.firsts.append(int(self.least[rows].min()))
        if len(rows) <= LEAF:
            n = [len(self.ids[r]) for r in rows]
            self.leaves[at] = (rows, np.repeat(np.arange(len(rows)), n),
                               np.array([i for r in rows for i in self.ids[r]], np.int64))
            return at
        far = pts[dist.argmax()]
        other = pts[((pts - far) ** 2).sum(axis=1).argmax()]
        order = np.argsort(pts @ (other - far), kind="stable")
        half = len(rows) // 2
        left = self._build(rows[order[:half]])
        self.children[at] = (left, self._build(rows[order[half:]]))
        return at

    def scores(self, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Integer inner products (rows x queries); in floating point only
        where every partial sum is exact."""
        if self.widest * float(np.abs(queries).max()) * queries.shape[1] < EXACT:
            return self.f[rows] @ queries.T.astype(np.float64)
        return self.v[rows].astype(object) @ queries.T.astype(object)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, bound: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each query up to k (-score, id), sorted, among rows that
        score at least its bound."""
        q = queries.astype(np.float64)
        reach = self.centres @ q.T + np.outer(self.radii, np.sqrt((q * q).sum(axis=1)))
        reach = np.floor(reach + np.abs(reach) * 1e-9 + 1e-3)       # scores are whole numbers
        best: list[list[tuple[int, int]]] = [[] for _ in own]
        kth, last = bound.copy(), np.full(len(own), np.iinfo(np.int64).max)   # last: id of the kth, once k are held
        stack = [(0, np.arange(len(own)))]
        while stack:
            node, ask = stack.pop()
            r = reach[node, ask]
            ask = ask[(r > kth[ask]) | ((r == kth[ask]) & (self.firsts[node] <= last[ask]))]
            if not len(ask):
                continue
            if node in self.children:
                a, b = self.children[node]
                if reach[a, ask].sum() > reach[b, ask].sum():       # the higher bound is looked at first
                    a, b = b, a
                stack += [(a, ask), (b, ask)]
                continue
            rows, vec, ids = self.leaves[node]
            s = self.scores(rows, queries[ask])
            entry, col = np.nonzero((s >= kth[ask])[vec] & (ids[:, None] != own[ask]))
            order = np.argsort(col, kind="stable")
            cuts = np.flatnonzero(np.diff(col[order])) + 1
            for group in np.split(order, cuts) if len(order) else []:
                c = int(col[group[0]])
                i = int(ask[c])
                best[i] = sorted(best[i] + [(-int(s[vec[e], c]), int(ids[e])) for e in entry[group]])[:k]
                if len(best[i]) == k:
                    kth[i] = max(kth[i], -best[i][-1][0])
                    last[i] = best[i][-1][1] if kth[i] == -best[i][-1][0] else last[i]
        return best


def _search_shard(k: int):
    """Arrow mapper over rows sorted by (shard, kind): vectors (kind 0)
    build the trees (one for each length), queries (kind 1) meet them in
    batches."""
    names = ["row", "query_id", "vec_id", "score"]

    def eligible(ids: list[int]) -> list[int]:
        """Rows of the k + 1 smallest distinct ids, at most k of each."""
        return [i for i in sorted(set(ids))[:k + 1] for _ in range(min(k, ids.count(i)))] if len(ids) > k else sorted(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, trees = None, {}, None
        waiting: dict[int, list[tuple[bytes, int, float, int]]] = {}

        def plant() -> dict[int, BallTree]:
            by_dim: dict[int, list[bytes]] = {}
            for x in rows:
                if x:
                    by_dim.setdefault(len(x) // 8, []).append(x)
            return {d: BallTree(np.frombuffer(b"".join(xs), np.int64).reshape(-1, d),
                                [eligible(rows[x]) for x in xs]) for d, xs in by_dim.items()}

        def answer(dim: int) -> Iterator[pa.RecordBatch]:
            asked = waiting.pop(dim, [])
            if asked and dim in trees:
                own = np.array([a[1] for a in asked], np.int64)
                found = trees[dim].search(np.frombuffer(b"".join(a[0] for a in asked), np.int64).reshape(-1, dim),
                                          own, k, np.array([a[2] for a in asked]))
                out = [(a[3], a[1], i, -s) for a, hits in zip(asked, found) for s, i in hits]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

        for b in batches:
            sh, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
            ids, bound, number = (b.column(c).to_numpy() for c in ("vec_id", "bound", "row"))
            vec = b.column("v")
            flat, off = vec.values.to_numpy(), vec.offsets.to_numpy()
            for i in range(b.num_rows):
                if sh[i] != shard:
                    for dim in list(waiting):
                        yield from answer(dim)
                    shard, rows, trees = sh[i], {}, None
                v = flat[off[i]:off[i + 1]].tobytes()
                if kind[i] == 0:
                    rows.setdefault(v, []).append(int(ids[i]))
                    continue
                if trees is None:
                    trees = plant()
                dim = len(v) // 8
                waiting.setdefault(dim, []).append((v, int(ids[i]), float(bound[i]), int(number[i])))
                if len(waiting[dim]) == QUERY_BATCH:
                    yield from answer(dim)
        if trees is not None:
            for dim in list(waiting):
                yield from answer(dim)
    return run


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, scale: float = 256.0,
          shard_rows: int = 16384, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by
    ``query_every`` against all other rows."""
    comp = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = materialise(vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & finite)
                       .select(F.col(id_col).cast("long").alias("vec_id"), comp.cast("array<bigint>").alias("v"))
                       .withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    # Copies of one vector are dealt over up to 64 shards by id.
    data = rows.select(F.pmod(F.xxhash64("v", F.pmod("vec_id", F.lit(64))), F.lit(shards)).cast("int").alias("shard"),
                       F.lit(0).alias("kind"), "vec_id", "v", F.lit(float("-inf")).alias("bound"), "row")
    queries = rows.where(F.col("vec_id") % query_every == 0)
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    schema = "row long, query_id long, vec_id long, score long"

    def searched(asked: DataFrame) -> DataFrame:
        return (data.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
                .mapInArrow(_search_shard(k), schema))

    low = F.lit(float("-inf"))
    first = materialise(searched(queries.select(home.alias("shard"), F.lit(1).alias("kind"), "vec_id", "v", low.alias("bound"), "row")),
                        "topk-home")
    kth = first.groupBy("row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("kth"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)
    asked = (queries.join(kth, "row", "left")
             .select(F.explode(others).alias("shard"), F.lit(1).alias("kind"), "vec_id", "v",
                     F.coalesce(F.col("kth"), low).alias("bound"), "row"))
    found = first.unionByName(searched(asked)) if shards > 1 else first
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
