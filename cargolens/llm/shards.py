"""Contiguous minimax sharding of atomic groups (DataFrame functions only).

Groups (rows with equal texts) are ordered by the 64-bit hash of their
text; their byte sizes form one ordered sequence that is cut into ``k``
contiguous shards. The smallest feasible capacity is found by binary
search, each candidate being checked greedily, and the cuts are those of
the greedy pass at that capacity.

The search never collects the groups. The driver holds *atoms*: contiguous
hash ranges with their summed size. Greedy over whole atoms gives an upper
bound of the capacity, total / k and the largest group a lower one; a cut
can then only fall inside the few atoms between those two bounds. These
are split further by the next hash bits (one small aggregate over the
group table) until every atom that a cut can touch is a single group, when
the answer is exact. At most ``max_atoms`` rows come to the driver in a
round, whatever the number of groups.

A group larger than an equal share of what is left cannot be balanced by
any contiguous cut; it takes a shard of its own (fewer than ``k`` such
groups exist) and the rest is cut over the remaining shards.

Slots are numbered without a large sort: rows of a shard are spread over
hash bins, bins are numbered locally and shifted by the sizes of the bins
before them, so a group holding a third of all rows is still numbered by
many tasks.

Edge cases: a null text counts as no bytes and joins the group of empty
texts; equal rows get different slots of one shard; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.common import materialise

FIRST_SHIFT = 48


def _greedy(ends: np.ndarray, capacity: int, k: int) -> list[int] | None:
    """Positions (byte prefix sums) of the cuts of a greedy pass over items
    that end at ``ends``; None if ``k`` shards do not hold them."""
    cuts, at = [], 0
    for _ in range(k):
        i = int(np.searchsorted(ends, at + capacity, side="right"))
        if i == len(ends):
            return cuts
        nxt = int(ends[i - 1]) if i else 0
        if nxt <= at:
            return None
        cuts.append(nxt)
        at = nxt
    return None


def _smallest(ends: np.ndarray, low: int, k: int) -> int:
    """Smallest capacity >= low for which the greedy pass fits k shards."""
    high = max(low, int(ends[-1]))
    while low < high:
        mid = (low + high) // 2
        if _greedy(ends, mid, k) is None:
            low = mid + 1
        else:
            high = mid
    return low


def minimax_cuts(groups: DataFrame, k: int, max_atoms: int = 1 << 17) -> list[int]:
    """The largest hash key of each shard but the last, for a table of
    groups (key long, size long). Fewer than k - 1 cuts leave shards empty."""
    def atoms_of(df: DataFrame, shift: int) -> list:
        lo = F.shiftleft(F.shiftright("key", shift), shift)
        return (df.groupBy(lo.alias("lo"))
                .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"),
                     F.max("size").alias("big"), F.max("key").alias("hi"))
                .collect())     # at most 2**(64 - shift) or max_atoms rows

    atoms = sorted((r.lo, r.hi, r.size, r.n, r.big) for r in atoms_of(groups, FIRST_SHIFT))
    if not atoms:
        return []
    total = sum(a[2] for a in atoms)
    floor = max(-(-total // k), max(a[4] for a in atoms))
    shift = FIRST_SHIFT
    while True:
        ends = np.cumsum([a[2] for a in atoms])
        capacity = _smallest(ends, floor, k)
        upper = _greedy(ends, capacity, k) or []
        # cut j lies between the whole-atom pass at the lower bound and j * capacity
        spans, at = [], 0
        for j in range(1, k):
            i = int(np.searchsorted(ends, at + floor, side="right"))
            at = int(ends[i - 1]) if i else 0
            spans.append((at, min(j * capacity, total)))
        starts = ends - np.array([a[2] for a in atoms])
        split = np.zeros(len(atoms), bool)
        for low, high in spans:
            split |= (starts < high) & (ends > low)
        split &= np.array([a[3] > 1 for a in atoms])
        if not split.any() or shift == 0:
            keys = [a[1] for a in atoms]
            return [keys[int(np.searchsorted(ends, c))] for c in upper]
        chosen = [a for a, s in zip(atoms, split) if s]
        bits = max(1, min(shift, int(np.log2(max(2, max_atoms // len(chosen))))))
        spark = groups.sparkSession
        ranges = spark.createDataFrame([(a[0],) for a in chosen], "at long")
        part = groups.join(F.broadcast(ranges), F.shiftleft(F.shiftright("key", shift), shift) == F.col("at"))
        shift -= bits
        finer = [(r.lo, r.hi, r.size, r.n, r.big) for r in atoms_of(part, shift)]
        atoms = sorted([a for a, s in zip(atoms, split) if not s] + finer)


def shard_of(key, cuts: list[int]):
    """Shard of a key: the number of cuts below it (at most k - 1 literals)."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(int(c)) for c in cuts]), lambda c: c < key))


def shard_documents(docs: DataFrame, shards: int = 24, bins: int = 1024,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("key")), "shard-rows")
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")

    # Groups above an equal share of what is left get shards of their own.
    largest = [(r.key, r.size) for r in groups.orderBy(F.desc("size"), "key").limit(shards).collect()]
    rest = groups.agg(F.sum("size")).first()[0] or 0
    own: list[int] = []
    for key, size in largest:
        if len(own) < shards - 1 and size * (shards - len(own)) > rest:
            own.append(key)
            rest -= size
        else:
            break
    others = groups.where(~F.col("key").isin(own)) if own else groups
    cuts = minimax_cuts(others, shards - len(own))
    shard = shard_of(F.col("key"), cuts)
    for i, key in enumerate(own):
        shard = F.when(F.col("key") == key, F.lit(shards - 1 - i)).otherwise(shard)

    placed = rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"),
                         F.pmod(F.xxhash64("doc_id", "key"), F.lit(bins)).cast("int").alias("bin"))
    before = (placed.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "bin", F.coalesce(F.sum("n").over(
                  Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0)).alias("before")))
    local = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "size")) - 1
    return (placed.withColumn("local", local).join(before, ["shard", "bin"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("local")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
