"""De-duplication and ranking.

"Arrival order" does not exist in Spark, so every operator takes explicit
order columns that end in a unique tie-break. First/last-row picks are
aggregates of a struct (``min``/``max`` compare field by field), which
combine map-side: a key holding a third of all rows is reduced in every
map task before the shuffle instead of being sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence, agg) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    ordered = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order))],
                       F.struct(*payload).alias("_row"))
    picked = df.groupBy(*keys).agg(agg(ordered).alias("_p"))
    return picked.select(*keys, *[F.col(f"_p._row.{c}").alias(c) for c in payload])


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key — the first in ``order``."""
    return _pick(df, keys, order, F.min)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key — the last in ``order``."""
    return _pick(df, keys, order, F.max)


def last_non_null_per_column(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """W4 (customers): fields merge — each column keeps its last non-null value."""
    o = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order))])
    payload = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c)
                                   for c in payload])


def sku_conflicts(df: DataFrame, sku_col: str, ext_col: str, order: Sequence) -> tuple[DataFrame, DataFrame]:
    """The first external id (in ``order``) owns a sku; rows of that sku
    with another external id are conflicts. Among the owner's rows the last
    one wins. Returns (kept rows, conflict rows).

    The owner of a sku and the last row of each (sku, external id) are both
    map-side aggregates, and only their results meet on the sku: a hot sku's
    rows are never reduced in one task. Conflicts are the rows of the skus
    that have several external ids (a semi-join-like inner join of the rows
    with those skus' owners, which adaptive execution splits for a hot sku
    since nothing above it needs the rows by sku).
    """
    o = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order))])
    ext = F.col(ext_col)
    owners = df.groupBy(sku_col).agg(F.min(F.struct(o.alias("o"), ext.alias("e"))).alias("_w"),
                                     (F.min(ext) != F.max(ext)).alias("_several"))
    owner = owners.select(F.col(sku_col).alias("_owned"), F.col("_w.e").alias("_owner"), "_several")
    last = last_wins(df, [sku_col, ext_col], order)
    kept = last.join(owner.drop("_several"), (F.col(sku_col) == F.col("_owned")) & (ext == F.col("_owner"))).select(*df.columns)
    contested = owner.where("_several").drop("_several")
    conflicts = df.join(contested, F.col(sku_col) == F.col("_owned")).where(ext != F.col("_owner")).select(*df.columns)
    return kept, conflicts


def first_by_name_ci(df: DataFrame, name_col: str, order: Sequence) -> DataFrame:
    """First row per lower(name); rows without a name are skipped."""
    d = df.where(F.col(name_col).isNotNull() & (F.trim(F.col(name_col)) != "")) \
        .withColumn("_lname", F.lower(F.col(name_col)))
    return first_wins(d, ["_lname"], order).drop("_lname")


def sticky_owner(visits: DataFrame, entity_col: str, rep_col: str, order: Sequence,
                 principals: Sequence, existing: DataFrame | None = None) -> DataFrame:
    """An entity's rep. A stored principal rep stays; else the first visit
    with a principal rep fixes it; else the last attending rep.

    ``existing``: optional ``(entity_col, rep_col)`` already stored.
    Output: ``entity_col, rep_col, fixed`` (``fixed``: the rep is a principal).
    """
    o = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(_cols(order))])
    is_p = F.col(rep_col).isin(list(principals))
    agg = visits.groupBy(entity_col).agg(
        F.min_by(F.col(rep_col), F.when(is_p, o)).alias("_first_p"),
        F.max_by(F.col(rep_col), o).alias("_last"))
    if existing is not None:
        ex = existing.select(F.col(entity_col).alias("_e"), F.col(rep_col).alias("_stored"))
        agg = agg.join(ex, agg[entity_col] == ex["_e"], "left").drop("_e")
        stored_p = F.when(F.col("_stored").isin(list(principals)), F.col("_stored"))
    else:
        stored_p = F.lit(None)
    rep = F.coalesce(stored_p, F.col("_first_p"), F.col("_last"))
    return agg.select(entity_col, rep.alias(rep_col), rep.isin(list(principals)).alias("fixed"))


def context_up_to(messages: DataFrame, targets: DataFrame, thread_col: str, id_col: str,
                  target_col: str = "target_id") -> DataFrame:
    """Every message of a thread up to (and including) the target
    message, one row per (target, message) — an equi join on the thread plus
    a bound, no per-thread list is built. Order by ``id_col`` when reading."""
    t = targets.select(F.col(thread_col).alias("_t"), F.col(target_col))
    j = messages.join(t, (messages[thread_col] == t["_t"]) & (messages[id_col] <= t[target_col]), "inner")
    return j.drop("_t")


def newest(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """The newest ``n`` rows (a top-k: per-partition heaps, then merge)."""
    return df.orderBy(*_cols(order)).limit(n)


def union_passes(passes: Sequence[DataFrame], keys: Sequence[str], order: Sequence) -> DataFrame:
    """Several passes over the same window; the later pass re-applies
    (last wins by ``order``, which should start with the pass number)."""
    u = passes[0]
    for p in passes[1:]:
        u = u.unionByName(p)
    return last_wins(u, keys, order)


def union_first_wins(lists: Sequence[DataFrame], keys: Sequence[str], order: Sequence) -> DataFrame:
    """Active ∪ inactive lists, the first occurrence of a key wins."""
    u = lists[0]
    for p in lists[1:]:
        u = u.unionByName(p)
    return first_wins(u, keys, order)
