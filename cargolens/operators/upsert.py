"""Snapshot maintenance: upserts, inserts, slice and child replacement
(S5–S14).

Parquet tables have no MERGE: every operator computes the next snapshot
``target' = f(target, incoming)`` as a DataFrame; ``write_snapshot`` stores
it under a new path (never over the path being read). All are joins on the
natural key (hash-partitioned on it), so target and incoming never meet on
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.operators.dedupe import first_wins, last_wins


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join on ``keys`` where a null key meets a null key. ``right``'s
    other columns must not clash with ``left``'s; the keys are those of
    ``left`` (for a full outer join, of either side)."""
    r = right.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys)])
    j = left.join(r, same, how)
    if how in ("left_anti", "left_semi"):
        return j
    if how == "full_outer":
        for n, k in enumerate(keys):
            j = j.withColumn(k, F.coalesce(F.col(k), F.col(f"_k{n}")))
    return j.drop(*[f"_k{n}" for n in range(len(keys))])


def _arrival(df: DataFrame, order: Sequence | None, keys: Sequence[str]) -> list:
    """The given arrival order, else all other columns: any fixed order."""
    return list(order) if order else [c for c in df.columns if c not in keys] or list(keys)


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
           policy: dict[str, str] | None = None, default: str = "keep_old_when_null",
           order: Sequence | None = None) -> DataFrame:
    """Full outer join on ``keys`` (null keys meet); per column policy:

    * ``keep_old_when_null`` (S5) — ``coalesce(new, old)``;
    * ``overwrite`` (S6) — the incoming value, even null, when the key came in;
    * ``keep_old`` — never touched by incoming rows (e.g. manual fields).

    Several incoming rows of one key apply one after the other in ``order``
    (default: by all their columns): the last row's value is the new one, for
    S5 columns the last that is not null. Output has the target's columns
    plus ``_action`` ('insert' / 'update' / 'keep') for counters.
    """
    policy = policy or {}
    cols = [c for c in target.columns if c not in keys]
    inc_cols = [c for c in cols if c in incoming.columns]
    at = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{n}") for n, c in enumerate(_arrival(incoming, order, keys))])

    def newest(c: str) -> Column:
        rule = policy.get(c, default)
        known = F.lit(True) if rule == "overwrite" else F.col(c).isNotNull()
        return F.max_by(F.col(c), F.when(known, at)).alias(f"_n_{c}")

    t = target.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols]).withColumn("_t", F.lit(True))
    i = incoming.groupBy(*keys).agg(*[newest(c) for c in inc_cols], F.lit(True).alias("_i"))
    j = null_safe_join(t, i, keys, "full_outer")
    out = []
    for c in cols:
        old = F.col(f"_o_{c}")
        if c not in inc_cols:
            out.append(old.alias(c))
            continue
        new = F.col(f"_n_{c}")
        rule = policy.get(c, default)
        if rule == "overwrite":
            v = F.when(F.col("_i").isNotNull(), new).otherwise(old)
        elif rule == "keep_old":
            v = F.when(F.col("_t").isNotNull(), old).otherwise(new)
        else:
            v = F.coalesce(new, old)
        out.append(v.alias(c))
    action = (F.when(F.col("_t").isNull(), F.lit("insert")).when(F.col("_i").isNotNull(), F.lit("update"))
              .otherwise(F.lit("keep")))
    return j.select(*keys, *out, action.alias("_action"))


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """Incoming rows whose key (null keys included) is not stored yet are
    appended, the first of each key in ``order`` (default: by all columns)."""
    new = null_safe_join(incoming, target.select(*keys), keys, "left_anti")
    return target.unionByName(first_wins(new, list(keys), _arrival(new, order, keys)).select(*target.columns))


def only_insert(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                order: Sequence | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, the first of each new key; rows skipped because
    their key is already present)."""
    tk = target.select(*keys).distinct()
    new = null_safe_join(incoming, tk, keys, "left_anti")
    return (first_wins(new, list(keys), _arrival(new, order, keys)).select(*incoming.columns),
            null_safe_join(incoming, tk, keys, "left_semi"))


def replace_slices(table: DataFrame, fresh: DataFrame, slice_cols: Sequence[str],
                   slices: DataFrame | None = None) -> DataFrame:
    """Drop every stored row of the replaced slices (all slices present
    in ``fresh``, plus ``slices`` — the slices processed even when they
    produced no rows) and insert the fresh rows."""
    touched = fresh.select(*slice_cols)
    if slices is not None:
        touched = touched.unionByName(slices.select(*slice_cols))
    kept = null_safe_join(table, touched.distinct(), slice_cols, "left_anti")
    return kept.unionByName(fresh.select(*table.columns))


def replace_children(items: DataFrame, new_items: DataFrame, parent_key: str,
                     touched_parents: DataFrame | None = None) -> DataFrame:
    """All stored children of the touched parents go, also of those that
    bring none (``touched_parents``); the new ones come in."""
    touched = new_items.select(parent_key)
    if touched_parents is not None:
        touched = touched.unionByName(touched_parents.select(parent_key))
    kept = null_safe_join(items, touched.distinct(), [parent_key], "left_anti")
    return kept.unionByName(new_items.select(*items.columns))


def delete_vanished_children(items: DataFrame, incoming: DataFrame, parent_key: str, ext_col: str,
                             touched_parents: DataFrame, keep_when_none: bool = False) -> DataFrame:
    """For each touched parent: when some incoming children carry an
    external id, stored children with an external id not incoming are
    deleted; when none arrive, all its children are deleted (or kept, for the
    bookings variant, ``keep_when_none``)."""
    inc_ids = incoming.where(F.col(ext_col).isNotNull() & (F.trim(F.col(ext_col)) != "")) \
        .select(parent_key, ext_col).distinct()
    with_ids = inc_ids.select(parent_key).distinct()
    tp = touched_parents.select(parent_key).distinct()
    none_in = tp.join(with_ids, parent_key, "left_anti")
    # children of parents that did receive ids: keep those without external id
    # or whose id arrived
    flagged = items.join(with_ids.withColumn("_has", F.lit(True)), parent_key, "left") \
        .join(inc_ids.withColumn("_in", F.lit(True)), [parent_key, ext_col], "left")
    blank = F.col(ext_col).isNull() | (F.trim(F.col(ext_col)) == "")
    keep = F.col("_has").isNull() | blank | F.col("_in").isNotNull()
    out = flagged.where(keep).drop("_has", "_in")
    if not keep_when_none:
        out = out.join(none_in, parent_key, "left_anti")
    return out.select(*items.columns)


def force_range_replace(orders: DataFrame, items: DataFrame, incoming_orders: DataFrame,
                        incoming_items: DataFrame, date_col: str, code_col: str, id_col: str,
                        item_parent: str, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Remove stored orders dated in [start, end 23:59:59.999] or whose
    code is incoming, with their items; insert all incoming orders and items."""
    end_ts = F.lit(f"{end} 23:59:59.999").cast("timestamp")
    d = F.col(date_col).cast("timestamp")
    in_range = orders.where((d >= F.lit(start).cast("timestamp")) & (d <= end_ts)).select(id_col)
    by_code = orders.join(incoming_orders.select(code_col).distinct(), code_col, "left_semi").select(id_col)
    gone = in_range.unionByName(by_code).distinct()
    orders2 = orders.join(gone, id_col, "left_anti").unionByName(incoming_orders.select(*orders.columns))
    items2 = items.join(gone.withColumnRenamed(id_col, item_parent), item_parent, "left_anti") \
        .unionByName(incoming_items.select(*items.columns))
    return orders2, items2


def update_columns_from_values(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                               columns: Sequence[str], code_col: str | None = None, order: Sequence | None = None) -> DataFrame:
    """Set ``columns`` from an update list (left join on ``keys``); when
    ``code_col`` is given only codes that parse as a number > 0 apply. Of
    several updates of one key the last in ``order`` (default: by the
    columns) holds."""
    u = updates
    if code_col:
        n = F.trim(F.col(code_col).cast("string")).try_cast("double")
        u = u.where(n.isNotNull() & (n > 0))
    u = last_wins(u, list(keys), order or list(columns)).select(*keys, *[F.col(c).alias(f"_u_{c}") for c in columns])
    j = target.join(u.withColumn("_hit", F.lit(True)), list(keys), "left")
    for c in columns:
        j = j.withColumn(c, F.when(F.col("_hit").isNotNull(), F.col(f"_u_{c}")).otherwise(F.col(c)))
    return j.select(*target.columns)


def advance_cursor(control: DataFrame, processed: DataFrame, keys: Sequence[str], ts_col: str,
                   cursor_col: str = "last_processed_at") -> DataFrame:
    """Per key, the cursor moves to the greatest processed timestamp;
    other keys (and other control columns) are left as they are."""
    hw = processed.groupBy(*keys).agg(F.max(ts_col).alias("_hw"))
    j = control.join(hw, list(keys), "full_outer")
    cols = [c for c in control.columns if c not in keys and c != cursor_col]
    return j.select(*keys, *cols, F.greatest(F.col(cursor_col), F.col("_hw")).alias(cursor_col))


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Store a snapshot (a new directory per version; reading and writing the
    same path is not allowed). With ``partition_by`` and dynamic partition
    overwrite, only the slices present in ``df`` are replaced (S9)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
