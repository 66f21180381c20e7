"""Reference resolution joins.

Dimensions are de-duplicated by key with an aggregate (one row per key),
then joined with an equi left join. No broadcast hint is given for
dimensions that grow with the data (customers, products, reps): the
planner broadcasts them only when their measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (adaptive execution re-checks at
run time) and otherwise shuffles both sides on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.text import category_key, internal_code_variants, lookup_key, partner_sku_prefix
from cargolens.functions.parse import to_int_loose


def keyed_dimension(dim: DataFrame, key: Column, id_col: str, payload: Sequence[str] = (),
                    prefer: Column | None = None, highest: bool = True) -> DataFrame:
    """One row per non-blank key: ``_key, <id_col>, payload…``.

    Duplicate keys: the row with the highest ``id_col`` wins (``highest``),
    or the lowest ``prefer`` struct when given.
    """
    order = prefer if prefer is not None else F.col(id_col)
    d = dim.select(key.alias("_key"), F.col(id_col), *payload, order.alias("_o")) \
        .where(F.col("_key").isNotNull() & (F.col("_key") != ""))
    agg = F.max if (highest and prefer is None) else F.min
    picked = d.groupBy("_key").agg(agg(F.struct("_o", F.struct(id_col, *payload).alias("_r"))).alias("_p"))
    return picked.select("_key", *[F.col(f"_p._r.{c}").alias(c) for c in [id_col, *payload]])


def lookup(df: DataFrame, key: Column, dim_keyed: DataFrame, out: dict[str, str]) -> DataFrame:
    """Left-join ``dim_keyed`` on ``key``; ``out`` maps dim columns → output names."""
    d = dim_keyed.select(F.col("_key").alias("_lk"), *[F.col(c).alias(o) for c, o in out.items()])
    j = df.withColumn("_probe", key)
    return j.join(d, j["_probe"] == d["_lk"], "left").drop("_probe", "_lk")


def header_item_join(headers: DataFrame, items: DataFrame, header_key: str, item_ref: str,
                     header_order: Sequence) -> tuple[DataFrame, DataFrame]:
    """Items joined to their header on trimmed text keys; the first header
    per key wins; item columns override same-named header columns.

    Returns (merged rows, orphan items); ``require_matches`` checks them.
    """
    h = headers.withColumn("_hk", F.trim(F.col(header_key).cast("string"))).where(F.col("_hk") != "")
    payload = [c for c in h.columns if c != "_hk"]
    o = F.struct(*[F.col(c) if isinstance(c, str) else c for c in header_order])
    first = h.groupBy("_hk").agg(F.min(F.struct(o.alias("_o"), F.struct(*payload).alias("_r"))).alias("_p"))
    header_only = [c for c in payload if c not in items.columns]
    first = first.select("_hk", *[F.col(f"_p._r.{c}").alias(c) for c in header_only])
    it = items.withColumn("_ik", F.trim(F.col(item_ref).cast("string"))).where(F.col("_ik") != "")
    merged = it.join(first, it["_ik"] == first["_hk"], "inner").drop("_ik", "_hk")
    orphans = it.join(first, it["_ik"] == first["_hk"], "left_anti").drop("_ik")
    return merged, orphans


def require_matches(merged: DataFrame, items: DataFrame) -> DataFrame:
    """Items without a single header are an error, not an empty result
    (two actions that stop at the first row). Returns ``merged``."""
    if merged.isEmpty() and not items.isEmpty():
        raise ValueError("no item matches a header: check the header key and the item reference")
    return merged


def items_for_orders(items: DataFrame, orders: DataFrame, item_ref: str, order_key: str,
                     item_filter: Column | None = None) -> DataFrame:
    """Items of the fetched orders (a semi join, not IN-lists)."""
    it = items if item_filter is None else items.where(item_filter)
    o = orders.select(F.col(order_key).alias("_ok")).distinct()
    return it.join(o, it[item_ref] == o["_ok"], "left_semi")


def alias_dimension(reps: DataFrame, ext_col: str, aliases_col: str, id_col: str) -> DataFrame:
    """A rep matches by its external id or any alias; the last rep
    (highest id) wins a shared key."""
    keys = F.array_union(F.array(F.trim(F.col(ext_col).cast("string"))),
                         F.transform(F.col(aliases_col), lambda a: F.trim(a)))
    ex = reps.select(F.explode(keys).alias("_k"), F.col(id_col))
    return keyed_dimension(ex, F.col("_k"), id_col)


def internal_code_dimension(reps: DataFrame, code_col: str, ext_col: str, id_col: str) -> DataFrame:
    """Every variant of a rep's internal code (as is / without leading
    zeros) → the preferred rep: one with an external id, then the lowest id."""
    ex = reps.select(F.explode(internal_code_variants(F.col(code_col))).alias("_v"), F.col(id_col), F.col(ext_col))
    has_ext = F.coalesce(F.trim(F.col(ext_col).cast("string")), F.lit("")) != ""
    prefer = F.struct(F.when(has_ext, 0).otherwise(1), F.col(id_col))
    return keyed_dimension(ex, F.col("_v"), id_col, prefer=prefer)


def lookup_internal_code(df: DataFrame, raw_key: Column, dim: DataFrame, out_col: str) -> DataFrame:
    """J5 probe: the normalised key as is first, then without leading zeros."""
    k = lookup_key(raw_key)
    stripped = F.regexp_replace(k, r"^0+", "")
    stripped = F.when(stripped == "", F.lit("0")).otherwise(stripped)
    id_col = [c for c in dim.columns if c != "_key"][0]
    a = lookup(df.withColumn("_k1", F.when(k != "", k)), F.col("_k1"), dim, {id_col: "_hit1"})
    b = lookup(a.withColumn("_k2", F.when(k != "", stripped)), F.col("_k2"), dim, {id_col: "_hit2"})
    return b.withColumn(out_col, F.coalesce("_hit1", "_hit2")).drop("_k1", "_k2", "_hit1", "_hit2")


def role_lookups(df: DataFrame, dim_keyed: DataFrame, roles: dict[str, Column], id_col: str) -> DataFrame:
    """Several roles (seller, assistant, supervisor) resolved on the same
    dimension; a failed lookup gives null."""
    out = df
    for role, key in roles.items():
        out = lookup(out, key, dim_keyed, {id_col: f"{role}_id"})
    return out


def cascade(df: DataFrame, steps: Sequence[tuple[Column, DataFrame]], id_col: str, out_col: str) -> DataFrame:
    """Try each (probe key, keyed dimension) in turn; first hit wins."""
    out = df
    hits = []
    for i, (key, dim) in enumerate(steps):
        out = lookup(out, key, dim, {id_col: f"_hit{i}"})
        hits.append(f"_hit{i}")
    return out.withColumn(out_col, F.coalesce(*hits)).drop(*hits)


def create_missing_products(items: DataFrame, products: DataFrame, order: Sequence[str], company_col: str = "company_id",
                            id_col: str = "product_id") -> tuple[DataFrame, DataFrame]:
    """Items → product by ecommerce id, else ean, else sku; an item that
    no stored product and no product made by an earlier item matches makes a
    new one. Returns (items with ``id_col``, new products).

    ``items``: company, ``ecommerce_id, ean, sku, order_code, name,
    unit_price``; ``products``: id, company, ``ecommerce_id, ean, sku``.
    ``order`` is the arrival order, unique per item. The new product's sku is
    the item's, else its ecommerce id, else its order code.

    Which items make a product is settled in rounds. Unmatched items are first
    reduced to their distinct keys (map-side), the earliest of each; one that
    is the earliest on every key it has makes a product; those that share a key with it
    are settled too; the rest go on. That is the result of going through the
    items one by one, since a maker has no maker before it on any key. Ids go on from
    the highest stored one in order of company and sku, so a rerun gives the same.
    """
    from cargolens.operators.running import dense_positions
    from cargolens.operators.upsert import null_safe_join
    from cargolens.session import write_once
    keys = ("ecommerce_id", "ean", "sku")
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    arrival = F.struct(*order)

    def keyed(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.to_json(F.struct(F.col(company_col).alias("a"), F.col(c).alias("b"))))

    own = items.withColumn("_at", arrival)
    for k in keys:
        own = own.withColumn(f"_{k}", text(k))
    own = own.withColumn("_sku", F.coalesce("_sku", "_ecommerce_id", text("order_code")))
    stored = products.select(id_col, company_col, *[text(k).alias(k) for k in keys])
    probe = {k: F.when(F.col(f"_{k}").isNotNull(), F.to_json(F.struct(F.col(company_col).alias("a"), F.col(f"_{k}").alias("b")))) for k in keys}
    # all lookups run on the distinct keys; the items themselves move once, to meet them
    scope = [company_col, *[f"_{k}" for k in keys]]
    matched = own.groupBy(*scope).agg(F.min(F.struct("_at", "name", "unit_price")).alias("_f"))
    for k in keys:
        matched = lookup(matched, probe[k], keyed_dimension(stored, keyed(k), id_col), {id_col: f"_old_{k}"})
    matched = write_once(matched, "product-keys")
    open_ = matched.where(F.coalesce(*[F.col(f"_old_{k}") for k in keys]).isNull())
    pool = write_once(open_.select(
        company_col, *[F.col(f"_{k}").alias(k) for k in keys], "_f._at", "_f.name", "_f.unit_price"), "product-pool")
    makers = None
    while not pool.isEmpty():
        first = pool
        for k in keys:
            low = pool.where(F.col(k).isNotNull()).groupBy(company_col, k).agg(F.min("_at").alias(f"_low_{k}"))
            first = first.join(low, [company_col, k], "left")
        leads = F.lit(True)
        for k in keys:
            leads = leads & (F.col(k).isNull() | (F.col("_at") == F.col(f"_low_{k}")))
        new = write_once(first.where(leads).select(*pool.columns), "product-makers")
        makers = new if makers is None else makers.unionByName(new)
        rest = pool
        for k in keys:
            rest = rest.join(new.where(F.col(k).isNotNull()).select(company_col, k).distinct(), [company_col, k], "left_anti")
        pool = write_once(rest.select(*pool.columns), "product-pool")
    if makers is None:
        makers = pool
    top = products.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    numbered = dense_positions(makers, [F.col(company_col), F.col("sku"), F.col("_at")], "_n")
    made = write_once(numbered.withColumn(id_col, (F.col("_n") + top + 1).cast(products.schema[id_col].dataType)), "product-new")
    new_products = made.select(id_col, company_col, *keys, "name", F.col("unit_price").alias("value"))

    out, hits = matched.drop("_f"), []
    for k in keys:                       # a product counts for the items after its maker only
        dim = made.where(F.col(k).isNotNull()).select(keyed(k).alias("_key"), id_col, F.col("_at").alias("_made"))
        out = lookup(out, probe[k], dim, {id_col: f"_new_{k}", "_made": f"_made_{k}"})
        hits += [F.col(f"_old_{k}"), F.when(F.col(f"_made_{k}") <= F.col("_at"), F.col(f"_new_{k}"))]
    out = null_safe_join(own.drop(id_col), out, scope, "left")
    return out.withColumn(id_col, F.coalesce(*hits)).select(*[c for c in items.columns if c != id_col], id_col), new_products


def quote_item_keys(partner_sku: Column, id_sku: Column) -> tuple[Column, Column]:
    """J8 probe keys: (store reference when the sku is a bare integer > 1000,
    sku prefix else idSku)."""
    s = F.trim(partner_sku.cast("string"))
    bare = s.rlike(r"^\d+$")
    ref = F.when(bare & (s.try_cast("double") > 1000), s)
    return ref, F.coalesce(partner_sku_prefix(s), F.trim(id_sku.cast("string")))


def order_item_keys(partner_sku: Column, id_sku: Column) -> tuple[Column, Column]:
    """J9 probe keys, the reverse order: (sku prefix else idSku, store
    reference when the sku is numeric)."""
    s = F.trim(partner_sku.cast("string"))
    return F.coalesce(partner_sku_prefix(s), F.trim(id_sku.cast("string"))), F.when(s.rlike(r"^\d+$"), s)


def erp_item_keys(product_key: Column, sku: Column) -> tuple[Column, Column]:
    """J10 probe keys: configured lookup key, else the integer sku."""
    k = F.nullif(F.trim(product_key.cast("string")), F.lit(""))
    return k, F.nullif(to_int_loose(sku), F.lit(0)).cast("string")


def existing_row_match(incoming: DataFrame, target: DataFrame, ext_col: str, legacy_col: str,
                       id_col: str = "id") -> DataFrame:
    """Match incoming rows to stored rows by external id, else by a legacy
    key (tax id, sku, order code, lower(name)). Adds ``matched_id``,
    ``matched_by`` ('external_id'/'legacy'/null) and ``ext_conflict`` (matched
    by legacy key while the stored row has another external id)."""
    by_ext = keyed_dimension(target, F.col(ext_col), id_col)
    by_leg = keyed_dimension(target, F.col(legacy_col), id_col, payload=[ext_col])
    a = lookup(incoming, F.col(ext_col), by_ext, {id_col: "_m1"})
    b = lookup(a, F.col(legacy_col), by_leg, {id_col: "_m2", ext_col: "_old_ext"})
    matched_by = F.when(F.col("_m1").isNotNull(), F.lit("external_id")).when(F.col("_m2").isNotNull(), F.lit("legacy"))
    conflict = F.col("_m1").isNull() & F.col("_m2").isNotNull() & F.col("_old_ext").isNotNull() \
        & (F.col("_old_ext") != F.col(ext_col))
    return (b.withColumn("matched_id", F.coalesce("_m1", "_m2")).withColumn("matched_by", matched_by)
            .withColumn("ext_conflict", conflict).drop("_m1", "_m2", "_old_ext"))


def category_dimension(categories: DataFrame, id_col: str = "id", name_col: str = "name",
                       level_col: str = "level", syn_col: str = "synonyms") -> DataFrame:
    """Normalised name or synonym → category; deepest level, then
    lowest id wins a shared key."""
    keys = F.array_union(F.array(F.col(name_col)), F.coalesce(F.col(syn_col), F.array().cast("array<string>")))
    ex = categories.select(F.explode(keys).alias("_t"), F.col(id_col), F.col(level_col))
    prefer = F.struct((-F.coalesce(F.col(level_col), F.lit(0))).alias("l"), F.col(id_col))
    return keyed_dimension(ex, category_key(F.col("_t")), id_col, prefer=prefer)


def auto_map_category(products: DataFrame, dim: DataFrame, candidates: Sequence[str], current_col: str,
                      out_col: str = "category_id") -> DataFrame:
    """J12 probe: first of (final category, subcategory, category) whose key
    hits; only for products without a category yet."""
    id_col = [c for c in dim.columns if c != "_key"][0]
    steps = [(F.when(F.col(current_col).isNull(), F.nullif(category_key(F.col(c)), F.lit(""))), dim)
             for c in candidates]
    out = cascade(products, steps, id_col, "_auto")
    return out.withColumn(out_col, F.coalesce(F.col(current_col), F.col("_auto"))).drop("_auto")


def supervisor_link(reps: DataFrame, key_col: str, sup_key: Column, id_col: str,
                    clear_missing: bool = True, current_col: str | None = None) -> DataFrame:
    """Rep → supervisor by a chosen key (self join). A rep without a
    supervisor key is cleared when ``clear_missing`` (else keeps
    ``current_col``)."""
    dim = keyed_dimension(reps, F.trim(F.col(key_col).cast("string")), id_col)
    out = lookup(reps.withColumn("_sk", F.trim(sup_key.cast("string"))), F.col("_sk"), dim, {id_col: "supervisor_id"})
    if not clear_missing and current_col:
        out = out.withColumn("supervisor_id", F.when((F.col("_sk").isNull()) | (F.col("_sk") == ""),
                                                     F.col(current_col)).otherwise(F.col("supervisor_id")))
    return out.drop("_sk")


def supervisor_link_by_code(reps: DataFrame, code_col: str, sup_key: Column, id_col: str) -> DataFrame:
    """J14, key = internal code: a supervisor is found by its code as stored
    or without leading zeros (J5's variants, last rep wins), whichever form
    the client sends."""
    codes = reps.select(F.explode(internal_code_variants(F.col(code_col))).alias("_v"), F.col(id_col))
    dim = keyed_dimension(codes, F.col("_v"), id_col)
    return lookup(reps, F.trim(sup_key.cast("string")), dim, {id_col: "supervisor_id"})


def supervisor_link_by_alias(reps: DataFrame, ext_col: str, aliases_col: str, sup_key: Column, id_col: str) -> DataFrame:
    """J14, key = external id: a supervisor is found by its external id or by
    any of its aliases (J4)."""
    return lookup(reps, F.trim(sup_key.cast("string")), alias_dimension(reps, ext_col, aliases_col, id_col), {id_col: "supervisor_id"})


def tenants_with_platform(companies: DataFrame, company_platforms: DataFrame, platforms: DataFrame,
                          slugs: Sequence[str], company_id: str = "company_id") -> DataFrame:
    """Companies linked to a platform whose slug is one of ``slugs``."""
    p = platforms.where(F.lower(F.trim(F.col("slug"))).isin([s.lower() for s in slugs])).select("platform_id")
    cp = company_platforms.join(p, "platform_id", "left_semi").select(company_id).distinct()
    return companies.join(cp, company_id, "left_semi")
