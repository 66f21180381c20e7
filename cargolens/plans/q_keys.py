"""Key rules: repeated and null keys (S5–S10, S12, S13), atomic slices (S9),
new products (J7), header check (J1), supervisors by code or alias (J14),
forced freight orders (I16) and the whole entity sync (I18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import incremental as inc
from cargolens.operators import lookup as lk
from cargolens.operators import slices as sl
from cargolens.operators import upsert as up
from cargolens.plans.q_upsert import _S9_FRESH, _S9_TABLE, _target, TARGET_SQL
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables
from cargolens.streaming.micro_batch import scratch_path

# Incoming customers come twice (version 1 and 2), some with a null key.
_TWICE_SQL = """(select case when c_custkey % 50 = 1 then null else c_custkey end as c_custkey, v,
  case when (c_custkey + v) % 3 = 0 then null else c_name || ' v' || cast(v as varchar) end as name,
  c_acctbal + v as balance, case when v = 2 and c_custkey % 5 = 0 then null else lower(c_mktsegment) || cast(v as varchar) end as segment
  from customer, (select unnest([1, 2]) as v) x where c_custkey % 2 = 0 or c_custkey % 50 = 1)"""


def _twice(t):
    c = t.customer.where((F.col("c_custkey") % 2 == 0) | (F.col("c_custkey") % 50 == 1)).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("v"))
    k, v = F.col("c_custkey"), F.col("v")
    return c.select(F.when(k % 50 != 1, k).alias("c_custkey"), "v",
                    F.when((k + v) % 3 != 0, F.concat("c_name", F.lit(" v"), v.cast("string"))).alias("name"),
                    (F.col("c_acctbal") + v).alias("balance"),
                    F.when(~((v == 2) & (k % 5 == 0)), F.concat(F.lower("c_mktsegment"), v.cast("string"))).alias("segment"))


def _null_target(t):
    """The stored customers, one of them without a key."""
    return _target(t).withColumn("c_custkey", F.when(F.col("c_custkey") != 2, F.col("c_custkey")))


_NULL_TARGET_SQL = f"(select case when c_custkey <> 2 then c_custkey end as c_custkey, name, balance, segment from {TARGET_SQL} q)"
_ORDER_SQL = "row(v, balance)"


@query("s05_upsert_repeated_keys", oracle=f"""
with i as (select c_custkey, arg_max(name, {_ORDER_SQL}) filter (where name is not null) as name,
  arg_max(balance, {_ORDER_SQL}) as balance, arg_max(row(segment), {_ORDER_SQL}) as s from {_TWICE_SQL} q group by 1)
select coalesce(t.c_custkey, i.c_custkey) as c_custkey, coalesce(i.name, t.name) as name, coalesce(i.balance, t.balance) as balance,
  case when i.s is not null then struct_extract(i.s, 1) else t.segment end as segment,
  case when t.balance is null then 'insert' when i.balance is not null then 'update' else 'keep' end as _action
from {_NULL_TARGET_SQL} t full outer join i on t.c_custkey is not distinct from i.c_custkey
""")
def s05_upsert_repeated_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return up.upsert(_null_target(t), _twice(t), ["c_custkey"], policy={"segment": "overwrite"}, order=["v", "balance"])


@query("s07_insert_repeated_keys", oracle=f"""
select c_custkey, name, balance, segment from {TARGET_SQL} t
union all
select c_custkey, name, balance, segment from (select *, row_number() over (partition by c_custkey order by v, balance) rn from {_TWICE_SQL} q
  where c_custkey is null or c_custkey not in (select c_custkey from {TARGET_SQL} x)) y where rn = 1
""")
def s07_insert_repeated_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return up.insert_if_absent(_target(t), _twice(t), ["c_custkey"], order=["v", "balance"])


@query("s08_only_insert_repeated_keys", oracle=f"""
select c_custkey, v, false as skipped from (select *, row_number() over (partition by c_custkey order by v, balance) rn from {_TWICE_SQL} q
  where c_custkey is null or c_custkey not in (select c_custkey from {TARGET_SQL} x)) y where rn = 1
union all select c_custkey, v, true from {_TWICE_SQL} q where c_custkey in (select c_custkey from {TARGET_SQL} x)
""")
def s08_only_insert_repeated_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    new, skipped = up.only_insert(_target(t), _twice(t), ["c_custkey"], order=["v", "balance"])
    return new.select("c_custkey", "v", F.lit(False).alias("skipped")).unionByName(skipped.select("c_custkey", "v", F.lit(True).alias("skipped")))


@query("s09_atomic_slices", oracle=f"""
with tab as (select o_orderkey, case when company = '5-LOW' then null else company end as company, yr, value from {_S9_TABLE} t),
fresh as (select o_orderkey, case when company = '5-LOW' then null else company end as company, yr, value from {_S9_FRESH} f),
touched as (select company, yr from fresh union select null, 1997)
select t.* from tab t where not exists (select 1 from touched x where x.company is not distinct from t.company and x.yr = t.yr)
union all select * from fresh
""")
def s09_atomic_slices(spark, sf_dir):
    """Two commits to a slice table: the stored slices, then fresh ones (null companies too) and one that comes out empty."""
    o = Tables(spark, sf_dir).orders
    company = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("company")
    rows = o.select("o_orderkey", company, F.year("o_orderdate").alias("yr"), F.col("o_totalprice").alias("value"))
    path = scratch_path(spark, "slices")
    sl.commit_slices(rows.where("o_orderkey % 3 <> 0"), path, ["company", "yr"])
    fresh = rows.where("o_orderkey % 2 = 0 and yr in (1995, 1996)").withColumn("value", F.col("value") * 2)
    emptied = rows.where("company is null and yr = 1997").select("company", "yr").distinct()
    sl.commit_slices(fresh, path, ["company", "yr"], emptied)
    return sl.read_slices(spark, path, ["company", "yr"])


@query("s10_replace_children_touched", oracle="""
select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey % 3 <> 0 and l_orderkey % 2 <> 0 and l_orderkey % 5 <> 0
union all select l_orderkey, l_linenumber, l_quantity + 1 from lineitem where l_orderkey % 2 = 0 and l_linenumber <= 2
union all select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey % 3 <> 0 and l_orderkey % 2 = 0 and l_orderkey % 5 <> 0
  and l_orderkey not in (select l_orderkey from lineitem where l_orderkey % 2 = 0 and l_linenumber <= 2)
""")
def s10_replace_children_touched(spark, sf_dir):
    t = Tables(spark, sf_dir)
    items = t.lineitem.where("l_orderkey % 3 <> 0").select("l_orderkey", "l_linenumber", "l_quantity")
    new = t.lineitem.where("l_orderkey % 2 = 0 and l_linenumber <= 2").select("l_orderkey", "l_linenumber", (F.col("l_quantity") + 1).alias("l_quantity"))
    touched = t.orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return up.replace_children(items, new, "l_orderkey", touched)


@query("s12_force_range_items", oracle="""
with inc as (select o_orderkey from orders where o_orderkey % 2 = 0 and year(o_orderdate) = 1998),
gone as (select o_orderkey from orders where o_orderdate >= timestamp '1996-01-01' and o_orderdate <= timestamp '1996-12-31 23:59:59.999' union select o_orderkey from inc)
select l_orderkey, l_linenumber from lineitem where l_orderkey not in (select o_orderkey from gone)
union all select l_orderkey, l_linenumber from lineitem where l_orderkey in (select o_orderkey from inc) and l_linenumber <= 1
""")
def s12_force_range_items(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("code"), "o_orderdate", "o_totalprice")
    fresh = o.where((F.col("o_orderkey") % 2 == 0) & (F.year("o_orderdate") == 1998))
    items = t.lineitem.select("l_orderkey", "l_linenumber")
    fresh_items = items.join(fresh.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").where("l_linenumber <= 1")
    return up.force_range_replace(o, items, fresh, fresh_items, "o_orderdate", "code", "o_orderkey", "l_orderkey", "1996-01-01", "1996-12-31")[1]


@query("s13_status_of_repeated_codes", oracle="""
select cast(o_orderkey as varchar) as code, case when o_orderkey % 2 = 0 then 'status ' || cast(2 + o_orderkey % 3 as varchar) else o_orderstatus end as status
from orders where o_orderkey > 0 union all select '0', o_orderstatus from orders where o_orderkey = 0
""")
def s13_status_of_repeated_codes(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    target = o.select(F.col("o_orderkey").cast("string").alias("code"), F.col("o_orderstatus").alias("status"))
    updates = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("code"), F.explode(F.sequence(F.lit(1), F.lit(2) + F.col("o_orderkey") % 3)).alias("n"))
    return up.update_columns_from_values(target, updates.withColumn("status", F.concat(F.lit("status "), F.col("n").cast("string"))), ["code"], ["status"],
                                         code_col="code", order=["n"])


@query("i16_forced_freight_orders", oracle="""
select 'F' || cast(o_orderkey as varchar) as external_id, case when o_orderkey % 3 = 0 then 'update' else 'insert' end as action,
  case when o_orderkey % 2 = 0 then 2 else 1 end as n_lines
from orders where o_orderkey % 4 <> 1
union all select 'F' || cast(o_orderkey as varchar), 'stored', 1 from orders where o_orderkey % 4 = 1 and o_orderkey % 3 = 0
""")
def i16_forced_freight_orders(spark, sf_dir):
    """Forced: stored orders are updated and all their lines replaced, also where fewer or none come in."""
    o = Tables(spark, sf_dir).orders
    key = F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("external_id")
    stored, incoming = o.where("o_orderkey % 3 = 0").select(key), o.where("o_orderkey % 4 <> 1").select(key, "o_orderkey")
    plan = inc.freight_order_plan(incoming, stored, "external_id", force=True)
    stored_lines = stored.withColumn("line_index", F.lit(0))
    lines = incoming.select("external_id", F.explode(F.sequence(F.lit(0), F.lit(1) - F.col("o_orderkey") % 2)).alias("line_index")).withColumn(
        "line_index", F.col("line_index").cast("int"))
    after = up.replace_children(stored_lines, lines, "external_id", plan.where("action <> 'skip'"))
    n = after.groupBy("external_id").agg(F.count(F.lit(1)).cast("int").alias("n_lines"))
    return n.join(plan, "external_id", "left").select("external_id", F.coalesce("action", F.lit("stored")).alias("action"), "n_lines")


@query("j01_checked_header_items", oracle="""
select l_orderkey, l_linenumber, o_custkey from lineitem join orders on l_orderkey = o_orderkey where o_orderkey % 3 <> 0
""")
def j01_checked_header_items(spark, sf_dir):
    t = Tables(spark, sf_dir)
    headers = t.orders.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey")
    items = t.lineitem.select("l_orderkey", "l_linenumber")
    merged, _ = lk.header_item_join(headers, items, "o_orderkey", "l_orderkey", ["o_custkey"])
    return lk.require_matches(merged, items).select("l_orderkey", "l_linenumber", "o_custkey")


@query("j14_supervisor_by_code", oracle="""
with r as (select s_suppkey as id, lpad(cast(s_suppkey as varchar), 5, '0') as code,
  case when s_suppkey % 5 = 0 then null when s_suppkey % 2 = 0 then cast(s_suppkey // 2 as varchar) else lpad(cast(s_suppkey // 3 as varchar), 5, '0') end as sup from supplier)
select r.id, s.id as supervisor_id from r left join r s on r.sup = s.code or r.sup = coalesce(nullif(ltrim(s.code, '0'), ''), '0')
""")
def j14_supervisor_by_code(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    reps = s.select(F.col("s_suppkey").alias("id"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("code"),
                    F.expr("case when s_suppkey % 5 = 0 then null when s_suppkey % 2 = 0 then cast(s_suppkey div 2 as string) "
                           "else lpad(cast(s_suppkey div 3 as string), 5, '0') end").alias("sup"))
    return lk.supervisor_link_by_code(reps, "code", F.col("sup"), "id").select("id", "supervisor_id")


@query("j14_supervisor_by_alias", oracle="""
with r as (select s_suppkey as id, 'R' || cast(s_suppkey as varchar) as ext, case when s_suppkey % 2 = 0 then 'R' || cast(s_suppkey // 4 as varchar) else 'A' || cast(s_suppkey // 4 as varchar) end as sup from supplier)
select r.id, s.id as supervisor_id from r left join r s on r.sup = s.ext or r.sup = 'A' || cast(s.id as varchar)
""")
def j14_supervisor_by_alias(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    k = F.col("s_suppkey").cast("string")
    reps = s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("R"), k).alias("ext"), F.array(F.concat(F.lit("A"), k), F.lit("")).alias("aliases"),
                    F.expr("concat(if(s_suppkey % 2 = 0, 'R', 'A'), s_suppkey div 4)").alias("sup"))
    return lk.supervisor_link_by_alias(reps, "ext", "aliases", F.col("sup"), "id").select("id", "supervisor_id")


# Items of parts: even parts carry ecommerce id and sku, odd ones ean and sku; every third part is stored already.

def _market_items(t):
    p = F.col("l_partkey")
    return t.lineitem.select(
        F.col("l_orderkey"), "l_linenumber", F.col("l_suppkey"), "l_extendedprice", (p % 4).alias("company_id"),
        F.when(p % 2 == 0, p.cast("string")).alias("ecommerce_id"), F.when(p % 2 == 1, F.concat(F.lit("E"), p.cast("string"))).alias("ean"),
        F.concat(F.lit("S"), p.cast("string")).alias("sku"), F.col("l_orderkey").cast("string").alias("order_code"),
        F.concat(F.lit("Item "), p.cast("string")).alias("name"), F.col("l_extendedprice").alias("unit_price"), p.alias("part"))


def _market_products(t):
    p = F.col("p_partkey")
    return t.part.where("p_partkey % 3 = 0").select(
        p.alias("product_id"), (p % 4).alias("company_id"), F.when(p % 2 == 0, p.cast("string")).alias("ecommerce_id"),
        F.when(p % 2 == 1, F.concat(F.lit("E"), p.cast("string"))).alias("ean"), F.lit(None).cast("string").alias("sku"))


_ARRIVAL = ["l_orderkey", "l_linenumber", "part", "l_suppkey", "l_extendedprice"]
_J07_SQL = """
with m as (select l_partkey as part, l_partkey % 4 as company_id, 'S' || cast(l_partkey as varchar) as sku,
    arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as value
  from lineitem where l_partkey % 3 <> 0 group by 1),
n as (select *, (select max(p_partkey) from part where p_partkey % 3 = 0) + row_number() over (order by company_id, sku) as product_id from m)
"""


@query("j07_new_products", oracle=_J07_SQL + """
select product_id, company_id, case when part % 2 = 0 then cast(part as varchar) end as ecommerce_id, case when part % 2 = 1 then 'E' || cast(part as varchar) end as ean,
  sku, 'Item ' || cast(part as varchar) as name, value from n
""")
def j07_new_products(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return lk.create_missing_products(_market_items(t), _market_products(t), _ARRIVAL)[1]


@query("j07_item_products", oracle=_J07_SQL + """
select l_orderkey, l_linenumber, l_partkey as part, coalesce(n.product_id, l_partkey) as product_id from lineitem left join n on n.part = l_partkey
""")
def j07_item_products(spark, sf_dir):
    t = Tables(spark, sf_dir)
    items = lk.create_missing_products(_market_items(t), _market_products(t), _ARRIVAL)[0]
    return items.select("l_orderkey", "l_linenumber", "part", "product_id")


# The whole entity sync: a first run, then one with newer, older and vanished rows.

def erp_input(t, run: int):
    """Incoming rows of a run, from suppliers, nations, customers, parts and orders."""
    later = run == 2
    mark = F.lit(" v2") if later else F.lit("")
    s = t.supplier.where("s_suppkey % 3 <> 0" if not later else "s_suppkey % 2 = 0")
    reps = s.select((F.col("s_suppkey") % 2).alias("company_id"), F.col("s_suppkey").cast("string").alias("external_id"), F.concat("s_name", mark).alias("name"),
                    F.expr("if(s_suppkey % 4 = 0, concat('A', s_suppkey - 2), null)").alias("supervisor_key"),
                    F.array(F.concat(F.lit("A"), F.col("s_suppkey").cast("string"))).alias("aliases"))
    groups = t.nation.select((F.col("n_nationkey") % 2).alias("company_id"), F.col("n_nationkey").cast("string").alias("external_id"),
                             F.concat(F.lit("Group "), (F.col("n_nationkey") % 10).cast("string")).alias("name"))
    c = t.customer.where("c_custkey % 5 <> 0" if not later else "c_custkey % 3 = 0")
    customers = c.select((F.col("c_custkey") % 2).alias("company_id"), F.col("c_custkey").cast("string").alias("external_id"),
                         F.when(F.col("c_custkey") % 7 != run, F.concat("c_name", mark)).alias("name"), F.lit(run).alias("synced_at"),
                         (F.col("c_custkey") % 40).cast("string").alias("rep_key"), (F.col("c_nationkey") % 10).cast("string").alias("group_key"))
    p = t.part.where("p_partkey % 4 <> 0" if not later else "p_partkey % 2 = 0")
    products = p.select((F.col("p_partkey") % 2).alias("company_id"), F.col("p_partkey").cast("string").alias("external_id"),
                        F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("sku"), F.concat("p_name", mark).alias("name"))
    # second run: odd orders come with an older version, even ones with a newer version and without their lines above 3
    li = t.lineitem if not later else t.lineitem.where("l_orderkey % 2 = 1 or l_linenumber <= 3")
    rows = li.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("o_custkey") % 2).alias("company_id"), F.col("o_orderkey").cast("string").alias("order_key"), F.col("o_orderdate").alias("ordered_at"),
        F.col("o_custkey").cast("string").alias("customer_key"), (F.col("o_custkey") % 40).cast("string").alias("seller_key"),
        F.col("l_linenumber").cast("string").alias("item_external_id"), F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("product_key"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("unit_price"),
        (F.expr("if(o_orderkey % 2 = 0, 20, 5)") if later else F.lit(10)).alias("synced_at"))
    return {"representatives": reps, "customers_group": groups, "customers": customers, "products": products, "orders": rows}


def erp_store(spark, sf_dir) -> sl.SnapshotStore:
    t = Tables(spark, sf_dir)
    store = sl.SnapshotStore(spark, scratch_path(spark, "erp"))
    for run in (1, 2):
        sl.sync_erp(store, erp_input(t, run))
        store.commit()
    return sl.SnapshotStore(spark, store.path)


@query("i18_synced_entities", oracle="""
with r as (select s_suppkey as id, s_suppkey % 2 as company_id, s_name || case when s_suppkey % 2 = 0 then ' v2' else '' end as name,
  case when s_suppkey % 4 = 0 then s_suppkey - 2 end as sup from supplier where s_suppkey % 3 <> 0 or s_suppkey % 2 = 0),
r1 as (select id, company_id from r where id % 3 <> 0),
g as (select n_nationkey % 2 as company_id, min(cast(n_nationkey as varchar)) as external_id, 'Group ' || cast(n_nationkey % 10 as varchar) as name
  from nation group by n_nationkey % 2, n_nationkey % 10),
c as (select *, c_custkey % 2 as company_id, c_custkey % 5 <> 0 as one, c_custkey % 3 = 0 as two from customer where c_custkey % 5 <> 0 or c_custkey % 3 = 0),
p1 as (select p_partkey as id from part where p_partkey % 4 <> 0), p2 as (select p_partkey as id from part where p_partkey % 4 <> 0 or p_partkey % 2 = 0),
l as (select *, row_number() over (partition by l_orderkey, l_linenumber order by 'S' || cast(l_partkey as varchar) desc, l_quantity desc) as rn from lineitem),
o as (select *, o_orderkey % 2 = 0 and o_orderkey in (select l_orderkey from lineitem where l_linenumber <= 3) as again from orders)
select 'representatives' as entity, r.company_id, cast(r.id as varchar) as external_id, r.name as value, cast(s.id as varchar) as ref_a, cast(null as varchar) as ref_b
from r left join r s on s.id = r.sup and s.company_id = r.company_id
union all select 'customers_group', company_id, external_id, name, null, null from g
union all select 'customers', c.company_id, cast(c_custkey as varchar),
  case when two and c_custkey % 7 <> 2 then c_name || ' v2' when one and c_custkey % 7 <> 1 then c_name end,
  case when two then coalesce(cast(r.id as varchar), case when one then cast(r1.id as varchar) end) else cast(r1.id as varchar) end, g.external_id
from c left join r on r.id = c_custkey % 40 and r.company_id = c.company_id left join r1 on r1.id = c_custkey % 40 and r1.company_id = c.company_id
left join g on g.external_id = cast(c_nationkey % 10 as varchar) and g.company_id = c.company_id
union all select 'products', p_partkey % 2, cast(p_partkey as varchar), p_name || case when p_partkey % 2 = 0 then ' v2' else '' end, 'S' || cast(p_partkey as varchar), null
from part where p_partkey % 4 <> 0 or p_partkey % 2 = 0
union all select 'order_items', o_custkey % 2, cast(o_orderkey as varchar) || '/' || cast(l_linenumber as varchar), cast(cast(l_quantity as bigint) as varchar),
  case when again then cast(p2.id as varchar) else cast(p1.id as varchar) end, case when again then '20' else '10' end
from l join o on l_orderkey = o_orderkey left join p1 on p1.id = l_partkey and p1.id % 2 = o_custkey % 2 left join p2 on p2.id = l_partkey and p2.id % 2 = o_custkey % 2
where rn = 1 and (not again or l_linenumber <= 3)
""")
def i18_synced_entities(spark, sf_dir):
    store = erp_store(spark, sf_dir)
    none = F.lit(None).cast("string")

    def rows(entity, df, value, ref_a=none, ref_b=none, external_id=F.col("external_id")):
        return df.select(F.lit(entity).alias("entity"), F.col("company_id").cast("long").alias("company_id"), external_id.alias("external_id"),
                         value.alias("value"), ref_a.alias("ref_a"), ref_b.alias("ref_b"))

    name = F.col("name")
    versions = store.read("orders").select("company_id", F.col("external_id").alias("order_key"), "version")
    items = store.read("order_items").join(versions, ["company_id", "order_key"])
    return (rows("representatives", store.read("representatives"), name, F.col("supervisor_id"))
            .unionByName(rows("customers_group", store.read("customers_group"), name))
            .unionByName(rows("customers", store.read("customers"), name, F.col("representative_id"), F.col("group_id")))
            .unionByName(rows("products", store.read("products"), name, F.col("sku")))
            .unionByName(rows("order_items", items, F.col("quantity").cast("bigint").cast("string"), F.col("product_id"), F.col("version").cast("string"),
                              F.concat_ws("/", "order_key", "item_external_id"))))
