"""Lookup join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import lookup as lk
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables


# J1 ------------------------------------------------------------------------
_J1_HEADERS_SQL = """
with h0 as (select 1 as copy, o_orderkey, o_totalprice, o_orderstatus as status,
                   case when o_orderkey % 2 = 1 then ' ' || cast(o_orderkey as varchar) || ' ' else cast(o_orderkey as varchar) end as hkey
            from orders where o_orderkey % 10 <> 0
            union all
            select 2 as copy, o_orderkey, o_totalprice + 1, 'X' as status, cast(o_orderkey as varchar) as hkey
            from orders where o_orderstatus = 'P' and o_orderkey % 10 <> 0),
h as (select * from (select *, trim(hkey) as k, row_number() over (partition by trim(hkey) order by copy, o_orderkey) rn
                     from h0 where trim(hkey) <> '') x where rn = 1),
i as (select l_orderkey, l_linenumber, l_linestatus as status, l_quantity, trim(cast(l_orderkey as varchar)) as ik from lineitem)
"""


def _j1_inputs(t):
    o = t.orders.where(F.col("o_orderkey") % 10 != 0)
    key = F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" "))) \
        .otherwise(F.col("o_orderkey").cast("string"))
    h1 = o.select(F.lit(1).alias("copy"), "o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"),
                  key.alias("hkey"))
    h2 = o.where(F.col("o_orderstatus") == "P").select(
        F.lit(2).alias("copy"), "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.lit("X").alias("status"), F.col("o_orderkey").cast("string").alias("hkey"))
    items = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("status"), "l_quantity",
                              F.col("l_orderkey").cast("string").alias("order_ref"))
    return h1.unionByName(h2), items


@query("j01_header_item_join", oracle=_J1_HEADERS_SQL + """
select i.l_orderkey, i.l_linenumber, i.status, i.l_quantity, h.o_totalprice, h.copy
from i join h on i.ik = h.k
""")
def j01_header_item_join(spark, sf_dir):
    headers, items = _j1_inputs(Tables(spark, sf_dir))
    merged, _ = lk.header_item_join(headers, items, "hkey", "order_ref", ["copy", "o_orderkey"])
    return merged.select("l_orderkey", "l_linenumber", "status", "l_quantity", "o_totalprice", "copy")


@query("j01_header_item_orphans", oracle=_J1_HEADERS_SQL + """
select i.l_orderkey, i.l_linenumber from i where i.ik not in (select k from h)
""")
def j01_header_item_orphans(spark, sf_dir):
    headers, items = _j1_inputs(Tables(spark, sf_dir))
    _, orphans = lk.header_item_join(headers, items, "hkey", "order_ref", ["copy", "o_orderkey"])
    return orphans.select("l_orderkey", "l_linenumber")


@query("j02_items_for_orders", oracle="""
select l_orderkey, l_linenumber, l_quantity from lineitem
where l_quantity > 10 and l_orderkey in (select o_orderkey from orders where year(o_orderdate) = 1996)
""")
def j02_items_for_orders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fetched = t.orders.where(F.year("o_orderdate") == 1996)
    return lk.items_for_orders(t.lineitem, fetched, "l_orderkey", "o_orderkey", F.col("l_quantity") > 10) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@query("j03_choosable_key_lookup", oracle="""
with d as (select lpad(cast(c_custkey % 1000 as varchar), 6, '0') as k, max(c_custkey) as customer_id from customer group by 1)
select o_orderkey, d.customer_id from orders left join d on d.k = lpad(cast(o_custkey as varchar), 6, '0')
""")
def j03_choosable_key_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = lk.keyed_dimension(t.customer, F.lpad((F.col("c_custkey") % 1000).cast("string"), 6, "0"), "c_custkey")
    out = lk.lookup(t.orders, F.lpad(F.col("o_custkey").cast("string"), 6, "0"), dim, {"c_custkey": "customer_id"})
    return out.select("o_orderkey", "customer_id")


@query("j04_alias_lookup", oracle="""
with reps as (select s_suppkey as id, cast(s_suppkey as varchar) as k from supplier
              union all select s_suppkey, 'A' || cast(s_suppkey as varchar) from supplier
              union all select s_suppkey, 'B' || cast(s_suppkey % 10 as varchar) from supplier),
d as (select k, max(id) as rep_id from reps group by k),
l as (select l_orderkey, l_linenumber, case l_linenumber when 1 then cast(l_suppkey as varchar)
        when 2 then 'A' || cast(l_suppkey as varchar) when 3 then 'B' || cast(l_suppkey % 10 as varchar) else 'Z' end as k
      from lineitem)
select l_orderkey, l_linenumber, d.rep_id from l left join d on l.k = d.k
""")
def j04_alias_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    reps = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").cast("string").alias("external_id"),
                             F.array(F.concat(F.lit("A"), F.col("s_suppkey").cast("string")),
                                     F.concat(F.lit("B"), (F.col("s_suppkey") % 10).cast("string"))).alias("aliases"))
    dim = lk.alias_dimension(reps, "external_id", "aliases", "id")
    n = F.col("l_linenumber")
    key = (F.when(n == 1, F.col("l_suppkey").cast("string"))
           .when(n == 2, F.concat(F.lit("A"), F.col("l_suppkey").cast("string")))
           .when(n == 3, F.concat(F.lit("B"), (F.col("l_suppkey") % 10).cast("string"))).otherwise(F.lit("Z")))
    return lk.lookup(t.lineitem, key, dim, {"id": "rep_id"}).select("l_orderkey", "l_linenumber", "rep_id")


_J5_REPS_SQL = """(select c_custkey as id,
  case when c_custkey % 2 = 0 then lpad(cast(c_custkey % 700 as varchar), 6, '0') else cast(c_custkey % 700 as varchar) end as code,
  case when c_custkey % 3 = 0 then null else 'E' || cast(c_custkey as varchar) end as ext from customer)"""


@query("j05_leading_zero_lookup", oracle=f"""
with r as {_J5_REPS_SQL},
v as (select id, ext, code as v from r where code <> ''
      union select id, ext, case when regexp_replace(code, '^0+', '') = '' then '0' else regexp_replace(code, '^0+', '') end from r where code <> ''),
d as (select v, arg_min(id, row(case when coalesce(ext, '') <> '' then 0 else 1 end, id)) as rep_id from v group by v),
o as (select o_orderkey, case o_orderkey % 4 when 0 then cast(o_custkey % 700 as varchar)
        when 1 then cast(o_custkey % 700 as varchar) || '.0' when 2 then lpad(cast(o_custkey % 700 as varchar), 6, '0')
        else lpad(cast(o_custkey % 700 as varchar), 4, '0') end as raw from orders),
k as (select o_orderkey, raw, case when regexp_matches(raw, '^\\d+\\.0+$') then regexp_replace(raw, '\\.0+$', '') else raw end as k from o)
select k.o_orderkey, k.raw, coalesce(d1.rep_id, d2.rep_id) as rep_id
from k left join d d1 on d1.v = k.k
left join d d2 on d2.v = (case when regexp_replace(k.k, '^0+', '') = '' then '0' else regexp_replace(k.k, '^0+', '') end)
""")
def j05_leading_zero_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = F.col("c_custkey") % 700
    reps = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, F.lpad(m.cast("string"), 6, "0")).otherwise(m.cast("string")).alias("code"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("E"), F.col("c_custkey").cast("string"))).alias("ext"))
    dim = lk.internal_code_dimension(reps, "code", "ext", "id")
    om = (F.col("o_custkey") % 700).cast("string")
    k = F.col("o_orderkey") % 4
    raw = (F.when(k == 0, om).when(k == 1, F.concat(om, F.lit(".0"))).when(k == 2, F.lpad(om, 6, "0"))
           .otherwise(F.lpad(om, 4, "0")))
    o = t.orders.select("o_orderkey", raw.alias("raw"))
    return lk.lookup_internal_code(o, F.col("raw"), dim, "rep_id").select("o_orderkey", "raw", "rep_id")


@query("j06_role_lookups", oracle="""
with d as (select cast(s_suppkey as varchar) as k, s_suppkey as id from supplier)
select l_orderkey, l_linenumber, a.id as seller_id, b.id as assistant_id, c.id as supervisor_id
from lineitem left join d a on a.k = cast(l_suppkey as varchar)
left join d b on b.k = cast(l_suppkey + 1 as varchar)
left join d c on c.k = cast(l_suppkey * 1000 as varchar)
""")
def j06_role_lookups(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = lk.keyed_dimension(t.supplier, F.col("s_suppkey").cast("string"), "s_suppkey")
    roles = {"seller": F.col("l_suppkey").cast("string"), "assistant": (F.col("l_suppkey") + 1).cast("string"),
             "supervisor": (F.col("l_suppkey") * 1000).cast("string")}
    out = lk.role_lookups(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), dim, roles, "s_suppkey")
    return out.select("l_orderkey", "l_linenumber", "seller_id", "assistant_id", "supervisor_id")


# Products bound from part: sku, store reference, ean, marketplace id.
_PRODUCTS_SQL = """(select p_partkey as id, cast(p_partkey as varchar) as sku, cast(p_partkey + 1000 as varchar) as store_reference,
  lpad(cast(p_partkey as varchar), 13, '7') as ean,
  case when p_partkey % 2 = 0 then 'E' || cast(p_partkey as varchar) end as ecommerce_id from part)"""


def _products(t):
    p = t.part
    return p.select(F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("sku"),
                    (F.col("p_partkey") + 1000).cast("string").alias("store_reference"),
                    F.lpad(F.col("p_partkey").cast("string"), 13, "7").alias("ean"),
                    F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("E"), F.col("p_partkey").cast("string")))
                    .alias("ecommerce_id"))


def _dim(products, col):
    return lk.keyed_dimension(products, F.col(col), "id")


@query("j07_product_cascade_marketplace", oracle=f"""
with p as {_PRODUCTS_SQL},
d1 as (select ecommerce_id as k, max(id) as id from p where ecommerce_id <> '' group by 1),
d2 as (select ean as k, max(id) as id from p where ean <> '' group by 1),
d3 as (select sku as k, max(id) as id from p where sku <> '' group by 1),
i as (select l_orderkey, l_linenumber, 'E' || cast(l_partkey as varchar) as eid,
        case when l_linenumber in (2, 3) then lpad(cast(l_partkey as varchar), 13, '7') else 'X' end as ean,
        case when l_linenumber = 4 then 'NEW' || cast(l_partkey as varchar) else cast(l_partkey as varchar) end as sku
      from lineitem)
select l_orderkey, l_linenumber, coalesce(d1.id, d2.id, d3.id) as product_id
from i left join d1 on d1.k = i.eid left join d2 on d2.k = i.ean left join d3 on d3.k = i.sku
""")
def j07_product_cascade_marketplace(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = _products(t)
    li = t.lineitem
    eid = F.concat(F.lit("E"), F.col("l_partkey").cast("string"))
    ean = F.when(F.col("l_linenumber").isin(2, 3), F.lpad(F.col("l_partkey").cast("string"), 13, "7")).otherwise(F.lit("X"))
    sku = F.when(F.col("l_linenumber") == 4, F.concat(F.lit("NEW"), F.col("l_partkey").cast("string"))) \
        .otherwise(F.col("l_partkey").cast("string"))
    out = lk.cascade(li.select("l_orderkey", "l_linenumber", "l_partkey"),
                     [(eid, _dim(p, "ecommerce_id")), (ean, _dim(p, "ean")), (sku, _dim(p, "sku"))], "id", "product_id")
    return out.select("l_orderkey", "l_linenumber", "product_id")


_PARTNER_SKU_SQL = """(case l_linenumber when 1 then cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar)
  when 2 then cast(l_partkey as varchar) || '_' || cast(l_suppkey as varchar)
  when 3 then cast(l_partkey + 1000 as varchar) when 4 then cast(l_partkey as varchar)
  when 5 then 'X' || cast(l_partkey as varchar) else null end)"""


def _partner_sku():
    n = F.col("l_linenumber")
    p, s = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    return (F.when(n == 1, F.concat(p, F.lit("-"), s)).when(n == 2, F.concat(p, F.lit("_"), s))
            .when(n == 3, (F.col("l_partkey") + 1000).cast("string")).when(n == 4, p)
            .when(n == 5, F.concat(F.lit("X"), p)))


_PREFIX_SQL = """(case when ps <> '' and regexp_matches(trim(regexp_extract(ps, '^([^\\-_]*)', 1)), '^\\d+$')
   then trim(regexp_extract(ps, '^([^\\-_]*)', 1)) end)"""


@query("j08_product_cascade_quote", oracle=f"""
with p as {_PRODUCTS_SQL},
dr as (select store_reference as k, max(id) as id from p group by 1),
ds as (select sku as k, max(id) as id from p group by 1),
i as (select l_orderkey, l_linenumber, trim({_PARTNER_SKU_SQL}) as ps, cast(l_suppkey as varchar) as id_sku from lineitem),
k as (select *, case when regexp_matches(ps, '^\\d+$') and try_cast(ps as double) > 1000 then ps end as k1,
        coalesce({_PREFIX_SQL}, id_sku) as k2 from i)
select l_orderkey, l_linenumber, coalesce(dr.id, ds.id) as product_id
from k left join dr on dr.k = k.k1 left join ds on ds.k = k.k2
""")
def j08_product_cascade_quote(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = _products(t)
    k1, k2 = lk.quote_item_keys(_partner_sku(), F.col("l_suppkey"))
    out = lk.cascade(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                     [(k1, _dim(p, "store_reference")), (k2, _dim(p, "sku"))], "id", "product_id")
    return out.select("l_orderkey", "l_linenumber", "product_id")


@query("j09_product_cascade_freight_order", oracle=f"""
with p as {_PRODUCTS_SQL},
dr as (select store_reference as k, max(id) as id from p group by 1),
ds as (select sku as k, max(id) as id from p group by 1),
i as (select l_orderkey, l_linenumber, trim({_PARTNER_SKU_SQL}) as ps, cast(l_suppkey as varchar) as id_sku from lineitem),
k as (select *, coalesce({_PREFIX_SQL}, id_sku) as k1, case when regexp_matches(ps, '^\\d+$') then ps end as k2 from i)
select l_orderkey, l_linenumber, coalesce(ds.id, dr.id) as product_id
from k left join ds on ds.k = k.k1 left join dr on dr.k = k.k2
""")
def j09_product_cascade_freight_order(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = _products(t)
    k1, k2 = lk.order_item_keys(_partner_sku(), F.col("l_suppkey"))
    out = lk.cascade(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                     [(k1, _dim(p, "sku")), (k2, _dim(p, "store_reference"))], "id", "product_id")
    return out.select("l_orderkey", "l_linenumber", "product_id")


@query("j10_product_cascade_erp", oracle=f"""
with p as {_PRODUCTS_SQL},
de as (select ean as k, max(id) as id from p group by 1),
ds as (select sku as k, max(id) as id from p group by 1),
i as (select l_orderkey, l_linenumber,
        case when l_linenumber % 2 = 0 then lpad(cast(l_partkey as varchar), 13, '7') else '' end as pk,
        case when l_linenumber = 3 then 'abc' else cast(l_partkey as varchar) || '.0' end as sku_raw from lineitem)
select l_orderkey, l_linenumber, coalesce(de.id, ds.id) as product_id
from i left join de on de.k = nullif(trim(pk), '')
left join ds on ds.k = (case when regexp_matches(sku_raw, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')
                              and cast(trunc(cast(sku_raw as double)) as bigint) <> 0
                             then cast(cast(trunc(cast(sku_raw as double)) as bigint) as varchar) end)
""")
def j10_product_cascade_erp(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = _products(t)
    pk = F.when(F.col("l_linenumber") % 2 == 0, F.lpad(F.col("l_partkey").cast("string"), 13, "7")).otherwise(F.lit(""))
    sku = F.when(F.col("l_linenumber") == 3, F.lit("abc")).otherwise(
        F.concat(F.col("l_partkey").cast("string"), F.lit(".0")))
    k1, k2 = lk.erp_item_keys(pk, sku)
    out = lk.cascade(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
                     [(k1, _dim(p, "ean")), (k2, _dim(p, "sku"))], "id", "product_id")
    return out.select("l_orderkey", "l_linenumber", "product_id")


@query("j11_existing_row_match", oracle="""
with tgt as (select c_custkey as id, case when c_custkey % 2 = 0 then 'C' || cast(c_custkey as varchar) end as ext,
               'T' || cast(c_custkey as varchar) as tax from customer where c_custkey % 3 <> 0),
inc as (select c_custkey, case when c_custkey % 4 = 0 then 'C' || cast(c_custkey as varchar) else 'N' || cast(c_custkey as varchar) end as ext,
               'T' || cast(c_custkey as varchar) as tax from customer where c_custkey % 2 = 0),
d1 as (select ext as k, max(id) as id from tgt where ext <> '' group by 1),
d2 as (select tax as k, arg_max(row(id, ext), id) as r from tgt where tax <> '' group by 1)
select inc.c_custkey, coalesce(d1.id, d2.r[1]) as matched_id,
  case when d1.id is not null then 'external_id' when d2.r[1] is not null then 'legacy' end as matched_by,
  coalesce(d1.id is null and d2.r[1] is not null and d2.r[2] is not null and d2.r[2] <> inc.ext, false) as ext_conflict
from inc left join d1 on d1.k = inc.ext left join d2 on d2.k = inc.tax
""")
def j11_existing_row_match(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    k = F.col("c_custkey")
    tgt = c.where(k % 3 != 0).select(
        k.alias("id"), F.when(k % 2 == 0, F.concat(F.lit("C"), k.cast("string"))).alias("ext"),
        F.concat(F.lit("T"), k.cast("string")).alias("tax"))
    inc = c.where(k % 2 == 0).select(
        "c_custkey", F.when(k % 4 == 0, F.concat(F.lit("C"), k.cast("string")))
        .otherwise(F.concat(F.lit("N"), k.cast("string"))).alias("ext"),
        F.concat(F.lit("T"), k.cast("string")).alias("tax"))
    out = lk.existing_row_match(inc, tgt, "ext", "tax")
    return out.select("c_custkey", "matched_id", "matched_by", F.coalesce("ext_conflict", F.lit(False)).alias("ext_conflict"))


def _categories(t):
    p = t.part
    first_word = F.split(F.col("p_name"), " ").getItem(0)
    l1 = p.groupBy(F.col("p_type").alias("name")).agg((F.min("p_partkey") * 10 + 1).alias("id")).select(
        "id", "name", F.lit(1).alias("level"), F.array(F.concat(F.col("name"), F.lit(" Ação"))).alias("synonyms"))
    l2 = p.groupBy(F.col("p_brand").alias("name")).agg((F.min("p_partkey") * 10 + 2).alias("id")).select(
        "id", "name", F.lit(2).alias("level"), F.array(F.regexp_replace("name", "#", " nº ")).alias("synonyms"))
    l3 = p.groupBy(first_word.alias("name")).agg((F.min("p_partkey") * 10 + 3).alias("id"),
                                                 F.min("p_type").alias("t")).select(
        "id", "name", F.lit(3).alias("level"), F.array(F.col("t")).alias("synonyms"))
    return l1.unionByName(l2).unionByName(l3)


_NORM = "trim(regexp_replace(translate(lower(trim(coalesce({x}, ''))), 'áàâãäåéèêëíìîïóòôõöúùûüçñýÿ', 'aaaaaaeeeeiiiiooooouuuucnyy'), '[^a-z0-9]+', ' ', 'g'))"


@query("j12_category_auto_map", oracle=f"""
with c as (select min(p_partkey) * 10 + 1 as id, p_type as name, 1 as level, [p_type || ' Ação'] as syn from part group by p_type
           union all select min(p_partkey) * 10 + 2, p_brand, 2, [replace(p_brand, '#', ' nº ')] from part group by p_brand
           union all select min(p_partkey) * 10 + 3, split_part(p_name, ' ', 1), 3, [min(p_type)] from part group by split_part(p_name, ' ', 1)),
t as (select id, level, name as term from c union all select id, level, unnest(syn) from c),
d as (select {_NORM.format(x='term')} as k, arg_min(id, row(-level, id)) as id from t where {_NORM.format(x='term')} <> '' group by 1),
p as (select p_partkey, p_name, p_brand, p_type, case when p_partkey % 5 = 0 then -1 end as current from part)
select p_partkey, coalesce(current, case when current is null then coalesce(d1.id, d2.id, d3.id) end) as category_id
from p left join d d1 on d1.k = nullif({_NORM.format(x='p_name')}, '')
left join d d2 on d2.k = nullif({_NORM.format(x='p_brand')}, '')
left join d d3 on d3.k = nullif({_NORM.format(x='p_type')}, '')
""")
def j12_category_auto_map(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = lk.category_dimension(_categories(t))
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type",
                      F.when(F.col("p_partkey") % 5 == 0, F.lit(-1)).cast("bigint").alias("current"))
    out = lk.auto_map_category(p, dim, ["p_name", "p_brand", "p_type"], "current")
    return out.select("p_partkey", "category_id")


@query("j14_supervisor_self_join", oracle="""
select s.s_suppkey, sup.s_suppkey as supervisor_id from supplier s
left join supplier sup on cast(sup.s_suppkey as varchar) = cast(s.s_suppkey // 10 as varchar)
""")
def j14_supervisor_self_join(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    out = lk.supervisor_link(s, "s_suppkey", (F.col("s_suppkey") / 10).cast("bigint"), "s_suppkey")
    return out.select("s_suppkey", "supervisor_id")


@query("j16_tenants_with_platform", oracle="""
with cp as (select n_nationkey as company_id, n_regionkey as platform_id from nation
            union all select n_nationkey, (n_regionkey + 1) % 5 from nation where n_nationkey % 2 = 0)
select n_nationkey as company_id, n_name from nation where n_nationkey in (
  select company_id from cp join region on cp.platform_id = r_regionkey where lower(trim(r_name)) in ('asia', 'europe'))
""")
def j16_tenants_with_platform(spark, sf_dir):
    t = Tables(spark, sf_dir)
    companies = t.nation.select(F.col("n_nationkey").alias("company_id"), "n_name")
    cp = t.nation.select(F.col("n_nationkey").alias("company_id"), F.col("n_regionkey").alias("platform_id")).unionByName(
        t.nation.where(F.col("n_nationkey") % 2 == 0).select(
            F.col("n_nationkey").alias("company_id"), ((F.col("n_regionkey") + 1) % 5).alias("platform_id")))
    platforms = t.region.select(F.col("r_regionkey").alias("platform_id"), F.col("r_name").alias("slug"))
    return lk.tenants_with_platform(companies, cp, platforms, ["asia", "EUROPE"])
