"""Snapshot maintenance queries.

Target and incoming come from the same table split by key: target = keys
with key % 3 <> 0 holding the old values, incoming = keys with key % 2 = 0
carrying new values (some null).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import audit as au
from cargolens.operators import upsert as up
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables

TARGET_SQL = """(select c_custkey, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer where c_custkey % 3 <> 0)"""
INCOMING_SQL = """(select c_custkey, case when c_custkey % 4 = 0 then null else c_name || ' v2' end as name,
  c_acctbal + 1 as balance, case when c_custkey % 5 = 0 then null else lower(c_mktsegment) end as segment
  from customer where c_custkey % 2 = 0)"""


def _target(t):
    c = t.customer
    return c.where(F.col("c_custkey") % 3 != 0).select("c_custkey", F.col("c_name").alias("name"),
                                                        F.col("c_acctbal").alias("balance"),
                                                        F.col("c_mktsegment").alias("segment"))


def _incoming(t):
    c = t.customer
    k = F.col("c_custkey")
    return c.where(k % 2 == 0).select(
        "c_custkey", F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat("c_name", F.lit(" v2"))).alias("name"),
        (F.col("c_acctbal") + 1).alias("balance"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.lower("c_mktsegment")).alias("segment"))


@query("s04_source_profile", oracle="""
select o_orderpriority, count(*) as rows,
  count(distinct nullif(trim(case when o_orderkey % 17 = 0 then '' else cast(o_orderkey as varchar) end), '')) as distinct_keys,
  min(o_orderdate) as min_date, max(o_orderdate) as max_date,
  count(*) filter (where o_orderkey % 17 = 0) as rows_without_key
from orders group by o_orderpriority
""")
def s04_source_profile(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    key = F.when(F.col("o_orderkey") % 17 == 0, F.lit("")).otherwise(F.col("o_orderkey").cast("string"))
    parts = o.select("o_orderpriority", key.alias("k"), "o_orderdate")
    return au.source_profile(parts, "k", "o_orderdate", by=["o_orderpriority"])


@query("s05_upsert_keep_old", oracle=f"""
select coalesce(t.c_custkey, i.c_custkey) as c_custkey, coalesce(i.name, t.name) as name,
  coalesce(i.balance, t.balance) as balance, coalesce(i.segment, t.segment) as segment,
  case when t.c_custkey is null then 'insert' when i.c_custkey is not null then 'update' else 'keep' end as _action
from {TARGET_SQL} t full outer join {INCOMING_SQL} i on t.c_custkey = i.c_custkey
""")
def s05_upsert_keep_old(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return up.upsert(_target(t), _incoming(t), ["c_custkey"])


@query("s06_upsert_overwrite", oracle=f"""
select coalesce(t.c_custkey, i.c_custkey) as c_custkey,
  case when i.c_custkey is not null then i.name else t.name end as name,
  coalesce(i.balance, t.balance) as balance,
  case when i.c_custkey is not null then i.segment else t.segment end as segment,
  case when t.c_custkey is null then 'insert' when i.c_custkey is not null then 'update' else 'keep' end as _action
from {TARGET_SQL} t full outer join {INCOMING_SQL} i on t.c_custkey = i.c_custkey
""")
def s06_upsert_overwrite(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return up.upsert(_target(t), _incoming(t), ["c_custkey"], policy={"name": "overwrite", "segment": "overwrite"})


@query("s07_insert_if_absent", oracle=f"""
select * from {TARGET_SQL} t
union all select * from {INCOMING_SQL} i where i.c_custkey not in (select c_custkey from {TARGET_SQL} x)
""")
def s07_insert_if_absent(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return up.insert_if_absent(_target(t), _incoming(t), ["c_custkey"])


@query("s08_only_insert", oracle=f"""
select i.c_custkey, i.name, i.c_custkey in (select c_custkey from {TARGET_SQL} x) as skipped from {INCOMING_SQL} i
""")
def s08_only_insert(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ins, skip = up.only_insert(_target(t), _incoming(t), ["c_custkey"])
    return ins.select("c_custkey", "name", F.lit(False).alias("skipped")).unionByName(
        skip.select("c_custkey", "name", F.lit(True).alias("skipped")))


_S9_TABLE = """(select o_orderkey, o_orderpriority as company, cast(year(o_orderdate) as integer) as yr, o_totalprice as value
  from orders where o_orderkey % 3 <> 0)"""
_S9_FRESH = """(select o_orderkey, o_orderpriority as company, cast(year(o_orderdate) as integer) as yr, o_totalprice * 2 as value
  from orders where o_orderkey % 2 = 0 and year(o_orderdate) in (1995, 1996))"""


@query("s09_replace_slice", oracle=f"""
with touched as (select company, yr from {_S9_FRESH} f
                 union select distinct o_orderpriority, year(o_orderdate) from orders where year(o_orderdate) = 1997 and o_orderpriority = '5-LOW')
select * from {_S9_TABLE} t where (company, yr) not in (select company, yr from touched)
union all select * from {_S9_FRESH} f
""")
def s09_replace_slice(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    table = o.where(F.col("o_orderkey") % 3 != 0).select("o_orderkey", F.col("o_orderpriority").alias("company"),
                                                          F.year("o_orderdate").alias("yr"), F.col("o_totalprice").alias("value"))
    fresh = o.where((F.col("o_orderkey") % 2 == 0) & F.year("o_orderdate").isin(1995, 1996)).select(
        "o_orderkey", F.col("o_orderpriority").alias("company"), F.year("o_orderdate").alias("yr"),
        (F.col("o_totalprice") * 2).alias("value"))
    processed = o.where((F.year("o_orderdate") == 1997) & (F.col("o_orderpriority") == "5-LOW")).select(
        F.col("o_orderpriority").alias("company"), F.year("o_orderdate").alias("yr"))
    return up.replace_slices(table, fresh, ["company", "yr"], processed)


@query("s10_replace_children", oracle="""
select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey % 3 <> 0
  and l_orderkey not in (select l_orderkey from lineitem where l_orderkey % 2 = 0 and l_linenumber <= 2)
union all select l_orderkey, l_linenumber, l_quantity + 1 from lineitem where l_orderkey % 2 = 0 and l_linenumber <= 2
""")
def s10_replace_children(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    items = li.where(F.col("l_orderkey") % 3 != 0).select("l_orderkey", "l_linenumber", "l_quantity")
    new = li.where((F.col("l_orderkey") % 2 == 0) & (F.col("l_linenumber") <= 2)).select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") + 1).alias("l_quantity"))
    return up.replace_children(items, new, "l_orderkey")


_S11_ITEMS = """(select l_orderkey, l_linenumber, case when l_linenumber = 5 then null else cast(l_linenumber as varchar) end as ext from lineitem)"""
_S11_INC = """(select l_orderkey, case when l_orderkey % 4 = 0 then null else cast(l_linenumber as varchar) end as ext
  from lineitem where l_orderkey % 2 = 0 and l_linenumber % 2 = 1)"""


@query("s11_delete_vanished_children", oracle=f"""
with inc as (select distinct l_orderkey, ext from {_S11_INC} x where ext is not null and trim(ext) <> ''),
has as (select distinct l_orderkey from inc),
touched as (select o_orderkey as l_orderkey from orders where o_orderkey % 2 = 0),
none_in as (select l_orderkey from touched where l_orderkey not in (select l_orderkey from has))
select i.l_orderkey, i.l_linenumber, i.ext from {_S11_ITEMS} i
where (i.l_orderkey not in (select l_orderkey from has) or i.ext is null or trim(i.ext) = ''
       or (i.l_orderkey, i.ext) in (select l_orderkey, ext from inc))
  and i.l_orderkey not in (select l_orderkey from none_in)
""")
def s11_delete_vanished_children(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem
    items = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 5, F.lit(None))
                      .otherwise(F.col("l_linenumber").cast("string")).alias("ext"))
    inc = li.where((F.col("l_orderkey") % 2 == 0) & (F.col("l_linenumber") % 2 == 1)).select(
        "l_orderkey", F.when(F.col("l_orderkey") % 4 == 0, F.lit(None)).otherwise(
            F.col("l_linenumber").cast("string")).alias("ext"))
    touched = t.orders.where(F.col("o_orderkey") % 2 == 0).select(F.col("o_orderkey").alias("l_orderkey"))
    return up.delete_vanished_children(items, inc, "l_orderkey", "ext", touched)


@query("s12_force_range_replace", oracle="""
with inc as (select o_orderkey, 'C' || cast(o_orderkey as varchar) as code, o_orderdate, o_totalprice + 1 as o_totalprice
             from orders where o_orderkey % 2 = 0 and year(o_orderdate) = 1998),
st as (select o_orderkey, 'C' || cast(o_orderkey as varchar) as code, o_orderdate, o_totalprice from orders),
gone as (select o_orderkey from st where o_orderdate >= timestamp '1996-01-01' and o_orderdate <= timestamp '1996-12-31 23:59:59.999'
         union select o_orderkey from st where code in (select code from inc))
select o_orderkey, code, o_totalprice from st where o_orderkey not in (select o_orderkey from gone)
union all select o_orderkey, code, o_totalprice from inc
""")
def s12_force_range_replace(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("code"),
                        "o_orderdate", "o_totalprice")
    inc = o.where((F.col("o_orderkey") % 2 == 0) & (F.year("o_orderdate") == 1998)) \
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    items = t.lineitem.select("l_orderkey", "l_linenumber")
    inc_items = items.join(inc.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi") \
        .where(F.col("l_linenumber") <= 1)
    o2, _ = up.force_range_replace(o, items, inc, inc_items, "o_orderdate", "code", "o_orderkey", "l_orderkey",
                                   "1996-01-01", "1996-12-31")
    return o2.select("o_orderkey", "code", "o_totalprice")


@query("s13_partial_status_update", oracle="""
with upd as (select case when o_orderkey % 8 = 0 then 'x' || cast(o_orderkey as varchar)
                         when o_orderkey % 8 = 2 then '-' || cast(o_orderkey as varchar) else cast(o_orderkey as varchar) end as code,
                    'novo' as status from orders where o_orderkey % 2 = 0),
ok as (select distinct code, status from upd where try_cast(trim(code) as double) > 0)
select cast(o_orderkey as varchar) as code, coalesce(ok.status, o_orderstatus) as status
from orders left join ok on ok.code = cast(o_orderkey as varchar)
""")
def s13_partial_status_update(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    target = o.select(F.col("o_orderkey").cast("string").alias("code"), F.col("o_orderstatus").alias("status"))
    k = F.col("o_orderkey")
    upd = o.where(k % 2 == 0).select(
        F.when(k % 8 == 0, F.concat(F.lit("x"), k.cast("string"))).when(k % 8 == 2, F.concat(F.lit("-"), k.cast("string")))
        .otherwise(k.cast("string")).alias("code"), F.lit("novo").alias("status"))
    return up.update_columns_from_values(target, upd, ["code"], ["status"], code_col="code")


@query("s14_advance_cursor", oracle="""
with ctl as (select o_orderpriority as company, min(o_orderdate) + interval 400 day as last_processed_at, count(*) as n
             from orders where o_orderpriority <> '5-LOW' group by 1),
hw as (select o_orderpriority as company, max(o_orderdate) as hw from orders where o_orderdate < timestamp '1999-01-01' group by 1)
select coalesce(ctl.company, hw.company) as company, ctl.n, greatest(ctl.last_processed_at, hw.hw) as last_processed_at
from ctl full outer join hw on ctl.company = hw.company
""")
def s14_advance_cursor(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    ctl = o.where(F.col("o_orderpriority") != "5-LOW").groupBy(F.col("o_orderpriority").alias("company")).agg(
        (F.min("o_orderdate") + F.expr("INTERVAL 400 DAYS")).alias("last_processed_at"), F.count(F.lit(1)).alias("n"))
    processed = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderpriority").alias("company"), "o_orderdate")
    return up.advance_cursor(ctl, processed, ["company"], "o_orderdate")


@query("a09_run_counters", oracle=f"""
with u as (select t.c_custkey as t_key, i.c_custkey as i_key, coalesce(i.name, t.name) as name
           from {TARGET_SQL} t full outer join {INCOMING_SQL} i on t.c_custkey = i.c_custkey)
select count(*) filter (where t_key is null) as inserted, count(*) filter (where t_key is not null and i_key is not null) as updated,
  count(*) filter (where i_key is null) as kept, count(*) filter (where name is null) as missing_name
from u
""")
def a09_run_counters(spark, sf_dir):
    t = Tables(spark, sf_dir)
    u = up.upsert(_target(t), _incoming(t), ["c_custkey"])
    return au.run_counters(u, {"inserted": F.col("_action") == "insert", "updated": F.col("_action") == "update",
                               "kept": F.col("_action") == "keep", "missing_name": F.col("name").isNull()})
