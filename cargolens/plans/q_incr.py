"""Incremental, backfill, order-assembly and set-operation queries
(I1–I12, I15–I17, A3–A6, A8, A10–A12, U3–U6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import audit as au
from cargolens.operators import incremental as inc
from cargolens.operators import orders as od
from cargolens.plans import bindings as b
from cargolens.plans.q_freight import LINE_ORDER_SQL
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables

CURSOR = "1999-01-01"


@query("i01_watermark_filter", oracle=f"""
with r as (select o_orderkey, o_orderpriority as company,
             case when o_orderkey % 11 = 0 then null else o_orderdate end as synced_at from orders),
c as (select distinct o_orderpriority as company, timestamp '{CURSOR}' as last_processed_at from orders where o_orderpriority <> '3-MEDIUM')
select r.o_orderkey, r.company, r.synced_at from r left join c using (company)
where c.last_processed_at is null or r.synced_at > c.last_processed_at
""")
def i01_watermark_filter(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    rows = o.select("o_orderkey", F.col("o_orderpriority").alias("company"),
                    F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("synced_at"))
    ctl = o.where(F.col("o_orderpriority") != "3-MEDIUM").select(F.col("o_orderpriority").alias("company")).distinct() \
        .withColumn("last_processed_at", F.lit(CURSOR).cast("timestamp_ntz"))
    return inc.watermark_filter(rows, ctl, ["company"], "synced_at")


@query("i02_order_version_check", oracle="""
with g as (select l_orderkey, max(l_shipdate) as version from lineitem group by 1),
s as (select o_orderkey as l_orderkey, case when o_orderkey % 5 = 0 then null else o_orderdate + interval 120 day end as stored
      from orders where o_orderkey % 3 <> 0)
select g.l_orderkey, g.version from g left join s using (l_orderkey)
where not (g.version is not null and s.stored is not null and g.version <= s.stored)
""")
def i02_order_version_check(spark, sf_dir):
    t = Tables(spark, sf_dir)
    g = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("version"))
    stored = t.orders.where(F.col("o_orderkey") % 3 != 0).select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(
            F.col("o_orderdate") + F.expr("INTERVAL 120 DAYS")).alias("version"))
    return od.version_filter(g, stored, ["l_orderkey"], "version")


@query("i03_item_version_check", oracle="""
with i as (select l_orderkey, l_linenumber, l_partkey, l_shipdate as version from lineitem),
s as (select l_orderkey, l_linenumber, l_partkey, l_shipdate + to_days(cast(l_linenumber - 4 as integer)) as stored
      from lineitem where l_orderkey % 3 <> 0)
select i.l_orderkey, i.l_linenumber, i.l_partkey, i.version from i left join s using (l_orderkey, l_linenumber, l_partkey)
where not (i.version is not null and s.stored is not null and i.version <= s.stored)
""")
def i03_item_version_check(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    incoming = li.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("version"))
    stored = li.where(F.col("l_orderkey") % 3 != 0).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber") - 4)).alias("version"))
    return od.version_filter(incoming, stored, ["l_orderkey", "l_linenumber", "l_partkey"], "version")


@query("i04_change_detection", oracle="""
with i as (select c_custkey, case when c_custkey % 4 = 0 then c_name || '*' else c_name end as name,
             case when c_custkey % 10 = 0 then null else c_mktsegment end as segment from customer where c_custkey % 2 = 0),
s as (select c_custkey, c_name as name, c_mktsegment as segment from customer where c_custkey % 3 <> 0)
select i.* from i left join s using (c_custkey)
where s.c_custkey is null or i.name is distinct from s.name or i.segment is distinct from s.segment
""")
def i04_change_detection(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    k = F.col("c_custkey")
    i = c.where(k % 2 == 0).select("c_custkey", F.when(k % 4 == 0, F.concat("c_name", F.lit("*")))
                                   .otherwise(F.col("c_name")).alias("name"),
                                   F.when(k % 10 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"))
    s = c.where(k % 3 != 0).select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return inc.changed_rows(i, s, ["c_custkey"], ["name", "segment"])


@query("i05_i06_lock_and_fill", oracle="""
select p_partkey,
  case when p_partkey % 4 = 0 then p_brand else upper(p_brand) end as brand,
  coalesce(case when p_partkey % 2 = 0 then null else 'new-' || p_name end,
           case when p_partkey % 3 = 0 then null else 'old-' || p_name end) as photo,
  coalesce(case when p_partkey % 5 = 0 then null else p_retailprice end, p_retailprice * 2) as price
from part
""")
def i05_i06_lock_and_fill(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    k = F.col("p_partkey")
    new_photo = F.when(k % 2 == 0, F.lit(None)).otherwise(F.concat(F.lit("new-"), "p_name"))
    old_photo = F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("old-"), "p_name"))
    old_price = F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("p_retailprice"))
    return p.select("p_partkey",
                    inc.lock_guard(F.upper("p_brand"), F.col("p_brand"), k % 4 == 0).alias("brand"),
                    inc.keep_or_fill(new_photo, old_photo).alias("photo"),
                    inc.keep_or_fill(F.col("p_retailprice") * 2, old_price, fill_only=True).alias("price"))


@query("i07_known_order_fast_path", oracle="""
with known as (select o_orderkey from orders where o_orderkey % 3 <> 0),
incm as (select o_orderkey, 'novo' as status, 'N' || cast(o_orderkey as varchar) as code from orders where o_orderkey % 2 = 0)
select o.o_orderkey, coalesce(i.status, o.o_orderstatus) as status, coalesce(i.code, cast(o.o_orderkey as varchar)) as code,
       o.o_totalprice from orders o left join incm i on i.o_orderkey = o.o_orderkey where o.o_orderkey % 3 <> 0
union all
select i.o_orderkey, i.status, i.code, null as o_totalprice from incm i where i.o_orderkey not in (select o_orderkey from known)
""")
def i07_known_order_fast_path(spark, sf_dir):
    from cargolens.operators.upsert import update_columns_from_values
    o = Tables(spark, sf_dir).orders
    stored = o.where(F.col("o_orderkey") % 3 != 0).select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("code"),
        "o_totalprice")
    incoming = o.where(F.col("o_orderkey") % 2 == 0).select(
        "o_orderkey", F.lit("novo").alias("status"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("code"))
    known = incoming.join(stored.select("o_orderkey"), "o_orderkey", "left_semi")
    new = incoming.join(stored.select("o_orderkey"), "o_orderkey", "left_anti")
    updated = update_columns_from_values(stored, known, ["o_orderkey"], ["status", "code"])
    return updated.unionByName(new.withColumn("o_totalprice", F.lit(None).cast("double")))


@query("i08_order_date_cascade", oracle="""
select o_orderkey, coalesce(case when o_orderkey % 5 = 0 then null else o_orderdate end,
  case when o_orderkey % 3 = 0 then null else o_orderdate + interval 1 hour end,
  case when o_orderkey % 2 = 0 then null else o_orderdate + interval 2 hour end, o_orderdate + interval 3 hour) as order_date
from orders
""")
def i08_order_date_cascade(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    c1 = F.when(k % 5 == 0, F.lit(None)).otherwise(d)
    c2 = F.when(k % 3 == 0, F.lit(None)).otherwise(d + F.expr("INTERVAL 1 HOUR"))
    c3 = F.when(k % 2 == 0, F.lit(None)).otherwise(d + F.expr("INTERVAL 2 HOURS"))
    return o.select("o_orderkey", inc.order_date_cascade(c1, c2, c3, d + F.expr("INTERVAL 3 HOURS")).alias("order_date"))


@query("i09_order_date_backfill_rule", oracle="""
with x as (select o_orderkey,
  case when o_orderkey % 7 = 0 then null when o_orderkey % 2 = 0 then o_orderdate + interval 3 hour else o_orderdate end as stored,
  o_orderdate + to_days(cast(o_orderkey % 3 as integer)) + to_hours(cast(o_orderkey % 5 as integer)) as new from orders)
select o_orderkey, new is not null and (stored is null or cast(stored as date) <> cast(new as date)
  or (strftime(stored, '%H:%M:%S') = '00:00:00' and strftime(new, '%H:%M:%S') <> '00:00:00')) as write from x
""")
def i09_order_date_backfill_rule(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    stored = F.when(k % 7 == 0, F.lit(None)).when(k % 2 == 0, d + F.expr("INTERVAL 3 HOURS")).otherwise(d)
    new = d + F.make_dt_interval(days=(k % 3).cast("int"), hours=(k % 5).cast("int"))
    return o.select("o_orderkey", inc.should_write_order_date(stored, new).alias("write"))


@query("i10_backfill_local_datetime", oracle="""
select event_id,
  case when event_id % 3 = 0 or event_id % 5 = 0 then strftime(timezone('America/Sao_Paulo', timezone('UTC', ts)), '%Y-%m-%d') else 'kept' end as date,
  case when event_id % 3 = 0 or event_id % 5 = 0 then strftime(timezone('America/Sao_Paulo', timezone('UTC', ts)), '%H:%M:%S') else 'kept' end as time
from events
""")
def i10_backfill_local_datetime(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    k = F.col("event_id")
    d = e.select("event_id", "ts", F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit("kept")).alias("date"),
                 F.when(k % 5 == 0, F.lit(None)).otherwise(F.lit("kept")).alias("time"))
    return inc.backfill_local_datetime(d, "ts", "date", "time").select("event_id", "date", "time")


@query("i11_backfill_best_option", oracle=f"""
with o as (select l_orderkey as freight_quote_id,
  cast(row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as integer) as line_index,
  l_quantity % 10 as cd, case when l_linenumber = 1 then 0.0 else floor(l_extendedprice*2)/100 end as p from lineitem),
v as (select * from o where cd > 0 and p >= 0),
m as (select freight_quote_id, min(cd) as min_cd, min(p) as min_p from v group by 1),
s as (select v.*, (cd = min_cd and p = min_p) as dom,
        cd / min_cd + p / (case when min_p = 0 then 1.0 else min_p end) as score from v join m using (freight_quote_id)),
r as (select * from (select *, row_number() over (partition by freight_quote_id
        order by case when dom then 0 else 1 end, case when dom then 0.0 else score end, line_index) as rn from s) x where rn = 1),
q as (select o_orderkey as id, case when o_orderkey % 3 = 0 then null else -1.0 end as best_deadline,
        case when o_orderkey % 4 = 0 then null else -2.0 end as best_freight_cost from orders)
select q.id,
  case when q.best_deadline is null or q.best_freight_cost is null then r.cd else q.best_deadline end as best_deadline,
  case when q.best_deadline is null or q.best_freight_cost is null then r.p else q.best_freight_cost end as best_freight_cost
from q left join r on r.freight_quote_id = q.id
""")
def i11_backfill_best_option(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k = F.col("o_orderkey")
    q = t.orders.select(F.col("o_orderkey").alias("id"),
                        F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit(-1.0)).alias("best_deadline"),
                        F.when(k % 4 == 0, F.lit(None)).otherwise(F.lit(-2.0)).alias("best_freight_cost"))
    return inc.backfill_best_option(q, b.w2_options(t)).select("id", "best_deadline", "best_freight_cost")


OPTION_SCHEMA = "struct<price:double,deadline:int,carrier:string>"


@query("i12_backfill_options_json", oracle="""
with q as (select o_orderkey, case when o_orderkey % 9 = 0 then '{"not": "an array"}'
             else '[{"price": ' || cast(o_totalprice / 100 as varchar) || ', "deadline": ' || cast(o_orderkey % 20 as varchar)
               || ', "carrier": "C' || cast(o_custkey % 7 as varchar) || '"}, {"price": 1.5, "deadline": 3, "carrier": "'
               || o_orderpriority || '"}]' end as raw from orders),
parsed as (select o_orderkey as freight_quote_id, cast(pos - 1 as integer) as line_index, e->>'$.carrier' as carrier
           from (select o_orderkey, unnest(cast(json_extract(raw, '$[*]') as json[])) as e,
                        generate_subscripts(cast(json_extract(raw, '$[*]') as json[]), 1) as pos
                 from q where starts_with(trim(raw), '[')) x),
stored as (select o_orderkey as freight_quote_id, cast(0 as integer) as line_index, 'stored' as carrier from orders where o_orderkey % 3 = 0)
select * from stored
union all select * from parsed where (freight_quote_id, line_index) not in (select freight_quote_id, line_index from stored)
""")
def i12_backfill_options_json(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    k = F.col("o_orderkey")
    raw = F.when(k % 9 == 0, F.lit('{"not": "an array"}')).otherwise(F.to_json(F.array(
        F.struct((F.col("o_totalprice") / 100).alias("price"), (k % 20).cast("int").alias("deadline"),
                 F.concat(F.lit("C"), (F.col("o_custkey") % 7).cast("string")).alias("carrier")),
        F.struct(F.lit(1.5).alias("price"), F.lit(3).alias("deadline"), F.col("o_orderpriority").alias("carrier")))))
    quotes = o.select("o_orderkey", raw.alias("raw"))
    stored = o.where(k % 3 == 0).select(F.col("o_orderkey").alias("freight_quote_id"),
                                       F.lit(0).alias("line_index"), F.lit("stored").alias("carrier"))
    return inc.backfill_options(stored, quotes, "raw", "o_orderkey", OPTION_SCHEMA)


@query("i15_missing_quotes", oracle="""
select distinct o_orderkey as quote_id from orders where o_orderstatus = 'F'
  and o_orderkey not in (select o_orderkey from orders where o_orderkey % 3 <> 0)
""")
def i15_missing_quotes(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    children = o.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("quote_ref"))
    parents = o.where(F.col("o_orderkey") % 3 != 0).select(F.col("o_orderkey").alias("quote_id"))
    return inc.missing_parents(children, parents, "quote_ref", "quote_id")


@query("i16_freight_order_skip_rule", oracle="""
select o_orderkey, case when o_orderkey % 3 <> 0 then 'skip' else 'insert' end as action
from orders where o_orderkey % 2 = 0
""")
def i16_freight_order_skip_rule(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    incoming = o.where(F.col("o_orderkey") % 2 == 0).select("o_orderkey")
    stored = o.where(F.col("o_orderkey") % 3 != 0).select("o_orderkey")
    return inc.freight_order_plan(incoming, stored, "o_orderkey", force=False)


@query("i17_commission_placement", oracle="""
select l_orderkey, l_linenumber,
  coalesce(case when l_linenumber % 2 = 0 then cast(cast(l_discount * 100 as bigint) as varchar) end,
           case when o_orderkey % 3 = 0 then cast(o_orderkey % 97 as varchar) end, '0') as item_commission,
  cast(cast(floor(o_totalprice / 1000 * 1000000 + 0.5) / 1000000 as decimal(38,6)) as varchar) as order_commission
from lineitem join orders on l_orderkey = o_orderkey
""")
def i17_commission_placement(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # the order-level value is computed once per order, then joined to its lines
    o = t.orders.select("o_orderkey", od.order_level_commission(
        F.format_string("%.10f", F.col("o_totalprice") / 1000)).alias("order_commission"),
        F.when(F.col("o_orderkey") % 3 == 0, (F.col("o_orderkey") % 97).cast("string")).alias("order_mapped"))
    j = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    item = F.when(F.col("l_linenumber") % 2 == 0, (F.col("l_discount") * 100).cast("bigint").cast("string"))
    return j.select("l_orderkey", "l_linenumber", od.commission(item, F.col("order_mapped")).alias("item_commission"),
                    "order_commission")


@query("a03_group_rows_into_orders", oracle=f"""
with r as (select case when l_orderkey % 50 = 0 then '' else cast(l_orderkey as varchar) end as ext, * from lineitem),
g as (select ext as external_id, arg_min(row(l_partkey, l_quantity), row({LINE_ORDER_SQL})) as h,
             max(l_shipdate) as version, count(*) as n_rows from r where trim(ext) <> '' group by 1)
select external_id, h[1] as l_partkey, h[2] as l_quantity, version, n_rows from g
""")
def a03_group_rows_into_orders(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    r = li.withColumn("ext", F.when(F.col("l_orderkey") % 50 == 0, F.lit("")).otherwise(F.col("l_orderkey").cast("string"))) \
        .withColumn("item_order", F.struct(*b.LINE_ORDER))
    orders, _blank = od.group_rows_into_orders(r, "ext", "item_order", "l_shipdate", ["l_partkey", "l_quantity"])
    return orders


@query("a04_order_total_from_lines", oracle="""
with l as (select l_orderkey, cast(l_quantity as bigint) as q,
  try_cast(cast(cast(floor(l_extendedprice) as bigint) as varchar) || '.'
           || lpad(cast(cast(floor(l_extendedprice * 100) as bigint) % 100 as varchar), 2, '0') as double) as p from lineitem)
select l_orderkey, round(sum(q * (floor(p * 100 + 0.5) / 100)), 6) as total_from_lines from l group by 1
""")
def a04_order_total_from_lines(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    price = F.concat(F.floor("l_extendedprice").cast("bigint").cast("string"), F.lit(","),
                     F.lpad((F.floor(F.col("l_extendedprice") * 100).cast("bigint") % 100).cast("string"), 2, "0"))
    lines = li.select("l_orderkey", F.col("l_quantity").cast("bigint").cast("string").alias("qty"), price.alias("price"))
    out = od.order_total_from_lines(lines, "l_orderkey", "qty", "price")
    return out.select("l_orderkey", F.round("total_from_lines", 6).alias("total_from_lines"))


@query("a05_shipment_summary", oracle="""
select l_orderkey, max(l_shipdate) as promised_date, max(l_shipdate + to_days(l_linenumber)) as delivery_date,
  max(l_linenumber - 3) as max_delta, round(sum(case when l_linenumber = 2 then null else l_extendedprice end), 6) as products_value
from lineitem group by 1
""")
def a05_shipment_summary(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    s = li.select("l_orderkey", F.col("l_shipdate").alias("p"),
                  (F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber"))).alias("d"),
                  (F.col("l_linenumber") - 3).alias("delta"),
                  F.when(F.col("l_linenumber") == 2, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("v"))
    out = od.shipment_summary(s, "l_orderkey", "p", "d", "delta", "v")
    return out.withColumn("products_value", F.round("products_value", 6))


@query("a06_timeline_summary", oracle=f"""
with e as (select l_orderkey, row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as seq,
  case when l_linenumber = 3 then null else strftime(l_shipdate, '%Y-%m-%d') end as d,
  lpad(cast(l_linenumber + 8 as varchar), 2, '0') || ':00' as h,
  case when l_returnflag = 'R' then ' Entregue ' else 'em transito' end as descr from lineitem)
select l_orderkey, arg_min(d, seq) as first_date, arg_min(h, seq) as first_hour, min(d) as min_date,
  arg_max(d, seq) filter (where lower(trim(descr)) = 'entregue') as delivered_date
from e where d is not null and trim(d) <> '' group by 1
""")
def a06_timeline_summary(spark, sf_dir):
    li = b.with_line_index(Tables(spark, sf_dir).lineitem)
    e = li.select("l_orderkey", F.col("line_index").alias("seq"),
                  F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("d"),
                  F.concat(F.lpad((F.col("l_linenumber") + 8).cast("string"), 2, "0"), F.lit(":00")).alias("h"),
                  F.when(F.col("l_returnflag") == "R", F.lit(" Entregue ")).otherwise(F.lit("em transito")).alias("descr"))
    return od.timeline_summary(e, "l_orderkey", "d", "h", "descr", "seq")


@query("a08_high_water_mark", oracle="""
select o_orderpriority, max(o_orderdate) as high_water_mark from orders group by 1
""")
def a08_high_water_mark(spark, sf_dir):
    return au.high_water_mark(Tables(spark, sf_dir).orders, "o_orderdate", ["o_orderpriority"])


@query("a10_missing_field_report", oracle="""
with c as (select case when c_custkey % 7 = 0 then null else c_name end as name,
             case when c_custkey % 11 = 0 then '  ' else c_mktsegment end as segment, c_acctbal as balance from customer),
u as (select 'name' as field, count(*) filter (where name is null or trim(name) = '') as missing from c
      union all select 'segment', count(*) filter (where segment is null or trim(segment) = '') from c
      union all select 'balance', count(*) filter (where balance is null) from c)
select * from u where missing > 0
""")
def a10_missing_field_report(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    k = F.col("c_custkey")
    d = c.select(F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
                 F.when(k % 11 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("segment"),
                 F.col("c_acctbal").alias("balance"))
    return au.missing_field_report(d, ["name", "segment", "balance"])


@query("a11_next_numeric_code", oracle="""
select c_nationkey, coalesce(max(case when c_custkey % 7 = 0 then null else c_custkey end), 0) + 1 as next_code
from customer group by 1
""")
def a11_next_numeric_code(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    code = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("X"), F.col("c_custkey").cast("string"))) \
        .otherwise(F.col("c_custkey").cast("string"))
    return au.next_numeric_code(c.select("c_nationkey", code.alias("code")), "code", ["c_nationkey"])


@query("a12_pending_days", oracle="""
select distinct strftime(timezone('America/Sao_Paulo', timezone('UTC', ts)), '%Y-%m-%d') as day from events where event_id % 3 = 0
""")
def a12_pending_days(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return au.pending_days(e, "ts", F.col("event_id") % 3 == 0)


@query("u03_key_set_union", oracle="""
select distinct k from (select cast(o_custkey as varchar) as k from orders
  union all select cast(c_custkey as varchar) from customer where c_acctbal > 5000
  union all select 'S' || cast(s_suppkey as varchar) from supplier) x
""")
def u03_key_set_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return au.key_set_union(t.orders.select(F.col("o_custkey").cast("string").alias("k")),
                            t.customer.where(F.col("c_acctbal") > 5000).select(F.col("c_custkey").cast("string").alias("k")),
                            t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("k")))


@query("u04_date_spine", oracle="""
with bounds as (select o_orderpriority, min(o_orderdate) as s, max(o_orderdate) as e from orders group by 1)
select o_orderpriority, cast(unnest(generate_series(cast(s as date), cast(e as date), interval 1 day)) as date) as day from bounds
""")
def u04_date_spine(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    bounds = o.groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    return au.date_spine(bounds, "s", "e").select("o_orderpriority", "day")


@query("u05_date_chunks", oracle="""
with bounds as (select o_orderpriority, max(o_orderdate) as s, min(o_orderdate) as e from orders group by 1),
x as (select o_orderpriority, least(cast(s as date), cast(e as date)) as lo, greatest(cast(s as date), cast(e as date)) as hi from bounds)
select o_orderpriority, cast(cs as date) as chunk_start, least(cast(cs as date) + 6, hi) as chunk_end
from (select o_orderpriority, hi, unnest(generate_series(lo, hi, interval 7 day)) as cs from x) y
""")
def u05_date_chunks(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    bounds = o.groupBy("o_orderpriority").agg(F.max("o_orderdate").alias("s"), F.min("o_orderdate").alias("e"))
    return au.date_chunks(bounds, "s", "e", 7).select("o_orderpriority", "chunk_start", "chunk_end")


@query("u06_relative_windows", oracle="""
select event_id,
  cast(timezone('America/Sao_Paulo', timezone('UTC', ts)) as date) - 1 as yesterday_sao_paulo,
  cast(ts as date) - 1 as utc_yesterday, cast(ts as date) as utc_today, cast(ts as date) - 2 as recent_start,
  cast(ts as date) - 1 as ahead_start, cast(ts as date) + 30 as ahead_end
from events
""")
def u06_relative_windows(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    w = au.relative_windows(F.col("ts"))
    return e.select("event_id", *[c.alias(n) for n, c in w.items()])
