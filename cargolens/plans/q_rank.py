"""Ranking / de-dup / running queries (W3–W11, U1, U2) and booking lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import dedupe as dd
from cargolens.operators import running as rn
from cargolens.operators import bookings as bk
from cargolens.plans import bindings as b
from cargolens.plans.q_freight import LINE_ORDER_SQL
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables

LI_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
LINE_ORDER_DESC_SQL = ", ".join(f"{c} desc" for c in LINE_ORDER_SQL.split(","))


@query("w03_first_wins", oracle=f"""
select {LI_COLS} from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_SQL}) rn
                       from lineitem) x where rn = 1
""")
def w03_first_wins(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return dd.first_wins(li, ["l_orderkey", "l_linenumber"], b.LINE_ORDER)


@query("w04_last_wins", oracle=f"""
select {LI_COLS} from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER_DESC_SQL}) rn
                       from lineitem) x where rn = 1
""")
def w04_last_wins(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return dd.last_wins(li, ["l_orderkey", "l_linenumber"], b.LINE_ORDER)


@query("w04_last_non_null_fields", oracle="""
with u as (select c_custkey % 500 as customer_id, c_custkey as version,
  case when c_custkey % 3 = 0 then null else c_name end as name,
  case when c_custkey % 5 = 0 then null else c_acctbal end as balance,
  case when c_custkey % 2 = 0 then null else c_mktsegment end as segment from customer)
select customer_id,
  arg_max(version, version) as version,
  arg_max(name, version) filter (where name is not null) as name,
  arg_max(balance, version) filter (where balance is not null) as balance,
  arg_max(segment, version) filter (where segment is not null) as segment
from u group by customer_id
""")
def w04_last_non_null_fields(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    u = c.select((F.col("c_custkey") % 500).alias("customer_id"), F.col("c_custkey").alias("version"),
                 F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
                 F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("balance"),
                 F.when(F.col("c_custkey") % 2 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"))
    return dd.last_non_null_per_column(u, ["customer_id"], ["version"])


_W5_SRC = """select p_name as sku, p_partkey as external_id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  from lineitem join part on l_partkey = p_partkey"""
_W5_ORDER = "l_orderkey, " + LINE_ORDER_SQL


@query("w05_sku_conflicts", oracle=f"""
with r as ({_W5_SRC}),
o as (select sku, arg_min(external_id, row({_W5_ORDER})) as owner from r group by sku),
k as (select r.* from r join o on r.sku = o.sku and r.external_id = o.owner),
w as (select *, row_number() over (partition by sku, external_id order by {", ".join(c + " desc" for c in _W5_ORDER.split(","))}) rn from k)
select sku, external_id, l_orderkey, l_linenumber, l_quantity, true as kept from w where rn = 1
union all
select r.sku, r.external_id, l_orderkey, l_linenumber, l_quantity, false as kept
from r join o on r.sku = o.sku and r.external_id <> o.owner
""")
def w05_sku_conflicts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_name").alias("sku"), F.col("p_partkey").alias("external_id"), "l_orderkey", "l_linenumber",
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus", "l_shipdate")
    kept, conflicts = dd.sku_conflicts(r, "sku", "external_id", ["l_orderkey", *b.LINE_ORDER])
    cols = ["sku", "external_id", "l_orderkey", "l_linenumber", "l_quantity"]
    return kept.select(*cols, F.lit(True).alias("kept")).unionByName(
        conflicts.select(*cols, F.lit(False).alias("kept")))


@query("w06_name_ci_first", oracle="""
select p_partkey, name from (
  select p_partkey, case when p_partkey % 2 = 0 then upper(p_name) else p_name end as name,
         row_number() over (partition by lower(p_name) order by p_partkey) rn from part) x where rn = 1
""")
def w06_name_ci_first(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"))
    return dd.first_by_name_ci(p, "name", ["p_partkey"])


@query("w07_discount_waterfall", oracle=f"""
with l as (select l_orderkey,
   cast(row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as integer) as line_index,
   cast(floor(l_extendedprice) as bigint) as value, l_returnflag = 'A' as first_line, 60000 as discount from lineitem),
p as (select *, coalesce(sum(value) over (partition by l_orderkey order by first_line desc, value desc, line_index
        rows between unbounded preceding and 1 preceding), 0) as prior from l)
select l_orderkey, line_index, value, first_line, discount,
  cast(value - (case when discount > 0 then greatest(0, least(value, discount - prior)) else 0 end) as bigint) as discounted_value
from p
""")
def w07_discount_waterfall(spark, sf_dir):
    li = b.with_line_index(Tables(spark, sf_dir).lineitem)
    lines = li.select("l_orderkey", "line_index", F.floor("l_extendedprice").cast("bigint").alias("value"),
                      (F.col("l_returnflag") == "A").alias("first_line"), F.lit(60000).alias("discount"))
    return rn.discount_waterfall(lines, ["l_orderkey"], "value", "discount", "first_line", "line_index")


_W7_CENTS = "cast(floor({0} * 100 + 0.5) as bigint)"


@query("w07_money_waterfall", oracle=f"""
with recursive l as (select l_orderkey,
   cast(row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as integer) as line_index,
   case when l_linenumber % 4 = 3 then -l_extendedprice / 90 else l_extendedprice / 7 end as value,
   case when l_linenumber = 5 then null else l_returnflag = 'A' end as first_line,
   (l_orderkey % 1000 - 20) * 37.777::double as discount from lineitem),
o as (select *, {_W7_CENTS.format("value")} as v, {_W7_CENTS.format("discount")} as d,
   row_number() over (partition by l_orderkey order by coalesce(first_line, false) desc, {_W7_CENTS.format("value")} desc, line_index) as k from l),
r as (
  select l_orderkey, line_index, k, v - case when d > 0 then least(v, d) else 0 end as paid,
    case when d > 0 then d - least(v, d) else 0 end as remaining from o where k = 1
  union all
  select o.l_orderkey, o.line_index, o.k, o.v - case when r.remaining > 0 then least(o.v, r.remaining) else 0 end,
    case when r.remaining > 0 then r.remaining - least(o.v, r.remaining) else 0 end
  from r join o on r.l_orderkey = o.l_orderkey and o.k = r.k + 1)
select l_orderkey, line_index, paid / 100 as discounted_value from r
""")
def w07_money_waterfall(spark, sf_dir):
    li = b.with_line_index(Tables(spark, sf_dir).lineitem)
    lines = li.select("l_orderkey", "line_index",
                      F.when(F.col("l_linenumber") % 4 == 3, -F.col("l_extendedprice") / 90)
                      .otherwise(F.col("l_extendedprice") / 7).alias("value"),
                      F.when(F.col("l_linenumber") != 5, F.col("l_returnflag") == "A").alias("first_line"),
                      ((F.col("l_orderkey") % 1000 - 20) * F.lit(37.777)).alias("discount"))
    out = rn.discount_waterfall(lines, ["l_orderkey"], "value", "discount", "first_line", "line_index")
    return out.select("l_orderkey", "line_index", "discounted_value")


@query("w08_procedure_source", oracle=f"""
with l as (select l_orderkey, cast(row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as integer) as line_index,
             l_partkey, l_suppkey, l_linenumber, l_linestatus, l_extendedprice, l_quantity from lineitem),
ev as (select l_orderkey as booking_id, line_index, l_partkey as id, 'P' || cast(l_partkey as varchar) as name,
         floor(l_extendedprice * 100 + 0.5) / 100 as value,
         case when l_linenumber = 4 then 1 else cast(l_quantity as bigint) end as quantity
       from l where not (l_linenumber = 6)),
tx as (select l_orderkey as booking_id, line_index,
         case when l_linenumber = 3 then 0 else l_suppkey end as id,
         case when l_linenumber = 5 then '' else 'S' || cast(l_suppkey as varchar) end as name,
         floor(l_extendedprice * 0.9 * 100 + 0.5) / 100 as value, cast(l_quantity as bigint) as quantity
       from l join orders on l_orderkey = o_orderkey
       where o_orderstatus <> 'O' and not (l_linestatus = 'O' and l_linenumber = 2)),
txv as (select * from tx where id > 0 and name <> ''),
has_tx as (select distinct l_orderkey as booking_id from l join orders on l_orderkey = o_orderkey where o_orderstatus <> 'O')
select booking_id, line_index, id, name, value, quantity, 'transaction' as source from txv
union all
select booking_id, line_index, id, name, value, quantity, 'event' as source from ev
where id > 0 and name <> '' and booking_id not in (select booking_id from has_tx)
""")
def w08_procedure_source(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = b.with_line_index(t.lineitem)
    ev = li.where(~(F.col("l_linenumber") == 6)).select(
        F.col("l_orderkey").alias("booking_id"), "line_index", F.col("l_partkey").alias("id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("name"),
        F.col("l_extendedprice").cast("string").alias("value_text"),
        F.when(F.col("l_linenumber") == 4, F.lit(None).cast("bigint"))
        .otherwise(F.col("l_quantity").cast("bigint")).alias("quantity"))
    tx_orders = t.orders.where(F.col("o_orderstatus") != "O").select(F.col("o_orderkey").alias("booking_id"))
    tx = li.join(tx_orders, F.col("l_orderkey") == F.col("booking_id")).select(
        "booking_id", "line_index",
        F.when(F.col("l_linenumber") == 3, F.lit(0)).otherwise(F.col("l_suppkey")).alias("id"),
        F.when(F.col("l_linenumber") == 5, F.lit("")).otherwise(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("name"),
        (F.col("l_extendedprice") * 0.9).cast("string").alias("value_text"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        ((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 2)).alias("deleted"))
    return bk.choose_procedures(ev, tx, tx_orders, "booking_id")


@query("w09_sticky_owner", oracle="""
select user_id,
  coalesce(arg_min(event_id % 7, row(ts, event_id)) filter (where event_id % 7 = 3), arg_max(event_id % 7, row(ts, event_id))) as rep,
  coalesce(arg_min(event_id % 7, row(ts, event_id)) filter (where event_id % 7 = 3), arg_max(event_id % 7, row(ts, event_id))) = 3 as fixed
from events group by user_id
""")
def w09_sticky_owner(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("user_id", "ts", "event_id", (F.col("event_id") % 7).alias("rep"))
    return dd.sticky_owner(e, "user_id", "rep", ["ts", "event_id"], principals=[3])


@query("w10_conversation_context", oracle="""
with t as (select conv_id, max(turn) as target_id from conversations where role = 'assistant' group by conv_id)
select c.conv_id, c.turn, c.role, c.text, t.target_id from conversations c join t on c.conv_id = t.conv_id and c.turn <= t.target_id
""")
def w10_conversation_context(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    targets = c.where(F.col("role") == "assistant").groupBy("conv_id").agg(F.max("turn").alias("target_id"))
    return dd.context_up_to(c, targets, "conv_id", "turn").select("conv_id", "turn", "role", "text", "target_id")


@query("w11_newest_orders", oracle="""
select o_orderkey, o_custkey, o_orderdate from orders order by o_orderkey desc limit 500
""")
def w11_newest_orders(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return dd.newest(o, 500, [F.col("o_orderkey").desc()])


@query("u01_created_updated_passes", oracle=f"""
with p as (select 1 as pass, {LI_COLS} from lineitem where l_returnflag <> 'R'
           union all
           select 2 as pass, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 100, l_extendedprice,
                  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate from lineitem where l_linestatus = 'F')
select l_orderkey, l_linenumber, pass, l_quantity from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by pass desc, {LINE_ORDER_DESC_SQL}) rn from p) x
where rn = 1
""")
def u01_created_updated_passes(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    created = li.where(F.col("l_returnflag") != "R").withColumn("pass", F.lit(1))
    updated = li.where(F.col("l_linestatus") == "F").withColumn("l_quantity", F.col("l_quantity") + 100) \
        .withColumn("pass", F.lit(2))
    out = dd.union_passes([created, updated], ["l_orderkey", "l_linenumber"], ["pass", *b.LINE_ORDER])
    return out.select("l_orderkey", "l_linenumber", "pass", "l_quantity")


@query("u02_active_inactive_lists", oracle="""
with u as (select 1 as list, p_brand as sku, p_partkey from part where p_size % 2 = 0
           union all select 2 as list, p_brand as sku, p_partkey from part)
select sku, list, p_partkey from (select *, row_number() over (partition by sku order by list, p_partkey) rn from u) x where rn = 1
""")
def u02_active_inactive_lists(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    active = p.where(F.col("p_size") % 2 == 0).select(F.lit(1).alias("list"), F.col("p_brand").alias("sku"), "p_partkey")
    inactive = p.select(F.lit(2).alias("list"), F.col("p_brand").alias("sku"), "p_partkey")
    return dd.union_first_wins([active, inactive], ["sku"], ["list", "p_partkey"]).select("sku", "list", "p_partkey")
