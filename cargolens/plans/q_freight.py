"""Freight queries: A1 (flagship), W1, W2, A2, J15, N33, N34."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.functions.freight_labels import deadline_bucket, freight_range
from cargolens.operators import freight as fr
from cargolens.plans import bindings as b
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables

# --- shared oracle fragments (DuckDB) --------------------------------------

LINE_ORDER_SQL = ("l_linenumber,l_partkey,l_suppkey,l_quantity,l_extendedprice,"
                  "l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate")

FREIGHT_CTES = f"""
tenant as (select c_custkey, n_regionkey as company_id, concat('S', cast(n_nationkey % 3 as varchar)) as state
           from customer join nation on c_nationkey = n_nationkey),
quotes as (select o_orderkey as id, company_id, cast(date_trunc('year', o_orderdate) as date) as date,
                  o_orderpriority as channel, state, o_totalprice as invoice_value, o_orderstatus, o_totalprice
           from orders join tenant on o_custkey = c_custkey),
opts as (select l_orderkey as quote_id,
  cast(row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as integer) as line_index,
  case when l_linestatus='O' and l_linenumber=7 then null
       when l_returnflag='R' and l_linenumber=1 then 0.0e0
       when l_orderkey % 97 = 0 then l_extendedprice
       else floor(l_extendedprice*2)/100 end as shipping_value,
  cast(l_quantity as int)+3*(l_linenumber-1) as deadline,
  concat(' CARRIER_', cast(l_suppkey % 4 as varchar), ' ') as carrier from lineitem),
best as (select * from (select *, row_number() over (partition by quote_id order by shipping_value, deadline, line_index) rn
                        from opts where shipping_value is not null and deadline is not null) x where rn=1),
items as (select distinct l_orderkey as quote_id,
                 case when l_linenumber=7 then null else l_partkey % 5 end as product_id from lineitem),
lines as (select q.id, i.product_id, count(*) over (partition by q.id) as n
          from quotes q left join items i on i.quote_id=q.id),
ford as (select id as quote_id, floor(o_totalprice*5)/100 as freight_amount from quotes where o_orderstatus='F')
"""

RANGE_SQL = """case when {v} is null then null when {v}=0 then 'R$0,00 (FREE)'
 when {v}<=100 then 'entre R$ 0,01 e R$ 100,00' when {v}<=200 then 'entre R$ 100,01 e R$ 200,00'
 when {v}<=300 then 'entre R$ 200,01 e R$ 300,00' when {v}<=500 then 'entre R$ 300,01 e R$ 500,00'
 when {v}<=1000 then 'entre R$ 500,01 e R$ 1.000,00' when {v}<=10000 then 'entre R$ 1.000,01 e R$ 10.000,00'
 else 'acima de R$ 10.000,00' end"""

BUCKET_SQL = """case when {d} is null then null when {d}<=5 then '>0'
 when {d}<=45 then concat('>', cast(cast(ceil({d}/5.0) as int)*5-5 as varchar))
 when {d}<=60 then '>45' else '>60' end"""


def _freight_inputs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return b.freight_quotes(t), b.freight_options(t), b.freight_items(t), b.freight_orders(t)


def a1_rollup(spark, sf_dir, **sliced):
    quotes, options, items, orders = _freight_inputs(spark, sf_dir)
    r = fr.freight_rollup(quotes, options, items, orders, **sliced)
    return r.select(*fr.ROLLUP_KEYS, "total_simulations", "total_orders",
                    F.round("total_value_simulations", 6).alias("total_value_simulations"),
                    F.round("total_value_orders", 6).alias("total_value_orders"))


A1_SQL = f"""
with {FREIGHT_CTES}
select q.company_id, q.date, trim(q.channel) as channel, upper(trim(q.state)) as state,
 {RANGE_SQL.format(v='b.shipping_value')} as freight_range,
 {BUCKET_SQL.format(d='b.deadline')} as deadline_bucket,
 coalesce(trim(b.carrier),'') as courier, l.product_id,
 count(*) as total_simulations, count(f.quote_id) as total_orders,
 round(sum(q.invoice_value/l.n),6) as total_value_simulations,
 round(sum(coalesce(f.freight_amount,0)/l.n),6) as total_value_orders
from quotes q join lines l on l.id=q.id left join best b on b.quote_id=q.id left join ford f on f.quote_id=q.id
{{where}}
group by all
"""

query("a1_freight_rollup", oracle=A1_SQL.format(where=""))(a1_rollup)


@query("a1_daily_slice", oracle=A1_SQL.format(where="where q.date = date '1995-01-01' and q.company_id = 2"))
def a1_daily_slice(spark, sf_dir):
    """The rollup of one day and company, its two arguments."""
    return a1_rollup(spark, sf_dir, days=["1995-01-01"], company_id=2)


@query("w1_cheapest_option", oracle=f"""
with {FREIGHT_CTES}
select quote_id as freight_quote_id, shipping_value, deadline, carrier, line_index from best
""")
def w1_cheapest_option(spark, sf_dir):
    _, options, _, _ = _freight_inputs(spark, sf_dir)
    return fr.cheapest_option(options)


@query("a2_even_allocation", oracle=f"""
with {FREIGHT_CTES}
select id as quote_id, product_id, n as n_lines, round(invoice_value / n, 6) as invoice_value_share
from quotes q join lines l using (id)
""")
def a2_even_allocation(spark, sf_dir):
    quotes, _, items, _ = _freight_inputs(spark, sf_dir)
    parents = quotes.select(F.col("id").alias("quote_id_"), "invoice_value")
    out = fr.allocate_evenly(parents, items, "quote_id_", ["invoice_value"])
    return out.select(F.col("quote_id_").alias("quote_id"), "product_id", "n_lines",
                      F.round("invoice_value_share", 6).alias("invoice_value_share"))


@query("j15_quote_order_join", oracle=f"""
with {FREIGHT_CTES}
select q.id as quote_id, q.company_id, f.freight_amount, f.quote_id is not null as has_order
from quotes q left join ford f on f.quote_id = q.id
""")
def j15_quote_order_join(spark, sf_dir):
    quotes, _, _, orders = _freight_inputs(spark, sf_dir)
    o = fr.order_per_quote(orders)
    j = quotes.join(o.withColumnRenamed("company_id", "oc").withColumnRenamed("quote_id", "oq"),
                    (F.col("company_id") == F.col("oc")) & (F.col("quote_id") == F.col("oq")), "left")
    return j.select(F.col("id").alias("quote_id"), "company_id", "freight_amount",
                    F.col("oq").isNotNull().alias("has_order"))


@query("w2_best_option_score", oracle=f"""
with o as (select l_orderkey as freight_quote_id,
  cast(row_number() over (partition by l_orderkey order by {LINE_ORDER_SQL}) as integer) as line_index,
  l_quantity % 10 as cd, case when l_linenumber = 1 then 0.0 else floor(l_extendedprice*2)/100 end as p
  from lineitem),
v as (select * from o where cd > 0 and p >= 0),
m as (select freight_quote_id, min(cd) as min_cd, min(p) as min_p from v group by 1),
s as (select v.*, (cd = min_cd and p = min_p) as dom,
        cd / min_cd + p / (case when min_p = 0 then 1.0 else min_p end) as score from v join m using (freight_quote_id)),
r as (select *, row_number() over (partition by freight_quote_id
        order by case when dom then 0 else 1 end, case when dom then 0.0 else score end, line_index) as rn from s)
select freight_quote_id, line_index, cd as carrier_deadline, p as price, dom as by_dominance from r where rn = 1
""")
def w2_best_option_score(spark, sf_dir):
    return fr.best_option_score(b.w2_options(Tables(spark, sf_dir)))


@query("n33_freight_range", oracle=f"""
select l_orderkey, l_linenumber, l_extendedprice,
  {RANGE_SQL.format(v='(l_extendedprice / 10 - 500)')} as freight_range
from lineitem
""")
def n33_freight_range(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                     freight_range(F.col("l_extendedprice") / 10 - 500).alias("freight_range"))


@query("n34_deadline_bucket", oracle=f"""
select l_orderkey, l_linenumber, l_quantity,
  {BUCKET_SQL.format(d='(cast(l_quantity as bigint) + l_linenumber * 3 - 8)')} as deadline_bucket
from lineitem
""")
def n34_deadline_bucket(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    d = F.col("l_quantity").cast("bigint") + F.col("l_linenumber") * 3 - 8
    return li.select("l_orderkey", "l_linenumber", "l_quantity", deadline_bucket(d).alias("deadline_bucket"))
