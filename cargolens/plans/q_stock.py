"""Carrier matching and stock ledger queries.

Binding: every supplier is a logistics operator (company 1000 + s_suppkey,
a name made from the hash of s_name, its slug, one hashed synonym); an
order's carrier text is its first line's operator name, altered by key (exact, a letter dropped, a letter
doubled, upper case with spaces, slug + suffix, junk, blank); the origin
is the customer's region; stock rows are the (origin, operator company,
part) triples of the first two lines of every order, except region 4,
which has no stock (no operator restriction there).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import stock as sk
from cargolens.plans import bindings as b
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables

# --- Spark bindings -------------------------------------------------------------


def _op_name(s_name):
    return F.concat(F.upper(F.substring(F.md5(s_name), 1, 6)), F.lit(" Log"))


def operators_df(t):
    s = t.supplier
    return s.select(F.col("s_suppkey").alias("operator_id"), (F.col("s_suppkey") + 1000).alias("company_id"),
                    _op_name(F.col("s_name")).alias("company_name"),
                    F.lower(F.regexp_replace(_op_name(F.col("s_name")), " ", "-")).alias("slug"),
                    F.array(F.substring(F.md5(F.concat(F.col("s_name"), F.lit("x"))), 1, 8)).alias("synonyms"))


def orders_df(t):
    first_sup = t.lineitem.where(F.col("l_linenumber") == 1).groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sk"))
    o = b.tenant_orders(t).join(first_sup, F.col("o_orderkey") == F.col("l_orderkey"), "left") \
        .join(t.supplier.select("s_suppkey", "s_name"), F.col("sk") == F.col("s_suppkey"), "left")
    k = F.col("o_orderkey") % 6
    name = _op_name(F.col("s_name"))
    carrier = (F.when(F.col("o_orderkey") % 13 == 0, F.lit(" "))
               .when(k == 0, name)
               .when(k == 1, F.concat(F.substring(name, 1, 4), F.substring(name, 6, 100)))
               .when(k == 2, F.concat(F.substring(name, 1, 3), F.substring(name, 3, 100)))
               .when(k == 3, F.concat(F.lit("  "), F.upper(name), F.lit(" ")))
               .when(k == 4, F.concat(F.lower(F.regexp_replace(name, " ", "-")), F.lit(" express")))
               .otherwise(F.concat(F.lit("ZZ"), F.col("o_orderkey").cast("string"))))
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("company_id").alias("origin_id"),
                    carrier.alias("carrier"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("cancelado")).otherwise(F.lit("novo")).alias("status"))


def _stock_id(origin, logistic, product):
    return origin.cast("bigint") * 1000000000000 + logistic.cast("bigint") * 1000000 + product.cast("bigint")


def stock_df(t):
    o = b.tenant_orders(t).where(F.col("company_id") != 4)
    li = t.lineitem.where(F.col("l_linenumber") <= 2)
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    trip = j.select(F.col("company_id").alias("origin_id"), (F.col("l_suppkey") + 1000).alias("logistic_company_id"),
                    F.col("l_partkey").alias("product_id")).distinct()
    return trip.select(_stock_id(F.col("origin_id"), F.col("logistic_company_id"), F.col("product_id")).alias("stock_id"),
                       "origin_id", "logistic_company_id", "product_id",
                       (100 + F.col("product_id") % 50).alias("quantity"))


def ledger_df(t):
    o = b.tenant_orders(t).where(F.col("o_orderkey") % 7 == 0)
    li = t.lineitem.where(F.col("l_linenumber") == 1)
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(_stock_id(F.col("company_id"), F.col("l_suppkey") + 1000, F.col("l_partkey")).alias("stock_id"),
                    (-F.floor("l_quantity")).cast("bigint").alias("quantity"), F.lit("order").alias("type"),
                    F.col("o_orderkey").cast("string").alias("type_id")).distinct()


def items_df(t):
    li = t.lineitem
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_partkey")).alias("product_id"),
                     (F.col("l_quantity") * 0.9).alias("quantity"))


# --- DuckDB bindings ---------------------------------------------------------------

SQL_BINDINGS = """
tenant as (select c_custkey, n_regionkey as company_id from customer join nation on c_nationkey = n_nationkey),
tord as (select o.*, company_id from orders o join tenant on o_custkey = c_custkey),
ops as (select s_suppkey as operator_id, 1000 + s_suppkey as company_id, upper(substr(md5(s_name), 1, 6)) || ' Log' as company_name,
               lower(replace(upper(substr(md5(s_name), 1, 6)) || ' Log', ' ', '-')) as slug, substr(md5(s_name || 'x'), 1, 8) as syn from supplier),
terms as (select distinct operator_id, company_id, t from (
            select operator_id, company_id, lower(trim(syn)) as t from ops
            union all select operator_id, company_id, lower(trim(slug)) from ops
            union all select operator_id, company_id, lower(trim(company_name)) from ops) x where t <> ''),
fs as (select l_orderkey, min(l_suppkey) as sk from lineitem where l_linenumber = 1 group by 1),
ord0 as (select o_orderkey, o_orderstatus, company_id, upper(substr(md5(s_name), 1, 6)) || ' Log' as nm
  from tord left join fs on o_orderkey = l_orderkey left join supplier on sk = s_suppkey),
ord as (select o_orderkey as order_id, company_id as origin_id,
  case when o_orderkey % 13 = 0 then ' '
       when o_orderkey % 6 = 0 then nm
       when o_orderkey % 6 = 1 then substr(nm, 1, 4) || substr(nm, 6, 100)
       when o_orderkey % 6 = 2 then substr(nm, 1, 3) || substr(nm, 3, 100)
       when o_orderkey % 6 = 3 then '  ' || upper(nm) || ' '
       when o_orderkey % 6 = 4 then lower(replace(nm, ' ', '-')) || ' express'
       else 'ZZ' || cast(o_orderkey as varchar) end as carrier,
  case when o_orderstatus = 'P' then 'cancelado' else 'novo' end as status
  from ord0),
stock as (select distinct company_id as origin_id, l_suppkey + 1000 as logistic_company_id, l_partkey as product_id
          from lineitem join tord on l_orderkey = o_orderkey where l_linenumber <= 2 and company_id <> 4),
stock2 as (select cast(origin_id as bigint) * 1000000000000 + logistic_company_id * 1000000 + product_id as stock_id,
                  origin_id, logistic_company_id, product_id, 100 + product_id % 50 as quantity from stock),
ledger as (select distinct cast(company_id as bigint) * 1000000000000 + (l_suppkey + 1000) * 1000000 + l_partkey as stock_id,
                  cast(-floor(l_quantity) as bigint) as quantity, 'order' as type, cast(o_orderkey as varchar) as type_id
           from lineitem join tord on l_orderkey = o_orderkey where l_linenumber = 1 and o_orderkey % 7 = 0),
car as (select distinct lower(trim(carrier)) as c, origin_id from ord where status <> 'cancelado' and lower(trim(carrier)) <> ''),
cm as (select c, origin_id, operator_id, terms.company_id from car join terms on
         (c = t or (least(length(c), length(t)) >= 8 and (contains(c, t) or contains(t, c)))
          or (greatest(length(c), length(t)) >= 4 and levenshtein(c, t) <= case when greatest(length(c), length(t)) <= 7 then 1 else 2 end))),
cmf as (select * from cm where origin_id not in (select origin_id from stock2)
          or (origin_id, company_id) in (select origin_id, logistic_company_id from stock2)),
best as (select c as carrier_norm, origin_id, min(operator_id) as operator_id from cmf group by 1, 2)
"""


@query("j13_fuzzy_carrier_match", oracle=f"""
with {SQL_BINDINGS}
select best.carrier_norm, best.origin_id, best.operator_id, ops.company_id, ops.company_name
from best join ops using (operator_id)
""")
def j13_fuzzy_carrier_match(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = orders_df(t).where(F.col("status") != "cancelado")
    m = sk.match_operators(o.select("carrier", "origin_id"), operators_df(t), stock_df(t))
    return m.select("carrier_norm", "origin_id", "operator_id", "company_id", "company_name")


@query("a07_quantity_by_product", oracle="""
select l_orderkey as order_id, l_partkey as product_id, cast(sum(cast(greatest(0, floor(l_quantity * 0.9)) as bigint)) as bigint) as quantity
from lineitem where l_linenumber <> 7 and greatest(0, floor(l_quantity * 0.9)) > 0 group by 1, 2
""")
def a07_quantity_by_product(spark, sf_dir):
    return sk.quantity_by_product(items_df(Tables(spark, sf_dir)))


_APPLY_SQL = f"""
with {SQL_BINDINGS},
live as (select ord.*, lower(trim(carrier)) as carrier_norm from ord where status <> 'cancelado' and trim(coalesce(carrier, '')) <> ''),
res as (select live.order_id, live.origin_id, best.operator_id + 1000 as logistic_company_id
        from live join best on best.carrier_norm = live.carrier_norm and best.origin_id = live.origin_id),
q as (select l_orderkey as order_id, l_partkey as product_id, cast(sum(cast(greatest(0, floor(l_quantity * 0.9)) as bigint)) as bigint) as quantity
      from lineitem where l_linenumber <> 7 and greatest(0, floor(l_quantity * 0.9)) > 0 group by 1, 2),
qr as (select q.*, res.origin_id, res.logistic_company_id from q join res using (order_id)),
ws as (select qr.*, stock2.stock_id from qr left join stock2 using (origin_id, logistic_company_id, product_id)),
new as (select stock_id, -quantity as quantity, 'order' as type, cast(order_id as varchar) as type_id from ws
        where stock_id is not null and (stock_id, cast(order_id as varchar)) not in (select stock_id, type_id from ledger where type = 'order')),
delta as (select stock_id, sum(quantity) as d from new group by 1)
"""


@query("i13_stock_apply", oracle=_APPLY_SQL + """
select stock2.stock_id, cast(stock2.quantity + coalesce(delta.d, 0) as bigint) as quantity from stock2 left join delta using (stock_id)
""")
def i13_stock_apply(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = sk.apply_order_stock(orders_df(t), items_df(t), stock_df(t), ledger_df(t), operators_df(t))
    return r["stock"].select("stock_id", "quantity")


@query("i13_new_movements", oracle=_APPLY_SQL + """
select stock_id, quantity, type, type_id from new
""")
def i13_new_movements(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = sk.apply_order_stock(orders_df(t), items_df(t), stock_df(t), ledger_df(t), operators_df(t))
    return r["new_movements"]


@query("i13_missing_stock", oracle=_APPLY_SQL + """
select order_id, product_id, logistic_company_id from ws where stock_id is null
""")
def i13_missing_stock(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = sk.apply_order_stock(orders_df(t), items_df(t), stock_df(t), ledger_df(t), operators_df(t))
    return r["missing"]


@query("i14_stock_reversal", oracle=f"""
with {SQL_BINDINGS},
canc as (select cast(order_id as varchar) as type_id from ord where status = 'cancelado'),
back as (select stock_id, sum(abs(quantity)) as b from ledger where type = 'order' and type_id in (select type_id from canc) group by 1)
select stock2.stock_id, cast(stock2.quantity + coalesce(back.b, 0) as bigint) as quantity from stock2 left join back using (stock_id)
""")
def i14_stock_reversal(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = sk.reverse_cancelled(orders_df(t), stock_df(t), ledger_df(t))
    return r["stock"].select("stock_id", "quantity")


@query("i13_ledger", oracle=_APPLY_SQL + """
select stock_id, quantity, type, type_id from ledger union all select stock_id, quantity, type, type_id from new
""")
def i13_ledger(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sk.apply_order_stock(orders_df(t), items_df(t), stock_df(t), ledger_df(t), operators_df(t))["ledger"]


@query("i13_order_carriers", oracle=_APPLY_SQL + """
select ord.order_id, ord.origin_id, coalesce(ops.company_name, ord.carrier) as carrier, ord.status
from ord left join res on res.order_id = ord.order_id left join ops on ops.company_id = res.logistic_company_id
""")
def i13_order_carriers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sk.apply_order_stock(orders_df(t), items_df(t), stock_df(t), ledger_df(t), operators_df(t))["orders"].select(
        "order_id", "origin_id", "carrier", "status")


@query("i14_reversed_ledger", oracle=f"""
with {SQL_BINDINGS}
select stock_id, quantity, type, type_id from ledger
where type_id not in (select cast(order_id as varchar) from ord where status = 'cancelado')
""")
def i14_reversed_ledger(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sk.reverse_cancelled(orders_df(t), stock_df(t), ledger_df(t))["ledger"]


# Several states of an order in one run: as it came, cancelled (keys % 3 = 0),
# live again with twice the quantity (keys % 6 = 0), once more (keys % 12 = 0).

def _events(t):
    o = orders_df(t).where(F.col("status") != "cancelado")
    k = F.col("order_id")
    state = lambda seq, status, kept: o.where(kept).select(F.lit(seq).alias("seq"), "order_id", "origin_id", "carrier", F.lit(status).alias("status"))
    return state(1, "novo", F.lit(True)).unionByName(state(2, "cancelado", k % 3 == 0)).unionByName(state(3, "novo", k % 6 == 0)) \
        .unionByName(state(4, "entregue", k % 12 == 0))


def _event_items(t):
    i = items_df(t)
    k = F.col("order_id")
    return i.withColumn("seq", F.lit(1)).unionByName(i.where(k % 6 == 0).withColumn("quantity", F.col("quantity") * 2).withColumn("seq", F.lit(3))) \
        .unionByName(i.where(k % 12 == 0).withColumn("quantity", F.col("quantity") * 5).withColumn("seq", F.lit(4)))


_NET_SQL = _APPLY_SQL.replace("new as (", "unused_new as (", 1).rsplit("delta as (", 1)[0].rstrip().rstrip(",") + """,
kept as (select * from ledger where cast(type_id as bigint) % 3 <> 0 or type_id in (select cast(order_id as varchar) from ord where status = 'cancelado')),
q2 as (select l_orderkey as order_id, l_partkey as product_id,
  cast(sum(cast(greatest(0, floor(l_quantity * 0.9 * case when l_orderkey % 6 = 0 then 2 else 1 end)) as bigint)) as bigint) as quantity
  from lineitem where l_linenumber <> 7 and greatest(0, floor(l_quantity * 0.9 * case when l_orderkey % 6 = 0 then 2 else 1 end)) > 0 group by 1, 2),
new as (select stock2.stock_id, -q2.quantity as quantity, 'order' as type, cast(q2.order_id as varchar) as type_id
  from q2 join res using (order_id) join stock2 using (origin_id, logistic_company_id, product_id)
  where (q2.order_id % 3 <> 0 or q2.order_id % 6 = 0)
    and (stock2.stock_id, cast(q2.order_id as varchar)) not in (select stock_id, type_id from kept)),
final as (select * from kept union all select * from new),
moved as (select stock_id, sum(quantity) as d from new group by 1),
returned as (select stock_id, sum(abs(quantity)) as b from ledger where (stock_id, quantity, type_id) not in (select stock_id, quantity, type_id from kept) group by 1)
"""


@query("i14_net_ledger", oracle=_NET_SQL + "select stock_id, quantity, type, type_id from final")
def i14_net_ledger(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sk.net_movements(_events(t), stock_df(t), ledger_df(t), _event_items(t), operators_df(t))["ledger"]


@query("i14_net_stock", oracle=_NET_SQL + """
select stock2.stock_id, cast(stock2.quantity + coalesce(moved.d, 0) + coalesce(returned.b, 0) as bigint) as quantity
from stock2 left join moved using (stock_id) left join returned using (stock_id)
""")
def i14_net_stock(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return sk.net_movements(_events(t), stock_df(t), ledger_df(t), _event_items(t), operators_df(t))["stock"].select("stock_id", "quantity")


# Names of common words: operators share them with each other and with the carriers.

_WORD_SQL = """(case {k} % 4 when 0 then 'Transportadora' when 1 then 'Expresso' when 2 then 'Rapido' else 'Transportes' end
  || ' ' || case {k} % 5 when 0 then 'Nordeste' when 1 then 'Sul' when 2 then 'Rodoviario' when 3 then 'Cargas' else 'Logistica' end
  || ' ' || case {k} % 3 when 0 then 'Brasil' when 1 then 'Ltda' else 'SA' end)"""


def _shared_names(t):
    word = F.expr(_WORD_SQL.format(k="s_suppkey"))
    operators = t.supplier.select(F.col("s_suppkey").alias("operator_id"), (F.col("s_suppkey") + 1000).alias("company_id"), word.alias("company_name"),
                                  F.concat(F.lit("op"), F.col("s_suppkey").cast("string")).alias("slug"),
                                  F.array(F.concat(word, F.lit(" "), (F.col("s_suppkey") % 7).cast("string"))).alias("synonyms"))
    name = F.expr(_WORD_SQL.format(k="(o_custkey + 1)"))
    carrier = F.expr("case o_orderkey % 5 when 0 then n when 1 then substr(n, 3) when 2 then concat(upper(n), ' filial ', o_custkey % 11) "
                     "when 3 then concat(substr(n, 1, 5), 'x', substr(n, 7)) else concat('op', o_custkey % 40) end")
    carriers = t.orders.withColumn("n", name).select(carrier.alias("carrier"), (F.col("o_custkey") % 3).alias("origin_id"))
    return carriers, operators


@query("j13_shared_words", oracle=f"""
with ops as (select s_suppkey as operator_id, 1000 + s_suppkey as company_id, {_WORD_SQL.format(k="s_suppkey")} as company_name from supplier),
terms as (select distinct operator_id, company_id, t from (select operator_id, company_id, lower(company_name) as t from ops
  union all select operator_id, company_id, 'op' || cast(operator_id as varchar) from ops
  union all select operator_id, company_id, lower(company_name) || ' ' || cast(operator_id % 7 as varchar) from ops) x),
n as (select *, {_WORD_SQL.format(k="(o_custkey + 1)")} as n from orders),
car as (select distinct lower(trim(case o_orderkey % 5 when 0 then n when 1 then substr(n, 3) when 2 then upper(n) || ' filial ' || cast(o_custkey % 11 as varchar)
  when 3 then substr(n, 1, 5) || 'x' || substr(n, 7) else 'op' || cast(o_custkey % 40 as varchar) end)) as c, o_custkey % 3 as origin_id from n),
best as (select c as carrier_norm, origin_id, min(operator_id) as operator_id from car join terms on
  (c = t or (least(length(c), length(t)) >= 8 and (contains(c, t) or contains(t, c)))
   or (greatest(length(c), length(t)) >= 4 and levenshtein(c, t) <= case when greatest(length(c), length(t)) <= 7 then 1 else 2 end)) group by 1, 2)
select best.carrier_norm, best.origin_id, best.operator_id, ops.company_id, ops.company_name from best join ops using (operator_id)
""")
def j13_shared_words(spark, sf_dir):
    carriers, operators = _shared_names(Tables(spark, sf_dir))
    return sk.match_operators(carriers, operators).select("carrier_norm", "origin_id", "operator_id", "company_id", "company_name")
