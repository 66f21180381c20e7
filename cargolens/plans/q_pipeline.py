"""Pipeline queries: entity dependency order (I18) and audited run."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import pipeline as pp
from cargolens.plans.q_upsert import INCOMING_SQL, TARGET_SQL, _incoming, _target
from cargolens.operators.upsert import upsert
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables


@query("i18_entity_dependency_order", oracle="""
with reps as (select s_suppkey from supplier where s_suppkey % 3 <> 0 or s_suppkey % 2 = 0),
prods as (select p_partkey from part where p_partkey % 3 <> 0 or p_partkey % 2 = 0)
select l_orderkey, l_linenumber, r.s_suppkey as rep_id, p.p_partkey as product_id
from lineitem left join reps r on r.s_suppkey = l_suppkey left join prods p on p.p_partkey = l_partkey
""")
def i18_entity_dependency_order(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s, p = t.supplier.select("s_suppkey", "s_name"), t.part.select("p_partkey", "p_name")
    stored = {"representatives": s.where(F.col("s_suppkey") % 3 != 0),
              "products": p.where(F.col("p_partkey") % 3 != 0)}
    incoming = {"representatives": s.where(F.col("s_suppkey") % 2 == 0).withColumn("s_name", F.upper("s_name")),
                "products": p.where(F.col("p_partkey") % 2 == 0)}
    snaps = pp.sync_entities(stored, incoming, {"representatives": ["s_suppkey"], "products": ["p_partkey"]})
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    out = pp.resolve_item_refs(items, snaps, {"rep_id": (F.col("l_suppkey"), "representatives", "s_suppkey"),
                                              "product_id": (F.col("l_partkey"), "products", "p_partkey")})
    return out.select("l_orderkey", "l_linenumber", "rep_id", "product_id")


@query("s15_run_audit", oracle=f"""
with u as (select t.c_custkey as t_key, i.c_custkey as i_key
           from {TARGET_SQL} t full outer join {INCOMING_SQL} i on t.c_custkey = i.c_custkey)
select cast(7 as bigint) as company_id, 'customers' as entity, 'FINALIZADO' as status,
  count(*) filter (where t_key is null) as inserted, count(*) filter (where t_key is not null and i_key is not null) as updated,
  count(*) filter (where i_key is null) as kept
from u
""")
def s15_run_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    u = upsert(_target(t), _incoming(t), ["c_custkey"])
    metrics = {"inserted": F.count_if(F.col("_action") == "insert"), "updated": F.count_if(F.col("_action") == "update"),
               "kept": F.count_if(F.col("_action") == "keep")}
    row = pp.audited_write(spark, u, lambda d: d.write.format("noop").mode("overwrite").save(), 7, "customers", metrics)
    return row.select("company_id", "entity", "status", *[F.col("counters")[k].alias(k) for k in metrics])
