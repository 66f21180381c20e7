"""Configured-projection queries (S1, P1–P12) over customer / orders /
events, each through a mapping configuration as a client would write it."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.functions import mapping as mp
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables


def _dirty_customer(t):
    """customer plus a few dirty columns the treatments read."""
    k = F.col("c_custkey")
    return t.customer.select(
        "*",
        F.when(k % 3 == 0, F.lit(" ")).when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("alt_name"),
        F.concat(F.lit("(11) 9"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone_a"),
        F.when(k % 2 == 0, F.lit(None)).otherwise(F.concat(F.lit("21 "), k.cast("string"))).alias("phone_b"),
        F.concat(F.lit("R$ "), F.floor(F.abs("c_acctbal")).cast("bigint").cast("string"), F.lit(","),
                 F.lpad((F.floor(F.abs("c_acctbal") * 100).cast("bigint") % 100).cast("string"), 2, "0")).alias("bal_text"))


DIRTY_CUSTOMER_SQL = """(select *,
  case when c_custkey % 3 = 0 then ' ' when c_custkey % 5 = 0 then null else c_name end as alt_name,
  '(11) 9' || lpad(cast(c_custkey % 10000 as varchar), 4, '0') as phone_a,
  case when c_custkey % 2 = 0 then null else '21 ' || cast(c_custkey as varchar) end as phone_b,
  'R$ ' || cast(cast(floor(abs(c_acctbal)) as bigint) as varchar) || ',' ||
    lpad(cast(cast(floor(abs(c_acctbal) * 100) as bigint) % 100 as varchar), 2, '0') as bal_text
  from customer)"""


P1_CONFIG = {"id": "c_custkey", "name": {"field": " c_name "}, "missing": "no_such_column", "blank": "",
             "nation": {"field": "c_nationkey", "tratamento": None}}


@query("p01_direct_column", oracle="""
select c_custkey as id, c_name as name, cast(null as varchar) as missing, cast(null as varchar) as blank, c_nationkey as nation
from customer
""")
def p01_direct_column(spark, sf_dir):
    return mp.apply_mapping(Tables(spark, sf_dir).customer, P1_CONFIG)


P2_CONFIG = {
    "id": "c_custkey",
    "segment": {"field": "c_mktsegment", "tratamento": "mapear_valores",
                "options": {"BUILDING": "B", "AUTOMOBILE": None, "else": "OTHER"}},
    "name_or_raw": {"field": "alt_name", "tratamento": "mapear_valores", "options": {"": "EMPTY", " ": "SPACE"}},
}


@query("p02_map_values", oracle=f"""
select c_custkey as id,
  case when c_mktsegment = 'BUILDING' then 'B' when c_mktsegment = 'AUTOMOBILE' then null else 'OTHER' end as segment,
  case when coalesce(alt_name, '') = '' then 'EMPTY' when alt_name = ' ' then 'SPACE' else alt_name end as name_or_raw
from {DIRTY_CUSTOMER_SQL} c
""")
def p02_map_values(spark, sf_dir):
    return mp.apply_mapping(_dirty_customer(Tables(spark, sf_dir)), P2_CONFIG)


P3_CONFIG = {
    "id": "c_custkey",
    "hash": {"field": "c_name", "tratamento": "limpeza_regex", "options": {"regex": "[#9]", "map": {"#": "-"}}},
    "ci": {"field": "/ignored", "tratamento": "limpeza_regex",
           "options": {"source_field": "c_name", "regex": "customer", "flags": "gi", "map": {"Customer": "C"}}},
    "first": {"field": "c_name", "tratamento": "limpeza_regex", "options": {"regex": "0", "flags": "", "map": {"0": "o"}}},
    "bad": {"field": "c_name", "tratamento": "limpeza_regex", "options": {"regex": "([", "map": {"x": "y"}}},
    "nullmap": {"field": "alt_name", "tratamento": "limpeza_regex", "options": {"regex": "#", "map": {"#": None}}},
}


@query("p03_regex_clean", oracle=f"""
select c_custkey as id, replace(c_name, '#', '-') as hash, replace(c_name, 'Customer', 'C') as ci,
  regexp_replace(c_name, '0', 'o') as first, c_name as bad, replace(alt_name, '#', '') as nullmap
from {DIRTY_CUSTOMER_SQL} c
""")
def p03_regex_clean(spark, sf_dir):
    return mp.apply_mapping(_dirty_customer(Tables(spark, sf_dir)), P3_CONFIG)


P4_CONFIG = {"id": "c_custkey",
             "label": {"field": "", "tratamento": "concatenar_campos",
                       "options": {"concatenate": "{c_name} / { c_mktsegment } ({alt_name}){nope}!"}}}


@query("p04_concat_fields", oracle=f"""
select c_custkey as id, c_name || ' / ' || c_mktsegment || ' (' || coalesce(alt_name, '') || ')!' as label
from {DIRTY_CUSTOMER_SQL} c
""")
def p04_concat_fields(spark, sf_dir):
    return mp.apply_mapping(_dirty_customer(Tables(spark, sf_dir)), P4_CONFIG)


P5_CONFIG = {"id": "c_custkey",
             "name": {"tratamento": "usar_um_ou_outro", "options": {"main": "alt_name", "fallback": "c_mktsegment"}},
             "phone": {"tratamento": "usar_um_ou_outro", "options": {"main": "phone_b", "fallback": "nope"}}}


@query("p05_one_or_other", oracle=f"""
select c_custkey as id, case when alt_name is not null and trim(alt_name) <> '' then alt_name else c_mktsegment end as name,
  case when phone_b is not null and trim(phone_b) <> '' then phone_b end as phone
from {DIRTY_CUSTOMER_SQL} c
""")
def p05_one_or_other(spark, sf_dir):
    return mp.apply_mapping(_dirty_customer(Tables(spark, sf_dir)), P5_CONFIG)


P6_CONFIG = {"id": "event_id",
             "days": {"tratamento": "diferenca_entre_datas", "options": {"start": "ts", "end": "later"}},
             "days_text": {"tratamento": "diferenca_entre_datas", "options": {"start": "day_text", "end": "ts"}}}


@query("p06_date_difference", oracle="""
with e as (select event_id, ts, ts + to_hours(cast(event_id % 100 as integer)) as later,
             case when event_id % 7 = 0 then 'bad' else '2024-01-01' end as day_text from events)
select event_id as id, cast(floor((epoch_us(later) - epoch_us(ts)) / 86400e6 + 0.5) as bigint) as days,
  case when day_text = 'bad' then null else cast(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 86400e6 + 0.5) as bigint) end as days_text
from e
""")
def p06_date_difference(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    d = e.select("event_id", "ts", (F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 100).cast("int"))).alias("later"),
                 F.when(F.col("event_id") % 7 == 0, F.lit("bad")).otherwise(F.lit("2024-01-01")).alias("day_text"))
    return mp.apply_mapping(d, P6_CONFIG)


P7_CONFIG = {"id": "o_orderkey",
             "f1": {"tratamento": "formula_matematica", "options": {"formula": "{o_totalprice} * 2 / ({o_custkey} - 100) + 1,5"}},
             "f2": {"tratamento": "formula_matematica", "options": {"formula": "-({o_totalprice} + 10) / 4"}},
             "f3": {"tratamento": "formula_matematica", "options": {"formula": "{price_text} * 1.000,5"}},
             "f4": {"tratamento": "formula_matematica", "options": {"formula": "{o_totalprice} * (2"}},
             "f5": {"tratamento": "formula_matematica", "options": {"formula": "{nope} + 1"}},
             "f6": {"field": "{o_custkey} / 8", "tratamento": "formula_matematica"}}


@query("p07_formula", oracle="""
with o as (select *, case when o_orderkey % 4 = 0 then 'x' else cast(cast(floor(o_totalprice) as bigint) as varchar) || ',50' end as price_text from orders)
select o_orderkey as id,
  o_totalprice * 2 / nullif(cast(o_custkey as double) - 100, 0) + 1.5 as f1,
  -(o_totalprice + 10) / 4 as f2,
  cast(case when o_orderkey % 4 = 0 then null else (cast(floor(o_totalprice) as bigint) + 0.5) * 1000.5 end as double) as f3,
  cast(null as double) as f4, cast(null as double) as f5, o_custkey / 8 as f6
from o
""")
def p07_formula(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = o.withColumn("price_text", F.when(F.col("o_orderkey") % 4 == 0, F.lit("x")).otherwise(
        F.concat(F.floor("o_totalprice").cast("bigint").cast("string"), F.lit(",50"))))
    return mp.apply_mapping(d, P7_CONFIG)


@query("p07_formula_strict_compat", oracle="""
select o_orderkey as id, cast(null as double) as f1, cast(null as double) as f2, o_custkey / 8 as f6 from orders
""")
def p07_formula_strict_compat(spark, sf_dir):
    cfg = {k: P7_CONFIG[k] for k in ("id", "f1", "f2", "f6")}
    return mp.apply_mapping(Tables(spark, sf_dir).orders, cfg, strict_compat=True)


P8_CONFIG = {"id": "c_custkey",
             "extra": {"tratamento": "mapear_json", "options": {"map": {"n": "c_name", "seg": "c_mktsegment",
                                                                        "alt": "alt_name", "x": "no_col", "skip": ""}}}}


@query("p08_map_json", oracle=f"""
select c_custkey as id, to_json(json_object('n', c_name, 'seg', c_mktsegment, 'alt', alt_name, 'x', null))::varchar as extra
from {DIRTY_CUSTOMER_SQL} c
""")
def p08_map_json(spark, sf_dir):
    return mp.apply_mapping(_dirty_customer(Tables(spark, sf_dir)), P8_CONFIG)


ALL_CONFIG = {**P1_CONFIG, **P2_CONFIG, **P3_CONFIG, **P4_CONFIG, **P5_CONFIG, **P8_CONFIG,
              "phones_csv": "phone_a, phone_b"}


@query("p09_source_columns", oracle=f"""
select c_custkey, c_name, c_nationkey, c_mktsegment, alt_name, phone_a, phone_b from {DIRTY_CUSTOMER_SQL} c
""")
def p09_source_columns(spark, sf_dir):
    d = _dirty_customer(Tables(spark, sf_dir))
    return d.select(*mp.source_columns(ALL_CONFIG, available=d.columns))


@query("p09_source_column_values", oracle=f"""
with c as (select * from {DIRTY_CUSTOMER_SQL} x)
select 'c_custkey' as column_name, count(c_custkey) as n_values from c union all select 'c_name', count(c_name) from c
union all select 'c_nationkey', count(c_nationkey) from c union all select 'c_mktsegment', count(c_mktsegment) from c
union all select 'alt_name', count(alt_name) from c union all select 'phone_a', count(phone_a) from c
union all select 'phone_b', count(phone_b) from c union all select 'no_such_column', 0 union all select 'no_col', 0 union all select 'nope', 0
""")
def p09_source_column_values(spark, sf_dir):
    """The whole set that the mapping needs, with the number of values of each column (0: unknown to the source)."""
    d = _dirty_customer(Tables(spark, sf_dir))
    needed = mp.source_columns(ALL_CONFIG)
    counts = d.agg(*[(F.count(c) if c in d.columns else F.lit(0).cast("bigint")).alias(c) for c in needed])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in needed])).alias("r")).select("r.*")


@query("p10_phones_from_csv", oracle=f"""
select c_custkey as id, phone_a as celular, coalesce(phone_b, '') as comercial, coalesce(alt_name, '') as residencial,
  c_mktsegment as extra_4
from {DIRTY_CUSTOMER_SQL} c
""")
def p10_phones_from_csv(spark, sf_dir):
    d = _dirty_customer(Tables(spark, sf_dir))
    m = mp.phones_from_csv("phone_a, phone_b,, alt_name ,c_mktsegment", d.columns)
    return d.select(F.col("c_custkey").alias("id"), *[F.element_at(m, k).alias(k) for k in
                                                      ("celular", "comercial", "residencial", "extra_4")])


WHERE_CLAUSES = [
    {"field": "o_orderstatus", "operator": "weird", "value": "F"},
    {"field": "o_totalprice", "operator": ">=", "value": 1000},
    {"field": "o_orderpriority", "operator": "like", "value": "%URGENT"},
    {"field": "o_orderdate", "operator": ">", "value": None},
    {"field": "o_custkey", "operator": "<>", "value": None},
    {"field": "o_clerk", "operator": "="},
    {"field": "", "operator": "=", "value": 1},
]


@query("p11_configured_where", oracle="""
select o_orderkey, o_totalprice from orders
where o_orderstatus = 'F' and o_totalprice >= 1000 and o_orderpriority like '%URGENT' and o_custkey is not null
""")
def p11_configured_where(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.where(mp.compile_where(WHERE_CLAUSES)).select("o_orderkey", "o_totalprice")


@query("p12_date_range_filter", oracle="""
select event_id, ts >= timestamp '2024-01-05' and ts <= timestamp '2024-01-10' as bare_end,
  ts >= timestamp '2024-01-05' and ts <= timestamp '2024-01-10 23:59:59.999999' as whole_last_day
from events
""")
def p12_date_range_filter(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", mp.date_range_filter(F.col("ts"), "2024-01-05", "2024-01-10").alias("bare_end"),
                    mp.date_range_filter(F.col("ts"), "2024-01-05", "2024-01-10", whole_last_day=True)
                    .alias("whole_last_day"))


S1_CONFIG = {"external_id": "o_orderkey", "customer": "o_custkey",
             "status": {"field": "o_orderstatus", "tratamento": "mapear_valores",
                        "options": {"F": "entregue", "O": "novo", "else": "pendente"}},
             "total": {"tratamento": "formula_matematica", "options": {"formula": "{o_totalprice} / 100"}},
             "label": {"tratamento": "concatenar_campos", "options": {"concatenate": "{o_orderpriority}-{o_orderkey}"}}}


@query("s01_configured_source_read", oracle="""
select o_orderkey as external_id, o_custkey as customer,
  case o_orderstatus when 'F' then 'entregue' when 'O' then 'novo' else 'pendente' end as status,
  o_totalprice / 100 as total, o_orderpriority || '-' || cast(o_orderkey as varchar) as label
from orders where o_totalprice >= 1000 and o_orderdate >= timestamp '1995-01-01' and o_orderdate <= timestamp '1996-06-30'
""")
def s01_configured_source_read(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    src = o.where(mp.compile_where([{"field": "o_totalprice", "operator": ">=", "value": 1000}])
                  & mp.date_range_filter(F.col("o_orderdate"), "1995-01-01", "1996-06-30"))
    return mp.apply_mapping(src.select(*mp.source_columns(S1_CONFIG)), S1_CONFIG)
