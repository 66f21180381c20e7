"""Status map queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.functions import status as S
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables

PLATFORMS = ["precode", "tray", "anymarket", "panorama"]
# Raw statuses per platform as they arrive (case/space noise, one unmapped each).
RAW = {
    "precode": [" Novo", "ANALISANDO", "em viagem", "Solicitado Devolução", "retornou", "sumido"],
    "tray": ["Enviado", " a enviar ", "FINALIZADO", "Cancelado Aut", "Frete Não Atendido", "desconhecido"],
    "anymarket": ["concluded", "PAID_WAITING_SHIP", " canceled ", "PENDING", "REFUNDED"],
    "panorama": ["1", " 7", "12abc", "18", "99", "x"],
}


def _q(s):
    return "'" + s.replace("'", "''") + "'"


def _raw_sql():
    parts = []
    for i, p in enumerate(PLATFORMS):
        opts = RAW[p]
        inner = " ".join(f"when (o_orderkey // 4) % {len(opts)} = {j} then {_q(v)}" for j, v in enumerate(opts))
        parts.append(f"when o_orderkey % 4 = {i} then (case {inner} end)")
    return "(case " + " ".join(parts) + " end)"


def _raw_col():
    k = F.col("o_orderkey")
    expr = None
    for i, p in enumerate(PLATFORMS):
        opts = RAW[p]
        v = F.element_at(F.array(*[F.lit(x) for x in opts]), ((k / 4).cast("bigint") % len(opts) + 1).cast("int"))
        expr = F.when(k % 4 == i, v) if expr is None else expr.when(k % 4 == i, v)
    return expr


# Company overrides (configuration): company 1 re-maps two Tray statuses.
OVERRIDE_JSON = {
    1: '[{"key": "enviado", "value": "em transporte"}, {"tray": "Desconhecido", "our": "pendente"}, '
       '{"from": "a enviar", "to": "not a status"}]',
    2: '[{"status": "cancelado aut", "mapped": "devolvido"}, {"key": 5, "value": "novo"}]',
}
OVERRIDE_ROWS = [(1, "enviado", "em transporte"), (1, "desconhecido", "pendente"), (2, "cancelado aut", "devolvido")]


# The statuses that the maps may give, and what each partner's raw status means (the oracle's own copy).
EXPECTED_STATUSES = [
    "novo", "aguardando pagamento", "pendente", "em analise", "aprovado", "faturando", "coletando", "aguardando disponibilidade",
    "aguardando transporte", "em transporte", "entregue marketplace", "entregue", "devolvido", "cancelado", "frete não atendido",
    "desmembrado", "bloqueado"]
EXPECTED_MAPS = {
    "precode": {
        "novo": "novo", "analisando": "em analise", "aprovado": "aprovado", "faturando": "faturando", "coletando": "coletando",
        "em viagem": "em transporte", "entregue": "entregue", "devolvido": "devolvido", "cancelado": "cancelado",
        "bloqueado": "bloqueado", "retornando": "devolvido", "retornou": "devolvido", "devolvendo": "devolvido",
        "solicitado devolução": "devolvido", "desmembrado": "desmembrado"},
    "tray": {
        "aguardando pagamento": "aguardando pagamento", "aguardando envio": "aguardando transporte",
        "a enviar": "aguardando transporte", "enviado": "entregue", "finalizado": "entregue", "cancelado": "cancelado",
        "cancelado aut": "cancelado", "compra em analise": "em analise", "pendente": "pendente",
        "em monitoramento": "em transporte", "aguardando disponibilidade": "aguardando disponibilidade",
        "entregue leroy": "entregue marketplace", "frete não atendido": "frete não atendido", "a enviar yapay": "em analise",
        "aguardando yapay": "aguardando pagamento", "a enviar vindi": "em analise", "aguardando vindi": "aguardando pagamento"},
    "anymarket": {
        "CONCLUDED": "entregue", "CANCELED": "cancelado", "CANCELLED": "cancelado", "INVOICED": "faturando",
        "PAID_WAITING_DELIVERY": "em transporte", "PAID_WAITING_SHIP": "aguardando transporte", "PENDING": "aguardando pagamento"},
    "panorama": {
        "1": "aguardando pagamento", "2": "cancelado", "3": "aprovado", "4": "coletando", "5": "faturando", "6": "em transporte",
        "7": "entregue", "8": "em transporte", "9": "faturando", "10": "aguardando transporte", "11": "em analise",
        "12": "cancelado", "13": "cancelado", "14": "devolvido", "15": "faturando", "16": "cancelado", "17": "bloqueado",
        "18": "em analise"},
}


def _dim_values():
    return ", ".join(f"({_q(p)}, {_q(k)}, {_q(v)})" for p, m in EXPECTED_MAPS.items() for k, v in m.items())


_KEY_SQL = """(case platform when 'anymarket' then upper(trim(raw))
  when 'panorama' then cast(try_cast(nullif(regexp_extract(trim(raw), '^[+-]?\\d+', 0), '') as bigint) as varchar)
  else lower(trim(raw)) end)"""


@query("n16_status_map", oracle=f"""
with o as (select o_orderkey, o_custkey % 3 as company_id,
  (case o_orderkey % 4 {' '.join(f"when {i} then {_q(p)}" for i, p in enumerate(PLATFORMS))} end) as platform,
  {_raw_sql()} as raw from orders),
k as (select *, {_KEY_SQL} as skey from o),
dim(platform, status_key, status) as (values {_dim_values()}),
ov(company_id, status_key, status) as (values {", ".join(f"({c}, {_q(k)}, {_q(v)})" for c, k, v in OVERRIDE_ROWS)})
select k.o_orderkey, k.company_id, k.platform, k.raw,
  coalesce(case when k.platform = 'tray' then ov.status end, dim.status) as status,
  coalesce(case when k.platform = 'tray' then ov.status end, dim.status) is null as status_unmapped
from k left join dim on dim.platform = k.platform and dim.status_key = k.skey
left join ov on ov.company_id = k.company_id and ov.status_key = k.skey
""")
def n16_status_map(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = o.select("o_orderkey", (F.col("o_custkey") % 3).alias("company_id"),
                 F.element_at(F.array(*[F.lit(p) for p in PLATFORMS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
                 .alias("platform"),
                 _raw_col().alias("raw"))
    cfg = spark.createDataFrame([(c, j) for c, j in OVERRIDE_JSON.items()], "company_id long, status_map string")
    ov = S.custom_status_rows(cfg)
    out = S.map_status(d, "platform", "raw", spark=spark, overrides=ov, on_unmapped="quarantine")
    return out.select("o_orderkey", "company_id", "platform", "raw", "status", "status_unmapped")


# A per-nation override config built from the nation names.
_N17_JSON_SQL = """'[{"key": "' || n_name || '", "value": "' || (case n_nationkey % 3 when 0 then 'entregue' when 1 then 'cancelado' else 'nope' end)
 || '"}, {"tray": " ' || lower(n_name) || 'X ", "our": "pendente"}, {"from": ' || cast(n_nationkey as varchar)
 || ', "to": "novo"}, {"status": "", "from": "S' || n_name || '", "mapped": "devolvido"}]'"""


def _n17_json():
    return F.concat(
        F.lit('[{"key": "'), F.col("n_name"), F.lit('", "value": "'),
        F.element_at(F.array(F.lit("entregue"), F.lit("cancelado"), F.lit("nope")),
                     (F.col("n_nationkey") % 3 + 1).cast("int")),
        F.lit('"}, {"tray": " '), F.lower("n_name"), F.lit('X ", "our": "pendente"}, {"from": '),
        F.col("n_nationkey").cast("string"), F.lit(', "to": "novo"}, {"status": "", "from": "S'),
        F.col("n_name"), F.lit('", "mapped": "devolvido"}]'))


@query("n17_custom_status_map", oracle=f"""
with c as (select n_nationkey as company_id, {_N17_JSON_SQL} as j from nation),
e as (select company_id, unnest(cast(json_extract(j, '$[*]') as json[])) as v, generate_subscripts(cast(json_extract(j, '$[*]') as json[]), 1) as pos from c),
p as (select company_id, pos,
  lower(trim(coalesce(
    case when json_type(v, '$.key') = 'VARCHAR' and v->>'$.key' <> '' then v->>'$.key' end,
    case when json_type(v, '$.tray') = 'VARCHAR' and v->>'$.tray' <> '' then v->>'$.tray' end,
    case when json_type(v, '$.from') = 'VARCHAR' and v->>'$.from' <> '' then v->>'$.from' end,
    case when json_type(v, '$.status') = 'VARCHAR' and v->>'$.status' <> '' then v->>'$.status' end))) as status_key,
  coalesce(
    case when json_type(v, '$.value') = 'VARCHAR' and v->>'$.value' <> '' then v->>'$.value' end,
    case when json_type(v, '$.our') = 'VARCHAR' and v->>'$.our' <> '' then v->>'$.our' end,
    case when json_type(v, '$.to') = 'VARCHAR' and v->>'$.to' <> '' then v->>'$.to' end,
    case when json_type(v, '$.mapped') = 'VARCHAR' and v->>'$.mapped' <> '' then v->>'$.mapped' end) as status
  from e)
select company_id, status_key, arg_max(status, pos) as status from p
where status_key is not null and status in ({", ".join(_q(s) for s in EXPECTED_STATUSES)})
group by company_id, status_key
""")
def n17_custom_status_map(spark, sf_dir):
    n = Tables(spark, sf_dir).nation
    cfg = n.select(F.col("n_nationkey").alias("company_id"), _n17_json().alias("status_map"))
    return S.custom_status_rows(cfg)
