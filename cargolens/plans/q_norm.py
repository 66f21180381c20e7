"""Scalar normaliser queries.

Each query derives one dirty text per customer (a template picked by key,
filled with that customer's own key, balance, name and segment), over the
whole customer table, and applies the function. The oracle computes the
same dirty text and the same rule in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.functions import dates as D
from cargolens.functions import parse as P
from cargolens.functions import text as T
from cargolens.plans.dual import dirty_customer_text
from cargolens.plans.registry import query
from cargolens.sources.tables import Tables

# --- DuckDB fragments --------------------------------------------------------

DEC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def jsn(x: str) -> str:
    """JS Number(text) in DuckDB (null for NaN)."""
    t = ws(x)
    return (f"(case when {x} is null then null when {t} = '' then 0.0 "
            f"when regexp_matches({t}, '{DEC}') then try_cast({t} as double) "
            f"when regexp_matches({t}, '^0[xX][0-9a-fA-F]+$') then cast(try_cast({t} as bigint) as double) "
            f"when regexp_matches({t}, '^\\+?Infinity$') then 'Infinity'::double "
            f"when {t} = '-Infinity' then '-Infinity'::double end)")


def fin(x: str) -> str:
    return f"(case when isfinite({x}) then {x} end)"


def _customer_query(name: str, templates, spark_fn, sql_result: str, salt: int = 0,
                    extra_cols: dict | None = None):
    """Register ``name``: raw text per customer → ``result`` (and extras)."""
    raw = dirty_customer_text(templates, salt)
    extras_sql = "".join(f", {v} as {k}" for k, v in (extra_cols or {}).items())
    oracle = (f"select c_custkey, raw, {sql_result} as result{extras_sql} "
              f"from (select c_custkey, {raw.sql} as raw from customer) d")

    def run(spark, sf_dir):
        c = Tables(spark, sf_dir).customer.select("c_custkey", raw.col.alias("raw"))
        out = spark_fn(F.col("raw"))
        if isinstance(out, dict):
            return c.select("c_custkey", "raw", *[v.alias(k) for k, v in out.items()])
        return c.select("c_custkey", "raw", out.alias("result"))

    run.__name__ = name
    query(name, oracle=oracle)(run)


W = ws("raw")

# N1 -------------------------------------------------------------------------
N1_TEMPLATES = ["R$ {t}.{h},{f}", "{i},{f}", "{i}.{f}", "  {i}  ", "1,{h},{h}", "{i}e3", "abc", None,
                "-{i}.{f}", "USD {i}", "", "1.{h}", "{t},{h}.{f}", ".{f}", "{i}.", "--{i}"]
N1_SQL = f"""(case when {W} <> '' and regexp_matches(
  (case when contains(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), ',') and contains(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), '.')
        then replace(replace(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), '.', ''), ',', '.')
        when contains(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), ',') then replace(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), ',', '.')
        else regexp_replace({W}, '[^0-9.,\\-]+', '', 'g') end), '^-?(\\d+\\.?\\d*|\\.\\d+)$')
  then try_cast((case when contains(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), ',') and contains(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), '.')
        then replace(replace(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), '.', ''), ',', '.')
        when contains(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), ',') then replace(regexp_replace({W}, '[^0-9.,\\-]+', '', 'g'), ',', '.')
        else regexp_replace({W}, '[^0-9.,\\-]+', '', 'g') end) as double) end)"""
_customer_query("n01_to_number_loose", N1_TEMPLATES, P.to_number_loose, N1_SQL)

# N2 -------------------------------------------------------------------------
_customer_query("n02_to_numeric_fixed", N1_TEMPLATES + ["{i}.{f}5", "0.125", "-0.125"],
                lambda c: P.to_numeric_fixed(c, 2),
                f"cast(cast(floor({N1_SQL} * 100 + 0.5) / 100 as decimal(38,2)) as varchar)", salt=1)

# N3 -------------------------------------------------------------------------
INT_TEMPLATES = ["{i}", " {i}.{f} ", "-{i}.9", "{i}e2", "0x1F", "abc", "", None, "+{i}", "Infinity",
                 ".5", "1,5", "{z}"]
N3_SQL = f"(case when {W} <> '' then cast(trunc({fin(jsn('raw'))}) as bigint) end)"
_customer_query("n03_to_int_loose", INT_TEMPLATES, P.to_int_loose, N3_SQL)

# N4 -------------------------------------------------------------------------
_customer_query("n04_order_code_string", ["{z}", "0", "PED-{k}", " {k} ", "", None, "{i}.{f}", "abc", "-{z}"],
                P.order_code_string,
                f"(case when {N3_SQL} is not null and {N3_SQL} <> 0 then cast({N3_SQL} as varchar) "
                f"when {W} <> '' then {W} end)")

# N5 -------------------------------------------------------------------------
_customer_query("n05_to_bool_loose",
                ["true", "1", "Ativo", "sim", " S ", "FALSE", "0", "inativo", "não", "n", "maybe", "", None,
                 "ACTIVE", "inactive", "Nao"],
                P.to_bool_loose,
                f"(case when upper({W}) in ('TRUE','1','ACTIVE','ATIVO','SIM','S') then true "
                f"when upper({W}) in ('FALSE','0','INACTIVE','INATIVO','NAO','NÃO','N') then false end)")

# N6 -------------------------------------------------------------------------
FLAG_TEMPLATES = [None, "", " ", "0", "1", "0.0", "2", "false", "N", "no", "inactive", "Deleted", "excluído",
                  "excluido", "yes", "abc", "1e0", "0x0", "true", "S", "sim", "Bonificação", "bonificacao",
                  "bonus", "b", "nao", "{i}"]
_customer_query("n06_order_active_flag", FLAG_TEMPLATES, P.order_active_flag,
                f"(case when raw is null then 1 when {jsn('raw')} = 0 then 0 when {jsn('raw')} = 1 then 1 "
                f"when lower({W}) = '' then 1 "
                f"when lower({W}) in ('0','false','n','no','inactive','deleted','excluido','excluído') then 0 "
                f"else 1 end)")

# N7 -------------------------------------------------------------------------
_customer_query("n07_bonus_flag", FLAG_TEMPLATES, P.bonus_flag,
                f"(case when raw is null or raw = '' then 0 when {jsn('raw')} = 0 then 0 "
                f"when {jsn('raw')} = 1 then 1 "
                f"when lower({W}) in ('1','true','s','sim','bonificacao','bonificação','bonus','b') then 1 "
                f"else 0 end)", salt=3)

# N8 -------------------------------------------------------------------------
_customer_query("n08_bool_from_unknown",
                [None, "", "true", "T", "yes", "y", "sim", "false", "f", "no", "n", "nao", "não", "5", "0", "-1",
                 "abc", "0.5", " ", "{i}"],
                P.bool_from_unknown,
                f"(case when raw is null or lower({W}) = '' then null "
                f"when lower({W}) in ('true','t','yes','y','sim') then true "
                f"when lower({W}) in ('false','f','no','n','nao','não') then false "
                f"when {fin(jsn(f'lower({W})'))} is not null then {fin(jsn(f'lower({W})'))} > 0 end)")

# N9–N11 ----------------------------------------------------------------------
DATE_TEMPLATES = ["{y}-{m}-{d}", "{y}-{m}-{d}T{x}:{p}:00Z", "{d}/{m}/{y}", "", None, " {y}-{m}-{d} ",
                  "{y}{m}{d}", "{y}-{m}-{d}xyz", "{y}-{m}-{d} {x}:{p}:{p}", "{y}-{m}-{d}T{x}:{p}:{p}.123Z",
                  "{y}-{m}-{d}T{x}:{p}:{p}-03:00", "abc"]
N9_SQL = (f"(case when {W} <> '' and regexp_matches((case when length({W}) >= 10 then substr({W}, 1, 10) "
          f"else {W} end), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then substr({W}, 1, 10) end)")
_customer_query("n09_parse_ymd", DATE_TEMPLATES, D.parse_ymd, N9_SQL)

N10_TS = f"(case when {W} <> '' then try_cast({W} as timestamptz) end)"
_customer_query("n10_parse_timestamp", DATE_TEMPLATES,
                lambda c: F.date_format(D.parse_timestamp(c), "yyyy-MM-dd HH:mm:ss.SSS"),
                f"strftime({N10_TS}, '%Y-%m-%d %H:%M:%S.%g')")
_customer_query("n11_parse_date_only_loose", DATE_TEMPLATES, D.parse_date_only_loose,
                f"coalesce({N9_SQL}, strftime({N10_TS}, '%Y-%m-%d'))", salt=5)

# N12–N15 --------------------------------------------------------------------
_customer_query("n12_person_type", ["PF", "pj", " f ", "J", "x", "", None, "Pf", "fisica"], P.person_type,
                f"(case when upper({W}) in ('PF','PJ') then upper({W}) when upper({W}) = 'F' then 'PF' "
                f"when upper({W}) = 'J' then 'PJ' end)")
_customer_query("n13_gender",
                ["", "0", "f", "M", "b", "1", "2", "3", "Feminino", "masculino", "female", "MALE", "x", None, " m "],
                P.gender,
                f"(case when raw is null or {W} = '' or {W} = '0' then null "
                f"when upper({W}) in ('F','M','B') then upper({W}) when {W} = '1' then 'M' when {W} = '2' then 'F' "
                f"when {W} = '3' then 'B' when upper({W}) in ('FEMININO','FEMALE') then 'F' "
                f"when upper({W}) in ('MASCULINO','MALE') then 'M' end)")
N14_SQL = (f"(case when upper({W}) in ('ACTIVE','ATIVO','A','1') then 'ACTIVE' "
           f"when upper({W}) in ('INACTIVE','INATIVO','I','0') then 'INACTIVE' end)")
_customer_query("n14_active_status", ["ACTIVE", "inactive", "Ativo", "INATIVO", "a", "i", "1", "0", "x", "", None],
                lambda c: {"result": P.active_status(c), "active": P.active_boolean(c)},
                N14_SQL, extra_cols={"active": f"(case {N14_SQL} when 'ACTIVE' then true when 'INACTIVE' then false end)"})
_customer_query("n15_brazilian_state", [" sp ", "rj", "XX", "São Paulo", "", None, "mg", "Sp ", "{s}"],
                T.brazilian_state,
                f"(case when upper({W}) in ({', '.join(repr(u) for u in T.BR_UFS)}) then upper({W}) end)")

# N18 ------------------------------------------------------------------------
TAX = ["{z}.{h}.{h}-{f}", "{h}.{h}.{h}-{f}", "abc", "", None, "{f}", "{z}/{h}"]
DIG = "regexp_replace(raw, '\\D', '', 'g')"
_customer_query("n18_tax_id_digits", TAX,
                lambda c: {"result": T.tax_id_any(c), "min11": T.tax_id_min11(c),
                           "digits": T.tax_id_maybe_empty(c),
                           "with_fallback": T.synthetic_tax_id(T.tax_id_any(c), "CLI-", F.col("c_custkey"))},
                f"(case when {DIG} <> '' then {DIG} end)",
                extra_cols={"min11": f"(case when length({DIG}) >= 11 then {DIG} end)", "digits": DIG,
                            "with_fallback": f"coalesce((case when {DIG} <> '' then {DIG} end), "
                                             f"'CLI-' || cast(c_custkey as varchar))"})

# N19 ------------------------------------------------------------------------
PHONES = ["(0{f}) 9{h}{h}-{h}", "+55 ({f}) 9{h}{h}-{h}", "0055{f}3{h}{h}{f}", "{f}9{h}{h}{h}",
          "0 21 {f} 9{h}{h}{h}", "0 21 {f} 3{h}{h}{f}", "55 {f} {h}{h}", "", None, "abc", "{h}-{h}",
          "00{f}{h}{h}{f}", "000{f}9{h}{h}{h}"]
_D0 = f"regexp_replace({W}, '\\D+', '', 'g')"
_D1 = f"(case when starts_with({_D0}, '00') then substr({_D0}, 3) else {_D0} end)"
_R1 = f"(case when starts_with({_D1}, '55') then substr({_D1}, 3) else {_D1} end)"
_R2 = f"(case when length({_R1}) = 11 and starts_with({_R1}, '0') then substr({_R1}, 2) else {_R1} end)"
_R3 = f"(case when length({_R2}) > 11 and starts_with({_R2}, '0') then regexp_replace({_R2}, '^0+', '') else {_R2} end)"
_N9 = f"substr(right({_R3}, 11), 3, 9)"
_R4 = (f"(case when length({_R3}) > 11 and length({_N9}) = 9 and starts_with({_N9}, '9') then right({_R3}, 11) "
       f"when length({_R3}) > 11 then right({_R3}, 10) else {_R3} end)")
_customer_query("n19_br_phone_e164", PHONES, T.br_phone_e164,
                f"(case when {W} <> '' and {_D0} <> '' then '55' || {_R4} end)")

# N20 ------------------------------------------------------------------------
SR = "'^([^\\[\\]]+)\\[([^\\[\\]]+)\\]$'"
_customer_query("n20_split_store_reference", ["{k}[{i}]", "{k}", " {k} [ {i} ] ", "[{i}]", "", None, "{k}[]", "a[b]c"],
                lambda c: dict(zip(("result", "external_reference"), T.split_store_reference(c))),
                f"(case when {W} = '' then null when regexp_matches({W}, {SR}) then "
                f"nullif(trim(regexp_extract({W}, {SR}, 1)), '') else {W} end)",
                extra_cols={"external_reference": f"(case when regexp_matches({W}, {SR}) then "
                                                  f"nullif(trim(regexp_extract({W}, {SR}, 2)), '') end)"})

# N21 ------------------------------------------------------------------------
_PFX = "trim(regexp_extract(raw, '^([^\\-_]*)', 1))"
_customer_query("n21_partner_sku_prefix", ["{k}-{i}", "{k}_{i}", "{k}", "p{k}-1", "", None, " {k} -x", "-{k}"],
                T.partner_sku_prefix,
                f"(case when raw <> '' and regexp_matches({_PFX}, '^\\d+$') then {_PFX} end)")

# N22 ------------------------------------------------------------------------
_customer_query("n22_order_code_tail", ["tray-{k}", "{k}", "abc", "PED{k}  ", "", None, "{k}-x", " {k}a{i} "],
                T.order_code_tail,
                f"(case when {W} = '' then null when regexp_extract({W}, '(\\d+)\\s*$', 1) <> '' "
                f"then regexp_extract({W}, '(\\d+)\\s*$', 1) else {W} end)")

# N23, N24 -------------------------------------------------------------------
_LK = f"coalesce({W}, '')"
N23_SQL = f"(case when regexp_matches({_LK}, '^\\d+\\.0+$') then regexp_replace({_LK}, '\\.0+$', '') else {_LK} end)"
_customer_query("n23_lookup_key", ["{k}.0", "{k}.00", " {k} ", "{k}.5", None, "", "{z}", "{z}.000"],
                T.lookup_key, N23_SQL)
_NZ = f"(case when regexp_replace({W}, '^0+', '') = '' then '0' else regexp_replace({W}, '^0+', '') end)"
_customer_query("n24_internal_code_variants", ["{z}", "{k}", "000", "", None, "A{z}", " {z} "],
                T.internal_code_variants,
                f"(case when raw is null or {W} = '' then []::varchar[] when {W} = {_NZ} then [{W}] "
                f"else [{W}, {_NZ}] end)")

# N25 ------------------------------------------------------------------------
_customer_query("n25_category_key",
                ["Eletrônicos & Acessórios", "  Ação--Aventura ", "CAMA, MESA e BANHO", "{s} / {n}", "", None,
                 "Çà é", "Pão_de_Açúcar 2", "škoda ŽÅ", "cafe\u0301s a\u0303o", "Ệ-ŵ Ǻ"],
                T.category_key,
                f"trim(regexp_replace(regexp_replace(strip_accents(lower({ws("coalesce(raw, '')")})), '[\u0300-\u036f]', '', 'g'), "
                f"'[^a-z0-9]+', ' ', 'g'))")

# N27 ------------------------------------------------------------------------
_SO = "'^(\\d{4}-\\d{2}-\\d{2})\\s+(\\d{2}:\\d{2}:\\d{2})([+-])(\\d{2})(?::(\\d{2}))?$'"
_SO_ISO = (f"(regexp_extract({W}, {_SO}, 1) || 'T' || regexp_extract({W}, {_SO}, 2) || regexp_extract({W}, {_SO}, 3) "
           f"|| regexp_extract({W}, {_SO}, 4) || ':' || (case when regexp_extract({W}, {_SO}, 5) = '' then '00' "
           f"else regexp_extract({W}, {_SO}, 5) end))")
_customer_query("n27_short_offset_timestamp",
                ["{y}-{m}-{d} {x}:{p}:{p}-03", "{y}-{m}-{d} {x}:{p}:{p}+05:30", "{y}-{m}-{d} {x}:{p}:{p}", "abc", "",
                 None, "{y}-{m}-{d}  {x}:{p}:{p}+01"],
                lambda c: F.date_format(D.short_offset_timestamp(c), "yyyy-MM-dd HH:mm:ss"),
                f"strftime((case when regexp_matches({W}, {_SO}) then try_cast({_SO_ISO} as timestamptz) "
                f"when regexp_replace({W}, '^([^ ]*) ', '\\1T') <> '' then try_cast(regexp_replace({W}, '^([^ ]*) ', '\\1T') as timestamptz) end), "
                f"'%Y-%m-%d %H:%M:%S')")

# N30 ------------------------------------------------------------------------
_ZP = f"(case when length({W}) >= 10 then substr({W}, 1, 10) else {W} end)"
_customer_query("n30_zero_date_repair",
                ["0000-00-00", "0000-{m}-{d}", "{y}-{m}-{d}", "{y}-13-{d}", "{y}-{m}-32", "{y}-{m}-{d} 10:00:00",
                 "", None, "0000-00-00 00:00:00", "{y}-00-{d}"],
                lambda c: D.zero_date_repair(c, 2026),
                f"(case when {W} <> '' and {W} not in ('0000-00-00', '0000-00-00 00:00:00') "
                f"and regexp_matches({_ZP}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') "
                f"and try_cast(substr({_ZP}, 6, 2) as int) between 1 and 12 "
                f"and try_cast(substr({_ZP}, 9, 2) as int) between 1 and 31 "
                f"then (case when substr({_ZP}, 1, 4) = '0000' then '2026' || substr({_ZP}, 5, 6) else {_ZP} end) end)")

# N31 ------------------------------------------------------------------------
_OR = "regexp_extract(raw, 'Origem:\\s*(.+)', 1)"
_OK = f"(len(string_split(raw, ' - ')) >= 2 and {_OR} <> '')"
_customer_query("n31_carrier_subsidiary",
                ["Logística do vendedor - {s} Express - Normal - Origem: Fortaleza-CE", "{s}", "A - {n}",
                 "x - y - Origem:   Rio ", "", None, "{n} - Origem: {s}"],
                lambda c: dict(zip(("result", "subsidiary"), T.carrier_and_subsidiary(c))),
                f"(case when raw is null or raw = '' then null when {_OK} then trim(string_split(raw, ' - ')[2]) "
                f"else raw end)",
                extra_cols={"subsidiary": f"(case when {_OK} and raw <> '' then trim({_OR}) end)"})

# N36, N40, N42 --------------------------------------------------------------
_customer_query("n36_grams_to_kg", ["{i}", "{i}.{f}", "", None, "abc", " {h} ", "-{i}", "{i}e2", "{i}."], P.grams_to_kg,
                f"(case when regexp_matches({W}, '^\\d+(\\.\\d+)?$') then cast({W} as double) / 1000 end)")
_LEAD = f"regexp_extract({W}, '^([+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?)', 1)"
_customer_query("n40_money_2", ["{i}.{f}5", "{i}.{f}", "abc", "", None, "{i}abc", " .{f}5", "-{i}.{f}5", "1e2"],
                P.money_2,
                f"floor(coalesce({fin(f'(case when {_LEAD} <> {chr(39)}{chr(39)} then try_cast({_LEAD} as double) end)')}, 0.0) * 100 + 0.5) / 100")


@query("n42_installments", oracle="""
select o_orderkey, case when o_orderkey % 5 = 0 then null else (o_orderkey % 7) - 2 + o_totalprice / 1e6 end as raw,
  case when o_orderkey % 5 = 0 then 1 else greatest(1, cast(floor((o_orderkey % 7) - 2 + o_totalprice / 1e6) as bigint)) end as result
from orders
""")
def n42_installments(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("double")).otherwise(
        (F.col("o_orderkey") % 7) - 2 + F.col("o_totalprice") / 1e6)
    return o.select("o_orderkey", raw.alias("raw"), P.installments(raw).alias("result"))


# N39, N43 -------------------------------------------------------------------
_customer_query("n43_alias_list",
                ['["A{k}", " B{k} ", ""]', "{k}", "", None, '["x"', "123", '"abc"', "[]", '[" ", null, "Z"]'],
                T.alias_list,
                f"(case when raw is null or {W} = '' then []::varchar[] "
                f"when starts_with({W}, '[') and json_valid({W}) then "
                f"list_filter(list_transform(cast(json_extract({W}, '$[*]') as json[]), "
                f"lambda x: coalesce({ws("(x->>'$')")}, '')), lambda x: x <> '') "
                f"when regexp_matches({W}, '^-?(0|[1-9]\\d*)(\\.\\d+)?([eE][+-]?\\d+)?$') "
                f"or {W} in ('true', 'false', 'null') or regexp_matches({W}, '^\"([^\"\\\\]|\\\\.)*\"$') "
                f"then []::varchar[] else [{W}] end)")


@query("n39_join_non_blank", oracle="""
select c_custkey, nullif(concat_ws(' · ',
   nullif(trim(c_mktsegment), ''),
   nullif(trim(case when c_custkey % 3 = 0 then ' ' else c_name end), ''),
   nullif(trim(case when c_custkey % 4 = 0 then null else cast(c_nationkey as varchar) end), '')), '') as result
from customer
""")
def n39_join_non_blank(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", T.join_non_blank(
        F.col("c_mktsegment"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(" ")).otherwise(F.col("c_name")),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("c_nationkey").cast("string")),
    ).alias("result"))


# N26 on events (2024: plain −3 h), N28, N29, N35 -----------------------------

@query("n26_brazil_date_time", oracle="""
select event_id, strftime(timezone('America/Sao_Paulo', timezone('UTC', ts)), '%Y-%m-%d') as date,
       strftime(timezone('America/Sao_Paulo', timezone('UTC', ts)), '%H:%M:%S') as time
from events
""")
def n26_brazil_date_time(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", D.brazil_date(F.col("ts")).alias("date"), D.brazil_time(F.col("ts")).alias("time"))


_TIME_OPTS = ["{x}:{p}", "{x}:{p}:{p}", "bad", None, "25:00:00", "{x}:{p}:61"]


def _ev_time_raw():
    """A time text per event built from its own timestamp."""
    hh = F.lpad(F.hour("ts").cast("string"), 2, "0")
    mi = F.lpad(F.minute("ts").cast("string"), 2, "0")
    k = F.col("event_id") % 6
    return (F.when(k == 0, F.concat(hh, F.lit(":"), mi))
            .when(k == 1, F.concat(hh, F.lit(":"), mi, F.lit(":"), mi))
            .when(k == 2, F.lit("bad")).when(k == 3, F.lit(None).cast("string"))
            .when(k == 4, F.lit("25:00:00")).otherwise(F.concat(hh, F.lit(":"), mi, F.lit(":61"))))


_EV_TIME_SQL = """(case event_id % 6 when 0 then lpad(cast(hour(ts) as varchar), 2, '0') || ':' || lpad(cast(minute(ts) as varchar), 2, '0')
 when 1 then lpad(cast(hour(ts) as varchar), 2, '0') || ':' || lpad(cast(minute(ts) as varchar), 2, '0') || ':' || lpad(cast(minute(ts) as varchar), 2, '0')
 when 2 then 'bad' when 3 then null when 4 then '25:00:00'
 else lpad(cast(hour(ts) as varchar), 2, '0') || ':' || lpad(cast(minute(ts) as varchar), 2, '0') || ':61' end)"""


@query("n28_local_datetime_offset", oracle=f"""
select event_id, d, t,
  strftime(try_cast(d || 'T' || (case when length(tt) = 5 then tt || ':00' else tt end) || '-03:00' as timestamptz),
           '%Y-%m-%d %H:%M:%S') as result
from (select event_id, strftime(ts, '%Y-%m-%d') as d, {_EV_TIME_SQL} as t,
             (case when regexp_matches(coalesce({_EV_TIME_SQL}, ''), '^\\d{{2}}:\\d{{2}}(:\\d{{2}})?$') then {_EV_TIME_SQL}
                   else '00:00:00' end) as tt from events) x
""")
def n28_local_datetime_offset(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    x = e.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), _ev_time_raw().alias("t"))
    return x.select("event_id", "d", "t", F.date_format(D.local_datetime_fixed_offset(F.col("d"), F.col("t")),
                                                        "yyyy-MM-dd HH:mm:ss").alias("result"))


@query("n29_date_hour_rules", oracle=f"""
select event_id, d, t,
  strftime(timezone('America/Sao_Paulo', try_cast(d || ' ' || (case when regexp_matches(coalesce(t, ''), '^([01]\\d|2[0-3]):[0-5]\\d:[0-5]\\d$') then t else '00:00:00' end) as timestamp)), '%Y-%m-%d %H:%M:%S') as lenient,
  strftime(case when regexp_matches(coalesce(t, ''), '^([01]\\d|2[0-3]):[0-5]\\d:[0-5]\\d$')
    then timezone('America/Sao_Paulo', try_cast(d || ' ' || t as timestamp)) end, '%Y-%m-%d %H:%M:%S') as strict
from (select event_id, strftime(ts, '%Y-%m-%d') as d, {_EV_TIME_SQL} as t from events) x
""")
def n29_date_hour_rules(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    x = e.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("d"), _ev_time_raw().alias("t"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return x.select("event_id", "d", "t",
                    F.date_format(D.date_hour_lenient(F.col("d"), F.col("t")), fmt).alias("lenient"),
                    F.date_format(D.date_hour_strict(F.col("d"), F.col("t")), fmt).alias("strict"))


@query("n35_day_differences", oracle="""
select l_orderkey, l_linenumber, s, e,
  cast(datediff('day', cast(s as date), cast(e as date)) as integer) as days,
  cast(case when datediff('day', cast(s as date), cast(e as date)) >= 0 then datediff('day', cast(s as date), cast(e as date)) end as integer) as days_non_negative
from (select l_orderkey, l_linenumber, strftime(o_orderdate, '%Y-%m-%d') as s, strftime(l_shipdate, '%Y-%m-%d') as e,
      from lineitem join orders on l_orderkey = o_orderkey) x
""")
def n35_day_differences(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    x = j.select("l_orderkey", "l_linenumber", F.date_format("o_orderdate", "yyyy-MM-dd").alias("s"),
                 F.date_format("l_shipdate", "yyyy-MM-dd").alias("e"))
    return x.select("l_orderkey", "l_linenumber", "s", "e",
                    D.days_between(F.col("s"), F.col("e")).alias("days"),
                    D.days_between_non_negative(F.col("s"), F.col("e")).alias("days_non_negative"))


@query("n38_unit_price_fallback", oracle="""
select l_orderkey, l_linenumber,
  coalesce(case when l_linenumber = 3 then null else l_extendedprice / l_quantity end,
           case when l_quantity = 0 then null else l_extendedprice / l_quantity end) as unit_price
from lineitem
""")
def n38_unit_price_fallback(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    unit = F.when(F.col("l_linenumber") == 3, F.lit(None).cast("double")).otherwise(
        F.col("l_extendedprice") / F.col("l_quantity"))
    return li.select("l_orderkey", "l_linenumber",
                     P.unit_price(unit, F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"))
