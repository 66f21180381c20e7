"""Edge cases of the scalar normalisers and treatments, taken from the
semantics column of SURVEY §2.3 / §2.2."""

import math

import pytest
from pyspark.sql import functions as F

from cargolens.functions import dates as D
from cargolens.functions import mapping as mp
from cargolens.functions import parse as P
from cargolens.functions import text as T
from cargolens.functions.freight_labels import deadline_bucket, freight_range
from cargolens.sources.payload import repair_json_text


def apply(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_to_number_loose_quirks(spark):
    vals = ["1e3", "1,234.56", "1,234,567", "1.234", "R$ 1.234,56", " 12,5 ", "abc", "", None, "-3", "--3"]
    out = apply(spark, P.to_number_loose, vals)
    assert out == [13.0, 1.23456, None, 1.234, 1234.56, 12.5, None, None, None, -3.0, None]


def test_to_int_and_order_code(spark):
    assert apply(spark, P.to_int_loose, ["12.7", "-12.7", " 007 ", "", "x", "1e2", "0x1F"]) == [12, -12, 7, None, None, 100, 31]
    assert apply(spark, P.order_code_string, ["007", "0", "PED-1", "  ", None]) == ["7", "0", "PED-1", None, None]


def test_flags(spark):
    assert apply(spark, P.to_bool_loose, ["sim", "NÃO", "Ativo", "2", None]) == [True, False, True, None, None]
    # blank counts as 0 for the active flag (numeric test first)
    assert apply(spark, P.order_active_flag, [None, "", "1", "excluído", "yes"]) == [1, 0, 1, 0, 1]
    assert apply(spark, P.bonus_flag, [None, "", "Bonificação", "b", "x"]) == [0, 0, 1, 1, 0]
    assert apply(spark, P.bool_from_unknown, ["Y", "não", "0.5", "-1", "?"]) == [True, False, True, False, None]


def test_money_and_rounding(spark):
    # half toward +infinity, as Math.round
    assert apply(spark, P.money_2, ["2.345", "-2.345", "abc", "1.005"]) == [2.35, -2.35, 0.0, 1.0]


def test_freight_labels(spark):
    vals = [None, 0.0, -5.0, 100.0, 100.01, 10000.0, 10000.5]
    out = apply(spark, freight_range, vals, "double")
    assert out[0] is None and out[1] == "R$0,00 (FREE)"
    assert out[2] == out[3] == "entre R$ 0,01 e R$ 100,00"
    assert out[4] == "entre R$ 100,01 e R$ 200,00" and out[6] == "acima de R$ 10.000,00"
    assert apply(spark, deadline_bucket, [None, -1, 5, 6, 45, 46, 60, 61], "int") == \
        [None, ">0", ">0", ">5", ">40", ">45", ">45", ">60"]


def test_text_normalisers(spark):
    assert apply(spark, T.brazilian_state, [" sp ", "XX"]) == ["SP", None]
    assert apply(spark, T.br_phone_e164, ["(088) 99999-8888", "+55 21 3333-4444", "0055 11 98888-7777"]) == \
        ["5588999998888", "552133334444", "5511988887777"]
    assert apply(spark, T.lookup_key, ["12.0", " 7 ", "1.5"]) == ["12", "7", "1.5"]
    assert apply(spark, T.internal_code_variants, ["00012", "000", ""]) == [["00012", "12"], ["000", "0"], []]
    assert apply(spark, T.category_key, ["Eletrônicos & Acessórios"]) == ["eletronicos acessorios"]
    assert apply(spark, T.order_code_tail, ["tray-58905", "abc"]) == ["58905", "abc"]
    assert apply(spark, T.partner_sku_prefix, ["253-1657", "371_1449", "p12-3"]) == ["253", "371", None]
    assert apply(spark, T.alias_list, ['["a", " b ", ""]', "x", "123", ""]) == [["a", "b"], ["x"], [], []]


def test_dates(spark):
    assert apply(spark, D.parse_ymd, ["2024-01-05T10:00:00Z", "05/01/2024"]) == ["2024-01-05", None]
    assert apply(spark, lambda c: D.zero_date_repair(c, 2026), ["0000-00-00", "0000-03-04", "2024-13-01"]) == \
        [None, "2026-03-04", None]
    out = apply(spark, lambda c: F.date_format(D.short_offset_timestamp(c), "yyyy-MM-dd HH:mm:ss"),
                ["2026-03-19 07:58:27-03"])
    assert out == ["2026-03-19 10:58:27"]
    # 02:00 UTC is the previous day in Sao Paulo
    assert apply(spark, D.brazil_date, ["2024-01-05 02:00:00"]) == ["2024-01-04"]


def test_json_repair(spark):
    raw = "﻿x__int(3)\n{'a': 1}" .replace("'", '"') + ""
    out = apply(spark, repair_json_text, [raw, 'total {"v": float( 1.5 ), "n": None, "t": True}'])
    assert out[0] == '{"a": 1}'
    assert out[1] == '{"v": 1.5, "n": null, "t": true}'


def test_formula(spark):
    df = spark.createDataFrame([(10.0, "4"), (3.0, "0"), (None, "1")], "a double, b string")
    cols = dict(df.dtypes)
    f = {
        "x": mp.compile_formula("{a} * 2 + {b}", cols),
        "y": mp.compile_formula("{a} / {b}", cols),
        "z": mp.compile_formula("-({a} - 1,5)", cols),
        "s": mp.compile_formula("-({a} - 1,5)", cols, strict_compat=True),
        "bad": mp.compile_formula("{a} ** 2", cols),
        "inj": mp.compile_formula("{a}; drop table x", cols),
    }
    rows = df.select(*[v.alias(k) for k, v in f.items()]).collect()
    assert [r["x"] for r in rows] == [24.0, 6.0, None]
    assert [r["y"] for r in rows] == [2.5, None, None]
    assert [r["z"] for r in rows] == [-8.5, -1.5, None]
    assert all(r["s"] is None and r["bad"] is None and r["inj"] is None for r in rows)


def test_where_clauses(spark):
    df = spark.createDataFrame([(1, "A"), (2, None), (3, "B")], "k int, s string")
    w = mp.compile_where([{"field": "s", "operator": "=", "value": None}])
    assert [r.k for r in df.where(w).collect()] == [2]
    w = mp.compile_where([{"field": "k", "operator": ">", "value": None}, {"field": "s", "operator": "<>", "value": None}])
    assert sorted(r.k for r in df.where(w).collect()) == [1, 3]
    w = mp.compile_where([{"field": "k", "operator": "~", "value": 3}])
    assert [r.k for r in df.where(w).collect()] == [3]


def test_map_values_and_regex(spark):
    df = spark.createDataFrame([("A",), (None,), ("Z",)], "v string")
    cols = {"v": "string"}
    m = mp.compile_field({"field": "v", "tratamento": "mapear_valores", "options": {"A": "x", "": "blank"}}, cols)
    assert [r[0] for r in df.select(m).collect()] == ["x", "blank", "Z"]
    r = mp.compile_field({"field": "v", "tratamento": "limpeza_regex",
                          "options": {"regex": "[AZ]", "map": {"A": "1"}}}, cols, spark)
    assert [x[0] for x in df.select(r).collect()] == ["1", None, "Z"]


@pytest.mark.parametrize("v,expected", [(0.5, 1), (1.5, 2), (-0.5, 0), (2.4999, 2)])
def test_round_days_half_up(spark, v, expected):
    df = spark.createDataFrame([(v,)], "d double").select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("s"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("d") * 86400)).alias("e"))
    assert df.select(D.round_days(F.col("s"), F.col("e"))).first()[0] == expected
    assert not math.isnan(expected)


def test_installments(spark):
    assert apply(spark, P.installments, ["3.7", "0", "", None, "abc", "NaN", "-2"]) == [3, 1, 1, 1, 1, 1, 1]
