"""Loose parsers for numbers, flags and codes.

All are Column → Column expressions built from Spark built-ins (they stay
inside whole-stage codegen; no Python runs per row). Inputs are strings
as they arrive from partner payloads and client databases.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal literal as accepted by a JavaScript ``Number(...)`` call.
DECIMAL_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
HEX_RE = r"^0[xX][0-9a-fA-F]+$"


# Characters a JavaScript ``trim()`` removes (the ASCII ones plus NBSP, BOM
# and the Unicode line/paragraph separators).
WHITESPACE = " \t\n\r\x0b\x0c\u00a0\ufeff\u2028\u2029"


def ws_trim(c: Column) -> Column:
    """Trim all leading/trailing whitespace (tabs, newlines too) — a
    character-set trim, no regular expression."""
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    t = ws_trim(c)
    return F.when(t != "", t)


# A JavaScript ``Number(...)`` literal: decimal with optional exponent, or ±Infinity.
JS_NUMBER_RE = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|Infinity)$"


def js_number(c: Column) -> Column:
    """Number(text): blank → 0, decimal/exponent/hex literals, ±Infinity;
    anything else (NaN in JS) → null. Each helper here references its input
    a small, fixed number of times, so composing them keeps expressions
    small enough for whole-stage code generation."""
    s = ws_trim(c)
    return F.coalesce(
        F.when(s == "", F.lit(0.0)),
        F.when(s.rlike(JS_NUMBER_RE), s.try_cast("double")),
        F.when(s.rlike(HEX_RE), F.conv(F.substring(s, 3, 64), 16, 10).try_cast("double")))


def finite(d: Column) -> Column:
    """NaN and ±Infinity → null."""
    return F.when(F.abs(d) != F.lit(float("inf")), F.nanvl(d, F.lit(None).cast("double")))


def to_number_loose(c: Column) -> Column:
    """Keep only digits . , - ; with both separators dots are thousands and
    the comma is decimal; with commas only every comma becomes a dot. A result
    that is not a plain decimal literal is null ("1e3" → 13 since the e goes)."""
    s = F.regexp_replace(F.nullif(ws_trim(c), F.lit("")), r"[^0-9.,\-]+", "")
    # any comma: commas become dots and dots (thousands) go — one translate
    s = F.when(F.instr(s, ",") > 0, F.translate(s, ",.", ".")).otherwise(s)
    return F.when(s.rlike(r"^-?(\d+\.?\d*|\.\d+)$"), s.try_cast("double"))


def half_up(x: Column, scale: int) -> Column:
    """Round half toward +infinity at ``scale`` decimals (JS Math.round).
    From 2**53 on a scaled double has no fraction left and stays as it is."""
    p = 10 ** max(0, min(8, int(scale)))
    return F.when(F.abs(x * p) >= float(1 << 53), x).otherwise(F.floor(x * p + 0.5) / p)


def to_numeric_fixed(c: Column, scale: int) -> Column:
    """N1, rounded half-up at ``scale`` (≤ 8), as fixed-point text."""
    n = to_number_loose(c)
    return half_up(n, scale).cast(f"decimal(38,{int(scale)})").cast("string")


def to_int_loose(c: Column) -> Column:
    """Number(trimmed text) truncated toward zero; blank → null
    (non-finite values do not fit a bigint and become null)."""
    return js_number(F.nullif(ws_trim(c), F.lit(""))).try_cast("bigint")


def order_code_string(c: Column) -> Column:
    """Non-zero integer form, else the trimmed text, else null."""
    return F.coalesce(F.nullif(to_int_loose(c), F.lit(0)).cast("string"), F.nullif(ws_trim(c), F.lit("")))


def to_bool_loose(c: Column) -> Column:
    """N5."""
    s = F.upper(ws_trim(c))
    return (F.when(s.isin("TRUE", "1", "ACTIVE", "ATIVO", "SIM", "S"), F.lit(True))
            .when(s.isin("FALSE", "0", "INACTIVE", "INATIVO", "NAO", "NÃO", "N"), F.lit(False)))


def order_active_flag(c: Column) -> Column:
    """Null → 1; numeric 0/1 (blank counts as 0); then words → 0; else 1."""
    n = js_number(c)
    s = F.lower(ws_trim(c))
    return (F.when(c.isNull(), F.lit(1))
            .when(n == 0, F.lit(0))
            .when(n == 1, F.lit(1))
            .when(s == "", F.lit(1))
            .when(s.isin("0", "false", "n", "no", "inactive", "deleted", "excluido", "excluído"), F.lit(0))
            .otherwise(F.lit(1)))


def bonus_flag(c: Column) -> Column:
    """Default 0; 1/true/s/sim/bonificacao/bonificação/bonus/b → 1."""
    n = js_number(c)
    s = F.lower(ws_trim(c))
    return (F.when(c.isNull() | (c.cast("string") == ""), F.lit(0))
            .when(n == 0, F.lit(0))
            .when(n == 1, F.lit(1))
            .when(s.isin("1", "true", "s", "sim", "bonificacao", "bonificação", "bonus", "b"), F.lit(1))
            .otherwise(F.lit(0)))


def bool_from_unknown(c: Column) -> Column:
    """yes/no words (pt and en), else a number > 0, else null."""
    s = F.lower(ws_trim(c))
    n = finite(js_number(s))
    return (F.when(c.isNull() | (s == ""), F.lit(None).cast("boolean"))
            .when(s.isin("true", "t", "yes", "y", "sim"), F.lit(True))
            .when(s.isin("false", "f", "no", "n", "nao", "não"), F.lit(False))
            .when(n.isNotNull(), n > 0))


def person_type(c: Column) -> Column:
    """PF/PJ, F → PF, J → PJ (case-insensitive)."""
    s = F.upper(ws_trim(c))
    return F.when(s.isin("PF", "PJ"), s).when(s == "F", F.lit("PF")).when(s == "J", F.lit("PJ"))


def gender(c: Column) -> Column:
    """blank/0 → null; F/M/B; 1 → M, 2 → F, 3 → B; pt/en words."""
    raw = ws_trim(c)
    s = F.upper(raw)
    return (F.when(raw.isNull() | (raw == "") | (raw == "0"), F.lit(None).cast("string"))
            .when(s.isin("F", "M", "B"), s)
            .when(raw == "1", F.lit("M")).when(raw == "2", F.lit("F")).when(raw == "3", F.lit("B"))
            .when(s.isin("FEMININO", "FEMALE"), F.lit("F"))
            .when(s.isin("MASCULINO", "MALE"), F.lit("M")))


def active_status(c: Column) -> Column:
    """ACTIVE/INACTIVE from ACTIVE, ATIVO, A, 1 / INACTIVE, INATIVO, I, 0."""
    s = F.upper(ws_trim(c))
    return (F.when(s.isin("ACTIVE", "ATIVO", "A", "1"), F.lit("ACTIVE"))
            .when(s.isin("INACTIVE", "INATIVO", "I", "0"), F.lit("INACTIVE")))


def active_boolean(c: Column) -> Column:
    st = active_status(c)
    return F.when(st == "ACTIVE", F.lit(True)).when(st == "INACTIVE", F.lit(False))


def money_2(c: Column) -> Column:
    """parseFloat-style leading number, rounded half-up to 2 places;
    unparsable → 0."""
    lead = F.regexp_extract(ws_trim(c), r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)", 1)
    n = F.coalesce(finite(F.when(lead != "", lead.try_cast("double"))), F.lit(0.0))
    return half_up(n, 2)


def unit_price(unit: Column, total: Column, quantity: Column) -> Column:
    """The unit price, else total ÷ quantity (null for a quantity of 0)."""
    return F.coalesce(unit, F.try_divide(total, F.when(quantity != 0, quantity)))


def installments(c: Column) -> Column:
    """Default 1, floor, at least 1."""
    n = finite(F.when(ws_trim(c.cast("string")) != "", c.cast("string").try_cast("double")))
    return F.coalesce(F.greatest(F.lit(1), F.floor(n).cast("bigint")), F.lit(1))


def grams_to_kg(c: Column) -> Column:
    """Trimmed text that is a plain unsigned decimal (``123`` or
    ``123.45``) ÷ 1000; anything else (blank, signs, exponents) → null."""
    s = ws_trim(c)
    return F.when(s.rlike(r"^\d+(\.\d+)?$"), s.try_cast("double") / 1000)
