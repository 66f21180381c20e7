"""Text normalisers (N15, N18–N25, N31, N39, N41, N43) as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargolens.functions.parse import ws_trim

# The 27 Brazilian state codes.
BR_UFS = ["AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
          "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO"]


def _plain_letters() -> tuple[str, str]:
    """Lower-case letters that decompose into an ASCII letter and marks, and
    those letters (Latin blocks of the Unicode tables)."""
    found = {}
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(point))[0]
        if base != chr(point) and base.isascii() and base.islower():
            found[chr(point)] = base
    return "".join(found), "".join(found.values())


MARKED_LETTERS, PLAIN_LETTERS = _plain_letters()
#: combining marks, and the spacing ones that count as diacritics
MARKS = r"[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+|[\^`\u00a8\u00af\u00b4\u00b7\u00b8]"


def brazilian_state(c: Column) -> Column:
    """Trim + upper, kept only when it is one of the 27 codes."""
    s = F.upper(ws_trim(c))
    return F.when(s.isin(BR_UFS), s)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"\D", "")


def tax_id_any(c: Column) -> Column:
    """N18 (marketplace): the digits, null when there are none."""
    d = digits_only(c)
    return F.when(d != "", d)


def tax_id_min11(c: Column) -> Column:
    """N18 (ERP-like partner): the digits when there are at least 11."""
    d = digits_only(c)
    return F.when(F.length(d) >= 11, d)


def tax_id_maybe_empty(c: Column) -> Column:
    """N18 (store partner): the digits, possibly empty."""
    return digits_only(c)


def synthetic_tax_id(c: Column, prefix: str, fallback_id: Column) -> Column:
    """The tax id, else ``prefix + id``."""
    return F.coalesce(c, F.concat(F.lit(prefix), fallback_id.cast("string")))


def br_phone_e164(c: Column) -> Column:
    """Brazilian phone → 55 + area code + number (digits only).

    Drop a leading 00; a leading 55 is the country code (so a number without
    country code in area 55 loses its area code, as in the source system);
    strip a stray 0 before the area code; with more than 11 digits keep the
    last 11 when they end in a 9-digit mobile number, else the last 10.
    """
    raw = ws_trim(c)
    digits = F.regexp_replace(raw, r"\D+", "")
    rest = F.regexp_replace(digits, r"^00", "")
    rest = F.regexp_replace(rest, r"^55", "")
    rest = F.regexp_replace(rest, r"^0(\d{10})$", "$1")          # stray 0 before the area code
    rest = F.regexp_replace(rest, r"^(?=\d{12,}$)0+", "")        # long number: drop leading zeros
    rest = F.regexp_replace(rest, r"^\d+(\d\d9\d{8})$", "$1")     # > 11 digits: keep a mobile tail
    rest = F.regexp_replace(rest, r"^\d{2,}(\d{10})$", "$1")      # otherwise the last 10
    return F.when((raw != "") & (digits != ""), F.concat(F.lit("55"), rest))


def split_store_reference(c: Column) -> tuple[Column, Column]:
    """``45145[160151]`` → (``45145``, ``160151``); unmatched → (text, null)."""
    s = ws_trim(c)
    pat = r"^([^\[\]]+)\[([^\[\]]+)\]$"
    m = s.rlike(pat)
    a = F.trim(F.regexp_extract(s, pat, 1))
    b = F.trim(F.regexp_extract(s, pat, 2))
    store = F.when(s == "", F.lit(None).cast("string")).when(m, F.when(a != "", a)).otherwise(s)
    ext = F.when(m & (b != ""), b)
    return store, ext


def partner_sku_prefix(c: Column) -> Column:
    """Text before the first ``-``/``_`` (trimmed) when it is all digits."""
    p = F.trim(F.regexp_extract(c.cast("string"), r"^([^\-_]*)", 1))
    return F.when((c.cast("string") != "") & p.rlike(r"^\d+$"), p)


def order_code_tail(c: Column) -> Column:
    """Last run of digits (before trailing spaces), else the text."""
    v = ws_trim(c)
    m = F.regexp_extract(v, r"(\d+)\s*$", 1)
    return F.when(v == "", F.lit(None).cast("string")).when(m != "", m).otherwise(v)


def lookup_key(c: Column) -> Column:
    """Trimmed text; ``12.0`` / ``12.00`` → ``12``; null → ''."""
    s = F.coalesce(ws_trim(c), F.lit(""))
    return F.when(s.rlike(r"^\d+\.0+$"), F.regexp_replace(s, r"\.0+$", "")).otherwise(s)


def strip_leading_zeros(c: Column) -> Column:
    z = F.regexp_replace(c, r"^0+", "")
    return F.when(z == "", F.lit("0")).otherwise(z)


def internal_code_variants(c: Column) -> Column:
    """{code, code without leading zeros (or '0')}; blank → empty array."""
    s = ws_trim(c)
    return F.when((s == "") | s.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.array(s, strip_leading_zeros(s))))


def category_key(c: Column) -> Column:
    """Lower, diacritics removed (composed letters and combining marks
    alike), every run of non-alphanumerics → one space."""
    s = F.lower(ws_trim(F.coalesce(c, F.lit(""))))
    s = F.regexp_replace(F.translate(s, MARKED_LETTERS, PLAIN_LETTERS), MARKS, "")
    s = F.regexp_replace(s, r"[^a-z0-9]+", " ")
    return F.trim(s)


def carrier_and_subsidiary(c: Column) -> tuple[Column, Column]:
    """``a - CARRIER - … - Origem: CITY`` → (CARRIER, CITY); else (text, null)."""
    s = c.cast("string")
    parts = F.split(s, " - ")
    origin = F.regexp_extract(s, r"Origem:\s*(.+)", 1)
    ok = (F.size(parts) >= 2) & (origin != "")
    carrier = F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).when(ok, F.trim(parts[1])).otherwise(s)
    sub = F.when(ok & (s != ""), F.trim(origin))
    return carrier, sub


def join_non_blank(*cols: Column, sep: str = " · ") -> Column:
    """Join the non-blank parts; nothing left → null."""
    parts = [F.when(ws_trim(x) != "", ws_trim(x)) for x in cols]
    j = F.concat_ws(sep, *parts)
    return F.when(j != "", j)


def alias_list(c: Column) -> Column:
    """A JSON text array → trimmed non-empty strings; a bare string →
    [string]; blank/null → []."""
    s = ws_trim(c)
    arr = F.from_json(s, "array<string>")
    arr = F.when(s.startswith("["), arr)
    cleaned = F.filter(F.transform(arr, lambda x: F.coalesce(ws_trim(x), F.lit(""))), lambda x: x != "")
    json_scalar = (s.rlike(r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$") | s.isin("true", "false", "null")
                   | s.rlike(r'^"([^"\\]|\\.)*"$'))
    return (F.when(s.isNull() | (s == ""), F.array().cast("array<string>"))
            .when(arr.isNotNull(), cleaned)
            .when(json_scalar, F.array().cast("array<string>"))
            .otherwise(F.array(s)))
