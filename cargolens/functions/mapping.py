"""Configured projections ("treatments", P1–P11) compiled to Columns.

A mapping config (JSON) names, for every canonical field, a source column
or a treatment. ``compile_field`` turns one entry into a Spark Column on
the driver, once; rows are never touched by Python. ``compile_where``
does the same for the configured WHERE clauses, which then reach the
scan as pushed filters.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.dates import parse_timestamp, parse_ymd, round_days
from cargolens.functions.parse import to_number_loose

def _null() -> Column:
    return F.lit(None).cast("string")


def _has(columns: Iterable[str], name: str) -> bool:
    return bool(name) and name in set(columns)


def _col(columns: Iterable[str], name: str) -> Column:
    """``row[name] ?? null``: a missing column reads as null."""
    name = (name or "").strip()
    return F.col(f"`{name}`") if _has(columns, name) else _null()


def _text(c: Column) -> Column:
    return c.cast("string")


# --- P2 ------------------------------------------------------------------------

def map_values(raw: Column, options: Mapping) -> Column:
    """Exact-match map on the text value (null looks up ''); a mapped
    null is a hit; else the ``else`` entry; else the raw value."""
    opts = {str(k): v for k, v in (options or {}).items()}
    s = F.coalesce(_text(raw), F.lit(""))
    entries = {k: v for k, v in opts.items() if k != "else"}
    out = F.lit(opts["else"]).cast("string") if "else" in opts and opts["else"] is not None else (
        _null() if "else" in opts else _text(raw))
    for k, v in entries.items():
        out = F.when(s == F.lit(k), F.lit(None if v is None else str(v)).cast("string")).otherwise(out)
    return out


# --- P3 ------------------------------------------------------------------------

def _java_regex_ok(spark, pattern: str) -> bool:
    """Validate a configured pattern on the driver (Java syntax when the JVM
    is reachable, else Python's, which agrees on the common subset)."""
    jvm = getattr(spark, "_jvm", None) if spark is not None else None
    if jvm is not None:
        try:
            jvm.java.util.regex.Pattern.compile(pattern)
            return True
        except Exception:  # noqa: BLE001 — a PatternSyntaxException means "invalid"
            return False
    try:
        re.compile(pattern)
        return True
    except re.error:
        return False


def regex_clean(raw: Column, options: Mapping, spark=None) -> Column:
    """Every match replaced by ``map[match]`` when the map has it (a null
    value → ''), else kept. Flags default to ``g`` (all matches; without it
    only the first); ``i``, ``m``, ``s`` become inline flags. An empty or
    invalid pattern returns the text unchanged, and so does one that matches
    the empty string somewhere in the text; null stays null."""
    regex = str(options.get("regex") or "")
    flags = str(options.get("flags") if options.get("flags") is not None else "g")
    mp = options.get("map") if isinstance(options.get("map"), Mapping) else {}
    s = _text(raw)
    if not regex:
        return s
    inline = "".join(f for f in "ims" if f in flags)
    pattern = (f"(?{inline})" if inline else "") + regex
    if spark is not None and not _java_regex_ok(spark, pattern):
        return s
    if not mp:
        return s
    keys = [str(k) for k in mp]
    m = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit("" if mp[k] is None else str(mp[k])))])
    if "g" in flags:
        pieces = F.split(s, pattern, -1)
        matches = F.regexp_extract_all(s, F.lit(pattern), 0)
    else:
        pieces = F.split(s, pattern, 2)
        matches = F.slice(F.regexp_extract_all(s, F.lit(pattern), 0), 1, 1)
    mapped = F.transform(matches, lambda x: F.when(F.map_contains_key(m, x), F.try_element_at(m, x)).otherwise(x))
    joined = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(mapped), F.lit(1))), F.try_element_at(pieces, F.lit(1)),
                         lambda acc, i: F.when(i <= F.size(mapped), F.concat(acc, F.try_element_at(mapped, i),
                                                                          F.try_element_at(pieces, i + 1))).otherwise(acc))
    empty = F.exists(F.regexp_extract_all(s, F.lit(pattern), 0), lambda x: x == "")
    return F.when(s.isNull(), _null()).when(empty | (F.size(matches) == 0), s).otherwise(joined)


# --- P4, P5, P6, P8 -----------------------------------------------------------------

def render_template(template: str, columns: Iterable[str]) -> Column:
    """``{field}`` placeholders filled with the value's text (null → '')."""
    parts = []
    for tok in re.split(r"(\{[^}]+\})", template):
        if not tok:
            continue
        m = re.fullmatch(r"\{([^}]+)\}", tok)
        parts.append(F.coalesce(_text(_col(columns, m.group(1).strip())), F.lit("")) if m else F.lit(tok))
    return F.concat(*parts) if parts else F.lit("")


def one_or_other(main: Column, fallback: Column) -> Column:
    """P5: main unless null/blank, else fallback."""
    return F.when(main.isNotNull() & (F.trim(_text(main)) != ""), _text(main)).otherwise(_text(fallback))


def _instant(c: Column) -> Column:
    """parseTimestamp, else a bare YYYY-MM-DD at UTC midnight."""
    return F.coalesce(parse_timestamp(_text(c)), F.to_timestamp(parse_ymd(_text(c)), "yyyy-MM-dd"))


def date_difference(start: Column, end: Column) -> Column:
    """round((end − start) / 1 day), half up; null if either fails."""
    return round_days(_instant(start), _instant(end))


def json_object(mapping: Mapping, columns: Iterable[str]) -> Column:
    """``{out key: source column}`` as JSON text; blank sources skipped,
    missing columns are null (kept as JSON null)."""
    fields = [(str(k), str(v or "").strip()) for k, v in (mapping or {}).items()]
    fields = [(k, v) for k, v in fields if v]
    if not fields:
        return F.lit("{}")
    st = F.struct(*[_col(columns, v).alias(k) for k, v in fields])
    return F.to_json(st, {"ignoreNullFields": "false"})


# --- P7 --------------------------------------------------------------------------------

_FORMULA_OK = re.compile(r"^[0-9.,+\-*/()\s]*(\{\s*[A-Za-z_][A-Za-z0-9_ ]*\}[0-9.,+\-*/()\s]*)*$")
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _number(columns, name: str) -> Column:
    """A formula operand: numeric columns as they are, text through N1."""
    dtype = columns.get(name, "") if isinstance(columns, Mapping) else ""
    c = _col(columns, name)
    if dtype in _NUMERIC or dtype.startswith("decimal"):
        return c.cast("double")
    return to_number_loose(_text(c))


def py_number_loose(raw: str) -> float | None:
    """N1 for a literal in the formula text (evaluated once, on the driver)."""
    s = re.sub(r"[^\d.,-]+", "", raw.strip())
    if not s:
        return None
    if "," in s and "." in s:
        s = s.replace(".", "").replace(",", ".")
    elif "," in s:
        s = s.replace(",", ".")
    return float(s) if re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", s) else None


def compile_formula(formula: str, columns: Iterable[str], strict_compat: bool = False) -> Column:
    """``+ - * / ( )``, unary minus and ``{col}`` (read with N1); a null
    operand, a division by zero, a non-finite result or bad syntax → null.

    ``strict_compat``: the source system's scanner turns any ``-`` outside a
    ``{col}`` into an empty literal, so every formula with a minus is null.
    Only digits, separators, operators, parentheses and ``{identifier}`` are
    accepted; nothing is passed to a SQL parser.
    """
    src = (formula or "").strip()
    if not src or not _FORMULA_OK.match(src):
        return F.lit(None).cast("double")
    outside = re.sub(r"\{[^}]*\}", "", src)
    if strict_compat and "-" in outside:
        return F.lit(None).cast("double")
    toks: list[tuple[str, object]] = []
    i = 0
    while i < len(src):
        ch = src[i]
        if ch.isspace():
            i += 1
        elif ch == "{":
            j = src.index("}", i)
            toks.append(("num", _number(columns, src[i + 1:j].strip())))
            i = j + 1
        elif ch in "0123456789.,":
            j = i
            while j < len(src) and src[j] in "0123456789.,":
                j += 1
            v = py_number_loose(src[i:j])
            if v is None:
                return F.lit(None).cast("double")
            toks.append(("num", F.lit(v)))
            i = j
        else:
            toks.append(("op", ch))
            i += 1

    pos = 0

    def peek():
        return toks[pos] if pos < len(toks) else None

    def take():
        nonlocal pos
        pos += 1
        return toks[pos - 1]

    def primary():
        t = peek()
        if t is None:
            raise ValueError
        if t == ("op", "-"):
            take()
            return -primary()
        if t == ("op", "("):
            take()
            e = expr()
            if peek() != ("op", ")"):
                raise ValueError
            take()
            return e
        if t[0] == "num":
            take()
            return t[1]
        raise ValueError

    def term():
        e = primary()
        while peek() in (("op", "*"), ("op", "/")):
            op = take()[1]
            r = primary()
            e = e * r if op == "*" else F.try_divide(e, F.when(r != 0, r))
        return e

    def expr():
        e = term()
        while peek() in (("op", "+"), ("op", "-")):
            op = take()[1]
            r = term()
            e = e + r if op == "+" else e - r
        return e

    try:
        out = expr()
        if pos != len(toks):
            raise ValueError
    except (ValueError, IndexError):
        return F.lit(None).cast("double")
    d = out.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


# --- entry point -------------------------------------------------------------------------

def compile_field(spec, columns, spark=None, strict_compat: bool = False) -> Column:
    """One mapping entry → Column (P1–P8). ``columns``: the source column
    names, or a name → type mapping (``dict(df.dtypes)``)."""
    columns = columns if isinstance(columns, Mapping) else {c: "" for c in columns}
    if spec is None:
        return _null()
    if isinstance(spec, str):
        return _col(columns, spec.strip()) if spec.strip() else _null()
    field = str(spec.get("field") or "").strip()
    tr = spec.get("tratamento")
    opt = spec.get("options") if isinstance(spec.get("options"), Mapping) else {}
    if not tr:
        return _col(columns, field) if field else _null()
    if tr == "mapear_valores":
        return map_values(_col(columns, field) if field else _null(), opt)
    if tr == "limpeza_regex":
        from_field = field if field and not field.startswith("/") and not field.startswith("{") else ""
        from_opt = str(opt.get("sourceField") or opt.get("source_field") or opt.get("source") or "").strip()
        src = from_field or from_opt
        return regex_clean(_col(columns, src) if src else _null(), opt, spark)
    if tr == "concatenar_campos":
        tpl = str(opt.get("concatenate") or field or "")
        return render_template(tpl, columns) if tpl else _null()
    if tr == "usar_um_ou_outro":
        main, fb = str(opt.get("main") or "").strip(), str(opt.get("fallback") or "").strip()
        return one_or_other(_col(columns, main) if main else _null(), _col(columns, fb) if fb else _null())
    if tr == "diferenca_entre_datas":
        st, en = str(opt.get("start") or "").strip(), str(opt.get("end") or "").strip()
        return date_difference(_col(columns, st) if st else _null(), _col(columns, en) if en else _null())
    if tr == "formula_matematica":
        return compile_formula(str(opt.get("formula") or field or ""), columns, strict_compat)
    if tr == "mapear_json":
        return json_object(opt.get("map") if isinstance(opt.get("map"), Mapping) else {}, columns)
    return _col(columns, field) if field else _null()


def apply_mapping(df: DataFrame, fields: Mapping, strict_compat: bool = False) -> DataFrame:
    """Project ``df`` into the canonical fields of a mapping config."""
    spark = df.sparkSession
    types = dict(df.dtypes)
    return df.select(*[compile_field(v, types, spark, strict_compat).alias(k) for k, v in fields.items()])


def _looks_like_column(s: str) -> bool:
    return bool(s) and not s.startswith("/") and "{" not in s and "," not in s and "??" not in s


def source_columns(fields: Mapping, available: Sequence[str] | None = None) -> list[str]:
    """The source columns a mapping needs, in order of first use (for a
    JDBC column list; for DataFrames Catalyst prunes the rest anyway). A
    comma-separated list (P10) names several; with ``available`` unknown
    columns, which read as null, are left out."""
    out: list[str] = []

    def add(c):
        c = (c or "").strip()
        if c and c not in out and (available is None or c in available):
            out.append(c)

    for v in (fields or {}).values():
        if isinstance(v, str):
            for c in v.split(","):
                add(c)
            continue
        if not isinstance(v, Mapping):
            continue
        tr = str(v.get("tratamento") or "").strip()
        field = str(v.get("field") or "").strip()
        opt = v.get("options") if isinstance(v.get("options"), Mapping) else {}
        if not tr or tr == "mapear_valores":
            if _looks_like_column(field):
                add(field)
        elif tr == "limpeza_regex":
            src = str(opt.get("sourceField") or opt.get("source_field") or opt.get("source") or "").strip()
            if _looks_like_column(src):
                add(src)
            if _looks_like_column(field):
                add(field)
        elif tr == "mapear_json":
            for c in (opt.get("map") or {}).values():
                add(str(c or ""))
        elif tr in ("concatenar_campos", "formula_matematica"):
            tpl = str(opt.get("concatenate" if tr == "concatenar_campos" else "formula") or
                      (field if tr == "formula_matematica" else "") or "")
            for m in re.findall(r"\{([^}]+)\}", tpl):
                add(m)
        elif tr == "usar_um_ou_outro":
            for c in (opt.get("main"), opt.get("fallback")):
                if _looks_like_column(str(c or "").strip()):
                    add(str(c).strip())
        elif tr == "diferenca_entre_datas":
            for c in (opt.get("start"), opt.get("end")):
                if _looks_like_column(str(c or "").strip()):
                    add(str(c).strip())
    return out


def phones_from_csv(csv_columns: str, columns: Iterable[str]) -> Column:
    """P10: ``"c1, c2, c3, c4"`` → map celular/comercial/residencial/extra_n →
    value text ('' for null)."""
    cols = [c.strip() for c in (csv_columns or "").split(",") if c.strip()]
    if not cols:
        return F.lit(None).cast("map<string,string>")
    names = ["celular", "comercial", "residencial"]
    kv = []
    for i, c in enumerate(cols):
        kv += [F.lit(names[i] if i < len(names) else f"extra_{i + 1}"), F.coalesce(_text(_col(columns, c)), F.lit(""))]
    return F.create_map(*kv)


_OPS = {"LIKE", "<>", ">=", ">", "<=", "<"}


def compile_where(clauses, columns: Iterable[str] | None = None) -> Column:
    """AND of the configured clauses. Unknown operators mean '='; a null
    value with '=' / '<>' is IS [NOT] _null(), with any other operator the clause
    is dropped; a clause without value or field is dropped; LIKE is
    case-sensitive."""
    pred = F.lit(True)
    for c in clauses or []:
        if not isinstance(c, Mapping):
            continue
        field = str(c.get("field") or "").strip()
        if not field or "value" not in c:
            continue
        op = str(c.get("operator") if c.get("operator") is not None else "=").strip().upper()
        op = op if op in _OPS else "="
        col = F.col(f"`{field}`")
        v = c["value"]
        if v is None:
            if op == "=":
                pred = pred & col.isNull()
            elif op == "<>":
                pred = pred & col.isNotNull()
            continue
        lit = F.lit(v)
        pred = pred & {"=": col == lit, "<>": col != lit, ">=": col >= lit, ">": col > lit, "<=": col <= lit,
                       "<": col < lit, "LIKE": col.like(str(v))}[op]
    return pred


def date_range_filter(col: Column, start: str | None, end: str | None, whole_last_day: bool = False) -> Column:
    """``>= start`` and ``<= end``; a bare end date means its midnight
    (later times that day are out) unless ``whole_last_day``."""
    pred = F.lit(True)
    if start:
        pred = pred & (col >= F.lit(start).cast("timestamp_ntz"))
    if end:
        e = F.lit(f"{end} 23:59:59.999999" if whole_last_day and len(end) == 10 else end).cast("timestamp_ntz")
        pred = pred & (col <= e)
    return pred
