"""Expressions written once and rendered both as a Spark Column and as
DuckDB SQL — used to derive dirty inputs from the test tables identically
in a query and in its oracle."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


class Dual:
    """``col`` is built lazily (Columns need an active session; the SQL
    side is needed without one)."""

    def __init__(self, col, sql: str):
        self._make = col if callable(col) and not isinstance(col, Column) else (lambda: col)
        self.sql = sql

    @property
    def col(self) -> Column:
        return self._make()


def lit(v) -> Dual:
    if v is None:
        return Dual(lambda: F.lit(None).cast("string"), "cast(null as varchar)")
    s = str(v)
    return Dual(lambda: F.lit(s), "'" + s.replace("'", "''") + "'")


def concat(*parts: Dual) -> Dual:
    if len(parts) == 1:
        return parts[0]
    return Dual(lambda: F.concat(*[p.col for p in parts]), "(" + " || ".join(p.sql for p in parts) + ")")


def template(t: str | None, names: dict[str, Dual]) -> Dual:
    """``'R$ {i},{f}'`` → concat of literals and named expressions."""
    if t is None:
        return lit(None)
    pieces = []
    for tok in re.split(r"(\{[a-z]\})", t):
        if not tok:
            continue
        m = re.fullmatch(r"\{([a-z])\}", tok)
        pieces.append(names[m.group(1)] if m else lit(tok))
    return concat(*pieces) if pieces else lit("")


def pick(key: Dual, options: list[Dual]) -> Dual:
    """Option number ``key % len(options)``."""
    n = len(options)
    def spark():
        return F.element_at(F.array(*[o.col for o in options]), (key.col % n + 1).cast("int"))

    sql = "(case " + " ".join(f"when {key.sql} % {n} = {i} then {o.sql}" for i, o in enumerate(options)) + " end)"
    return Dual(spark, sql)


def customer_names() -> dict[str, Dual]:
    """Named pieces of a customer row used in dirty-text templates."""
    absbal = "abs(c_acctbal)"
    return {
        "k": Dual(lambda: F.col("c_custkey").cast("string"), "cast(c_custkey as varchar)"),
        "i": Dual(lambda: F.floor(F.abs("c_acctbal")).cast("bigint").cast("string"),
                  f"cast(cast(floor({absbal}) as bigint) as varchar)"),
        "f": Dual(lambda: F.lpad((F.floor(F.abs("c_acctbal") * 100).cast("bigint") % 100).cast("string"), 2, "0"),
                  f"lpad(cast(cast(floor({absbal} * 100) as bigint) % 100 as varchar), 2, '0')"),
        "t": Dual(lambda: F.floor(F.abs("c_acctbal") / 1000).cast("bigint").cast("string"),
                  f"cast(cast(floor({absbal} / 1000) as bigint) as varchar)"),
        "h": Dual(lambda: F.lpad((F.floor(F.abs("c_acctbal")).cast("bigint") % 1000).cast("string"), 3, "0"),
                  f"lpad(cast(cast(floor({absbal}) as bigint) % 1000 as varchar), 3, '0')"),
        "n": Dual(lambda: F.col("c_name"), "c_name"),
        "s": Dual(lambda: F.col("c_mktsegment"), "c_mktsegment"),
        "z": Dual(lambda: F.lpad(F.col("c_custkey").cast("string"), 6, "0"), "lpad(cast(c_custkey as varchar), 6, '0')"),
        "d": Dual(lambda: F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"),
                  "lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0')"),
        "m": Dual(lambda: F.lpad((F.col("c_custkey") % 12 + 1).cast("string"), 2, "0"),
                  "lpad(cast(c_custkey % 12 + 1 as varchar), 2, '0')"),
        "y": Dual(lambda: (F.col("c_custkey") % 30 + 1995).cast("string"), "cast(c_custkey % 30 + 1995 as varchar)"),
        "x": Dual(lambda: F.lpad((F.col("c_custkey") % 24).cast("string"), 2, "0"),
                  "lpad(cast(c_custkey % 24 as varchar), 2, '0')"),
        "p": Dual(lambda: F.lpad((F.col("c_custkey") % 60).cast("string"), 2, "0"),
                  "lpad(cast(c_custkey % 60 as varchar), 2, '0')"),
    }


CUSTOMER_KEY = Dual(lambda: F.col("c_custkey"), "c_custkey")


def dirty_customer_text(templates: list[str | None], salt: int = 0) -> Dual:
    """One dirty text per customer: template number ``(c_custkey + salt) % n``."""
    names = customer_names()
    key = Dual(lambda: F.col("c_custkey") + salt, f"(c_custkey + {salt})")
    return pick(key, [template(t, names) for t in templates])
