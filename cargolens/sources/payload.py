"""Landed partner payloads.

Partner responses are landed as text files (one JSON document — a page
array or a single object — per line or per file). They are read with
``spark.read.text`` / ``spark.readStream.text``, repaired (S3), parsed to
``VARIANT`` and expanded to one row per object (S2). Field access goes
through the P18 pickers, which never fail on a missing or mistyped field.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_landed(spark: SparkSession, path: str, whole_files: bool = False, stream: bool = False,
                max_files: int = 100) -> DataFrame:
    """Landed payload files → ``(source_file, line, text)``, one row per line
    with a text, or per file when a file holds one (multi-line) document
    (``whole_files``). ``stream`` gives the same rows as a file stream that
    takes ``max_files`` new files a trigger. A landed file is one partner
    page, so it is read whole to number its lines."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if stream else spark.read
    files = reader.option("wholetext", "true").text(path).select(F.col("_metadata.file_path").alias("source_file"), "value")
    if whole_files:
        return files.select("source_file", F.lit(0).alias("line"), F.col("value").alias("text"))
    lines = files.select("source_file", F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    return lines.where(F.trim("text") != "")


# Repair steps as (pattern, replacement), applied in order after the prefix cut.
_REPAIR_STEPS = [
    (r"\bNone\b", "null"),
    (r"\bTrue\b", "true"),
    (r"\bFalse\b", "false"),
    (r"\b[a-zA-Z0-9_]*__int\s*\(\s*([^)]*?)\s*\)", "$1"),
    (r"\b(?:float|int|Decimal)\s*\(\s*([^)]*?)\s*\)", "$1"),
]


def repair_json_text(text: Column) -> Column:
    """S3: drop a BOM and anything before the first ``{``/``[``; Python
    literals None/True/False become JSON; ``x__int(…)``, ``float(…)``,
    ``int(…)`` and ``Decimal(…)`` are unwrapped to their (trimmed) content.
    Every step is one regex pass over the text (no step repeats an input)."""
    s = F.regexp_replace(F.trim(text), "^\ufeff", "")
    s = F.regexp_replace(s, r"^[^{\[]*(?=[{\[])", "")
    s = F.regexp_replace(F.trim(s), "^\ufeff", "")
    for pat, rep in _REPAIR_STEPS:
        s = F.regexp_replace(s, pat, rep)
    return s


def parse_payloads(df: DataFrame, text_col: str = "text", repair: bool = False) -> DataFrame:
    """Text → ``payload`` VARIANT, null when the text is not valid
    JSON (see ``quarantine``). ``repair`` applies S3 first — only the
    sources whose responses carry Python-style literals need it. Rows are not filtered here:
    a filter on the parsed value would make Spark parse every text twice
    (once in the filter, once in the projection); ``expand_objects`` drops
    the null payloads after its generator, where the value is materialised."""
    txt = repair_json_text(F.col(text_col)) if repair else F.col(text_col)
    return df.withColumn("payload", F.try_parse_json(txt))


def quarantine(parsed: DataFrame) -> DataFrame:
    """S3: the rows whose text could not be parsed."""
    return parsed.where(F.col("payload").isNull()).drop("payload")


def expand_objects(df: DataFrame, payload_col: str = "payload", path: str = "$") -> DataFrame:
    """A page (JSON array at ``path``) becomes one row per element with its
    position; a single object stays one row (position 0)."""
    arr = F.try_variant_get(F.col(payload_col), path, "array<variant>")
    single = F.array(F.try_variant_get(F.col(payload_col), path, "variant"))
    ex = df.select("*", F.posexplode(F.coalesce(arr, single)).alias("obj_pos", "obj")).drop(payload_col)
    return ex.where(F.col("obj").isNotNull())


def once(value: Column, make) -> Column:
    """``make(value)`` with the value computed once per row. A VARIANT is
    decoded anew by each expression that reads it, and inside conditions and
    lambdas nothing is shared between expressions."""
    return F.try_element_at(F.transform(F.array(value), make), F.lit(1))


# --- many fields of one object ----------------------------------------------------------

class Fields:
    """Fields of a VARIANT object, decoded together.

    A path read on its own walks the object again, and one that is missing
    ends in an exception inside Spark. Here the paths that are asked for make
    one struct type, and the object is cast to it in one pass (``decode``):
    missing and mistyped parts are null, as they are for a path. Parts wanted
    as JSON text or as VARIANT are a second struct, as they may hold fields of
    the first. ``text``, ``number`` … give what the P18 pickers give.
    """

    def __init__(self, name: str = "_f", at: Column | None = None, tree: dict | None = None):
        self.name = name
        self.at, self.parts = F.col(name) if at is None else at, F.col(f"{name}_parts")
        self.tree, self.part_tree = {} if tree is None else tree, {}

    @staticmethod
    def _leaf(at: Column, tree: dict, path: str, kind) -> tuple[Column, object]:
        """The column of a path, and its kind: a type's name, a dict (object) or a
        list of one dict (array of objects)."""
        steps = [x for x in re.split(r"\.|(\[\d+\])", path.removeprefix("$").removeprefix(".")) if x]
        for i, step in enumerate(steps):
            if step.startswith("["):
                at = F.get(at, F.lit(int(step[1:-1])))
                continue
            after = steps[i + 1] if i + 1 < len(steps) else None
            want = kind if after is None else [{}] if after.startswith("[") else {}
            have = tree.setdefault(step, want)
            if type(have) is not type(want) or isinstance(have, str) and have != want:      # only objects and arrays share a name
                raise ValueError(f"{path} is read as {want!r} and as {have!r}")
            at, tree, last = at.getField(step), have[0] if isinstance(have, list) else have, have
        return at, last

    def value(self, path: str, kind: str) -> Column:
        return self._leaf(self.at, self.tree, path, kind)[0]

    def text(self, path: str) -> Column:
        s = F.trim(self.value(path, "string"))
        return F.when(s != "", s)

    def number(self, path: str) -> Column:
        d = self.value(path, "double")
        return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)

    def object(self, path: str) -> Column:
        """Not null where there is an object."""
        return self._leaf(self.at, self.tree, path, {})[0]

    def part(self, path: str, kind: str = "variant") -> Column:
        return self._leaf(self.parts, self.part_tree, path, kind)[0]

    def rows(self, path: str, make) -> Column:
        """Array of ``make(position, fields of the element)`` over the elements
        that are objects; empty without an array."""
        array, kind = self._leaf(self.at, self.tree, path, [{}])
        placed = F.filter(F.transform(array, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p["x"].isNotNull())
        return F.coalesce(F.transform(placed, lambda p: make(p["i"], Fields(at=p["x"], tree=kind[0]))), F.array())

    def decode(self, df: DataFrame, v: Column) -> DataFrame:
        """``df`` with the columns that the fields are read from; all fields
        must have been asked for."""
        for name, tree in ((self.name, self.tree), (f"{self.name}_parts", self.part_tree)):
            if tree:
                df = df.withColumn(name, F.try_variant_get(v, "$", _ddl(tree)))
        return df


def _ddl(kind) -> str:
    if isinstance(kind, list):
        return f"array<{_ddl(kind[0])}>"
    if isinstance(kind, dict):
        return "struct<" + ", ".join(f"`{k}`: {_ddl(x)}" for k, x in (kind or {"_": "variant"}).items()) + ">"
    return kind


# --- P18 pickers (of a VARIANT, or of its Fields) ---------------------------------------

def pick_string(v: Column | Fields, path: str) -> Column:
    """Trimmed text, or null when missing/blank (numbers are rendered as text)."""
    if isinstance(v, Fields):
        return v.text(path)
    return once(F.trim(F.try_variant_get(v, path, "string")), lambda s: F.when(s != "", s))


def pick_number(v: Column | Fields, path: str) -> Column:
    """A finite number (numeric text accepted), else null."""
    if isinstance(v, Fields):
        return v.number(path)
    return once(F.try_variant_get(v, path, "double"), lambda d: F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d))


def pick_array(v: Column, path: str) -> Column:
    """An array of objects, or an empty array."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def pick_object(v: Column | Fields, path: str) -> Column:
    """An object (kept as VARIANT; of Fields, the struct of what is read from
    it), or null when missing or not an object."""
    if isinstance(v, Fields):
        return v.object(path)
    return once(F.try_variant_get(v, path, "variant"), lambda o: F.when(F.schema_of_variant(o).startswith("OBJECT"), o))
