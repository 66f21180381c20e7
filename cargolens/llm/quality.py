"""Quality rules with cross-document line frequency (DataFrame functions only).

Lines are normalised (trimmed, lower case) and hashed. For every host, the number of *distinct texts* that
hold a line is counted (exact copies of a document count once, so a group
of copies never makes its own lines frequent). A line is over its limit
when it stands in more than ``max_share`` of the host's texts, whatever the
size of the host, and in more than ``min_docs`` (2: two texts that share a
line do not make it a host's line). Removing such lines leaves a document with the characters
of its other lines; one that keeps less than ``min_left`` of them is
depleted and rejected.

Skew: lines are de-duplicated inside their row before they are exploded
and (host, line, text) triples are combined map-side, so a hot host or a
hot line is spread by text hash first and counted afterwards. The lines
over their limit are few by construction (at most lines-per-text /
max_share for each host).

Edge cases: a null text has no words and fails the base rules; a null
host is a host of its own; equal rows get equal verdicts; an empty table
gives an empty result; columns of the input other than the id, the text
and the host are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import materialise, words_col

#: fixed values: the symbols that the base rule counts
SYMBOLS = "[#*$%&|<>]"


def with_repeated_window_words(df: DataFrame, words: str, out: str, width: int = 5) -> DataFrame:
    """Add ``out``: the words of array column ``words`` that lie in a
    ``width``-word window found at least twice in the row.

    Window hashes are compared as a set first; only texts that do repeat a
    window pay for the sort, by (hash, position). A repeated window at p covers p..p+width-1, and the
    union is summed over the sorted positions. Each step is its own column,
    which keeps it inside generated code."""
    g, z, st = f"_{out}_g", f"_{out}_z", f"_{out}_s"
    none = F.array().cast("array<bigint>")
    unsorted = F.array().cast("array<struct<h:bigint,p:bigint>>")
    h = F.col(f"_{out}_h")
    df = df.withColumn(f"_{out}_h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(g, F.when(F.size(h) <= width, none).otherwise(F.transform(
        F.slice(h, F.lit(1), F.size(h) - F.lit(width - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))))
    G, Z, S = F.col(g), F.col(z), F.col(st)
    df = df.withColumn(z, F.when(F.size(F.array_distinct(G)) == F.size(G), unsorted).otherwise(F.sort_array(
        F.transform(G, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("p"))))))
    df = df.withColumn(st, F.sort_array(F.transform(F.filter(Z, lambda e, i: (
        F.get(Z, i - 1)["h"].eqNullSafe(e["h"]) | F.get(Z, i + 1)["h"].eqNullSafe(e["h"]))), lambda e: e["p"])))
    steps = F.transform(S, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(S, i + 1) - p, F.lit(width))))
    df = df.withColumn(out, F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x))
    return df.drop(f"_{out}_h", g, z, st)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """Per row: base measures, the text's hash and its lines as
    (normalised hash, characters) pairs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))
    base = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.col(host_col).alias("host"))
            .withColumn("words", words_col(F.col("text")))
            .withColumn("lines", F.filter(F.split(text, "\n"), lambda x: trimmed(x) != "")))
    return with_repeated_window_words(base, "words", "n_repeat_words").select(
        "doc_id", "host", F.struct(F.xxhash64(text), F.crc32(text.cast("binary"))).alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform(F.transform("lines", trimmed), lambda x: F.struct(
            F.xxhash64(F.lower(x)).alias("line"),
            F.char_length(x).cast("long").alias("chars"))).alias("lines"))


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 host_col: str = "source", min_words: int = 10, max_repeat_pct: int = 20,
                 min_docs: int = 2, max_share: float = 0.1, min_left: float = 0.3) -> DataFrame:
    """One row per input row: base measures, ``base_failed``, the characters
    of its lines (``line_chars``) and of those over their limit
    (``removed_chars``), ``text_key`` and ``kept``."""
    rows = materialise(
        measures(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()),
        "quality-rows")
    texts = rows.select("host", "text_key", F.array_distinct(F.transform("lines", lambda e: e["line"])).alias("ls"))
    hosts = (texts.groupBy("host", "text_key").agg(F.lit(1).alias("one"))
             .groupBy("host").agg(F.count(F.lit(1)).alias("host_texts")))
    seen = (texts.select("host", "text_key", F.explode("ls").alias("line"))
            .groupBy("host", "line", "text_key").agg(F.lit(1).alias("one"))
            .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_texts"))
            .where(F.col("n_texts") > min_docs))
    h = hosts.alias("h")
    over = (seen.alias("s").join(h, F.col("s.host").eqNullSafe(F.col("h.host")))
            .where(F.col("n_texts") > F.col("host_texts") * F.lit(max_share))
            .select(F.col("s.host").alias("over_host"), F.col("line").alias("over_line")))
    lines = rows.select("row", "host", F.explode("lines").alias("e"))
    removed = (lines.join(over, F.col("host").eqNullSafe(F.col("over_host"))
                          & (F.col("e.line") == F.col("over_line")))
               .groupBy("row").agg(F.sum("e.chars").alias("removed_chars")))
    base_failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    none = F.lit(0).cast("long")
    left = F.col("line_chars") - F.col("removed_chars")
    return (rows.withColumn("line_chars", F.aggregate("lines", none, lambda a, e: a + e["chars"]))
            .drop("lines").join(removed, "row", "left")
            .withColumn("removed_chars", F.coalesce(F.col("removed_chars"), none))
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & (left >= F.col("line_chars") * F.lit(min_left)))
            .drop("row"))


def keep_good(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` (its own columns) that ``line_quality`` keeps.
    The columns travel as one struct, so none can clash with the helpers."""
    def key(doc_id, host, text_key):
        return F.struct(F.col(doc_id).alias("id"), F.col(host).alias("host"), text_key.alias("text")).alias("key")

    bad = line_quality(docs, **params).where(~F.col("kept")).select(key("doc_id", "host", F.col("text_key"))).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(key("doc_id", "source", F.struct(F.xxhash64(text), F.crc32(text.cast("binary")))), F.struct("*").alias("own"))
    return own.join(bad, "key", "left_anti").select("own.*")
