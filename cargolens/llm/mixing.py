"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: weights by the source's place in
code-point order (``weights`` repeating, null last) share ``share`` times
the words of the table; a target stops at ``max_copies`` times its
source's words and the excess is shared again by weight until none is
above. A document of a source with target / words = r is due r copies:
floor(r) whole copies for certain, and one more with inclusion odds
proportional to its size: of what a source still wants, long documents are
likelier to bring a part. The extra copies are drawn by Pareto order
sampling: documents are ranked by their random odds u / (1 - u) divided by
their inclusion odds and taken from the top until the source's fixed size
(its remaining words) is met; the document on the border is taken if that
brings the source nearer to its target. The factor that turns sizes into
odds is common to a source and fixed by that size, so it need not be known
to rank.

``u`` is a hash of the document id, its text and the seed, so reruns agree.

No source is gathered in one task: rows are cut into ranges of (source,
rank), each range sums its own words, and the sums of the ranges before it
are added (one row a range).

Edge cases: a null text has size 0 and is taken 0 words; a null source is
the last source; a table without words gives targets of 0; equal rows have
equal ranks and are told apart by their row number; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.common import global_index, materialise, n_words_col
from cargolens.operators.running import ranged_prefix_sum

#: fixed values: weights of the sources in code-point order, repeating
WEIGHTS = (3.0, 1.0, 2.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5,
                   max_copies: float = 2.0) -> DataFrame:
    """(source, source_size, target) for a table (source, source_size)."""
    ordered = global_index(sizes, [F.col("source").asc_nulls_last()], "mix-sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("idx") % len(weights) + 1).cast("int"))
    src = materialise(ordered.select("source", "source_size", w.alias("w")), "mix-weights")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    # The level (words per unit of weight) rises until no further source is capped.
    level, cap = 0.0, F.col("source_size") * F.lit(float(max_copies))
    while total:
        capped = F.col("w") * F.lit(level) > cap
        held, free = src.agg(F.sum(F.when(capped, cap).otherwise(0.0)),
                             F.sum(F.when(capped, 0.0).otherwise(F.col("w")))).first()
        if not free:
            break
        nxt = (share * total - held) / free
        if nxt <= level:
            break
        level = nxt
    target = F.least(F.col("w") * F.lit(level), cap)
    return src.select("source", "source_size", target.alias("target"))


def pareto_mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, max_copies: float = 2.0,
               seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """doc_id, text_key, source, size, source_size, target, copies, taken."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), text), 11).cast("double")
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"),
        F.col(source_col).alias("source"), n_words_col(F.col(text_col)).alias("size"),
        ((raw + 0.5) / float(1 << 53)).alias("u"),
        F.monotonically_increasing_id().alias("row")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, max_copies), "mix-targets")

    t = targets.withColumnRenamed("source", "t_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    due = (rows.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
           .withColumn("whole", F.floor(ratio).cast("long"))
           .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
           .withColumn("rank", pareto_rank(F.col("u"), F.col("size"))))
    ranked = ranged_prefix_sum(due, ["source"], [F.col(c) for c in ("rank", "u", "doc_id", "row")], "size", "before")
    upto, before, wanted = F.col("before") + F.col("size"), F.col("before"), F.col("wanted")
    drawn = (F.col("size") > 0) & ((upto <= wanted) | ((before < wanted) & (upto - wanted < wanted - before)))
    copies = F.col("whole") + drawn.cast("long")
    return ranked.select("doc_id", "text_key", "source", "size", "source_size", "target",
                         copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def pareto_rank(u: Column, size: Column) -> Column:
    """Random odds over inclusion odds (up to the source's common factor); an
    empty document comes last."""
    return F.when(size > 0, u / (1 - u) / size).otherwise(F.lit(float("inf")))


def mix_documents(docs: DataFrame, **params) -> DataFrame:
    """The mixed table: each row of ``docs`` (its own columns) as often as
    it was drawn. Rows equal in id, source and text are interchangeable and
    share their draws out in any order. The columns travel as one struct, so
    none can clash with the helpers."""
    drawn = pareto_mix(docs, **params).where(F.col("copies") > 0)
    drawn = (drawn.groupBy(F.struct(F.col("doc_id").alias("id"), "source", "text_key").alias("key"))
             .agg(F.sort_array(F.collect_list("copies"), asc=False).alias("copies")))
    key = F.struct(F.col("doc_id").alias("id"), "source", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"))
    numbered = docs.select(key.alias("key"), F.struct("*").alias("own")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    times = F.get(F.col("copies"), F.col("nth") - 1).cast("int")
    return (numbered.join(drawn, "key").withColumn("times", times).where(F.col("times") > 0)
            .select("own", F.explode(F.sequence(F.lit(1), F.col("times")))).select("own.*"))
