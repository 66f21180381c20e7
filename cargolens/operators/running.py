"""Skew-safe running sums and row numbers (the discount waterfall, W7,
and positional indexes).

A window partitioned by the group key sends a whole group to one task.
Groups are therefore split into *cold* and *hot* ones with a count
aggregate (map-side combined): a group is hot when it has more than
``hot_threshold`` rows. There are at most ``rows / hot_threshold`` hot
groups, so the hot-key set has a proven size bound and is broadcast.

* cold groups use the plain window (each task sorts at most
  ``hot_threshold`` rows of one group);
* hot groups are range-partitioned on (group, order), so one group is cut
  into several ranges; each range computes local running sums and the sum
  of the earlier ranges of the same group (one row per range — bounded by
  the number of partitions) is added back as an offset.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cargolens.functions.parse import money_2
from cargolens.session import dropping_shuffles, write_once

DEFAULT_HOT_THRESHOLD = 2_000_000


def split_hot_groups(df: DataFrame, group_cols: Sequence[str],
                     hot_threshold: int) -> tuple[DataFrame, DataFrame | None]:
    """(cold rows, hot rows): hot groups have more than ``hot_threshold`` rows.

    The hot-key set is checked first with one aggregate job (it holds at
    most rows / ``hot_threshold`` keys); without hot groups the input is
    returned whole as cold and no second branch is planned."""
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    hot_keys = counts.where(F.col("_n") > hot_threshold).select(*group_cols)
    with dropping_shuffles(df.sparkSession):
        some = hot_keys.limit(1).count()
    if some == 0:
        return df, None
    # a bounded, broadcastable set
    named = hot_keys.select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group_cols)], F.lit(True).alias("_hot"))
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_k{i}")) for i, g in enumerate(group_cols)])
    tagged = df.join(F.broadcast(named), same, "left").drop(*[f"_k{i}" for i in range(len(group_cols))])
    return (tagged.where(F.col("_hot").isNull()).drop("_hot"),
            tagged.where(F.col("_hot").isNotNull()).drop("_hot"))


def prefix_sum_before(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                      value_col: str, out_col: str = "prior", num_ranges: int | None = None,
                      hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Add ``out_col`` = Σ ``value_col`` over the rows of the same group that
    come strictly before this row in ``order`` (which must be unique within
    the group)."""
    cold, hot = split_hot_groups(df, group_cols, hot_threshold)
    w = Window.partitionBy(*group_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cold_out = cold.withColumn(out_col, F.coalesce(F.sum(value_col).over(w), F.lit(0)))
    if hot is None:
        return cold_out
    return cold_out.unionByName(ranged_prefix_sum(hot, group_cols, order, value_col, out_col, num_ranges))


def _ranged(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], num_ranges: int | None) -> DataFrame:
    """The rows with ``_rid``, their range of (group, order). Several branches
    must see one and the same cut into ranges (its bounds are sampled), so
    the ranged rows are written once and read back."""
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(g) for g in group_cols], *order).withColumn("_rid", F.spark_partition_id())
    return write_once(ranged, "ranged")


def _with_offsets(local: DataFrame, offsets: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Each row beside its range's row of ``offsets`` (null group keys meet too)."""
    extra = [c for c in offsets.columns if c not in (*group_cols, "_rid")]
    named = offsets.select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group_cols)], F.col("_rid").alias("_krid"), *extra)
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_k{i}")) for i, g in enumerate(group_cols)])
    return local.join(named, same & (F.col("_rid") == F.col("_krid"))).drop("_krid", *[f"_k{i}" for i in range(len(group_cols))])


def ranged_prefix_sum(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                      value_col: str, out_col: str, num_ranges: int | None = None) -> DataFrame:
    """Add ``out_col`` = Σ ``value_col`` over the earlier rows of the group, all
    groups cut into ranges of (group, order): tasks are even however the rows
    are spread over groups, at the price of one written copy."""
    ranged = _ranged(df, group_cols, order, num_ranges)
    w_local = Window.partitionBy(*group_cols, "_rid").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_lp", F.coalesce(F.sum(value_col).over(w_local), F.lit(0)))
    totals = ranged.groupBy(*group_cols, "_rid").agg(F.sum(value_col).alias("_tot"))
    w_off = Window.partitionBy(*group_cols).orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(w_off), F.lit(0))).drop("_tot")
    out = _with_offsets(local, offsets, group_cols)
    return out.withColumn(out_col, F.col("_off") + F.col("_lp")).drop("_rid", "_lp", "_off")


def prefix_sum_and_peak(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], value_col: str,
                        sum_col: str = "prior", peak_col: str = "peak", num_ranges: int | None = None,
                        hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Add ``sum_col``, the sum of ``value_col`` over the rows of the group
    before this one, and ``peak_col``, the highest that sum has been so far
    (0 before any row counts).

    A run of rows is summed up by (its sum, its highest prefix sum), and two
    runs compose to (s1 + s2, max(m1, s1 + m2)). That is associative, so a hot
    group is cut into ranges whose summaries (one row a range) are composed
    and added to each range's own running values."""
    cold, hot = split_hot_groups(df, group_cols, hot_threshold)

    def running(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        upto = rows.withColumn("_upto", F.sum(value_col).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return upto.withColumn("_top", F.max("_upto").over(w.rowsBetween(Window.unboundedPreceding, -1)))

    zero = F.lit(0).cast("bigint")
    out = (running(cold, group_cols).withColumn(sum_col, F.col("_upto") - F.col(value_col))
           .withColumn(peak_col, F.greatest(zero, F.col("_top"))).drop("_upto", "_top"))
    if hot is None:
        return out
    local = running(_ranged(hot, group_cols, order, num_ranges), [*group_cols, "_rid"])
    summaries = local.groupBy(*group_cols, "_rid").agg(F.sum(value_col).alias("_s"), F.max("_upto").alias("_m"))
    before = Window.partitionBy(*group_cols).orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (summaries.withColumn("_off", F.coalesce(F.sum("_s").over(before), zero))
               .withColumn("_high", F.greatest(zero, F.max(F.col("_off") + F.col("_m")).over(before))).drop("_s", "_m"))
    placed = _with_offsets(local, offsets, group_cols)
    return out.unionByName(
        placed.withColumn(sum_col, F.col("_off") + F.col("_upto") - F.col(value_col))
        .withColumn(peak_col, F.greatest(F.col("_high"), F.col("_off") + F.col("_top")))
        .drop("_rid", "_upto", "_top", "_off", "_high"))


def row_number_within(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                      out_col: str = "row_number", hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """1-based position of each row inside its group in ``order`` (a unique
    order) — ``row_number()`` without sending a whole group to one task."""
    out = prefix_sum_before(df.withColumn("_one", F.lit(1)), group_cols, order, "_one", "_before",
                            hot_threshold=hot_threshold)
    return out.withColumn(out_col, (F.col("_before") + 1).cast("int")).drop("_one", "_before")


def dense_positions(df: DataFrame, order: Sequence[Column], out_col: str, num_ranges: int | None = None) -> DataFrame:
    """Add ``out_col``, the 0-based position in ``order`` (unique) over the
    whole table: ranges are numbered locally and shifted by the sizes of the
    ranges before them (one row a range), so no task sorts the table."""
    ranged = _ranged(df, [], order, num_ranges)
    local = F.row_number().over(Window.partitionBy("_rid").orderBy(*order))
    sizes = ranged.groupBy("_rid").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_rid", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (ranged.withColumn("_local", local).join(starts, "_rid")
            .withColumn(out_col, F.col("_start") + F.col("_local") - 1).drop("_rid", "_local", "_start"))


def cents(money: Column) -> Column:
    """N40 as whole cents."""
    return F.round(money_2(money.cast("string")) * 100).cast("bigint")


def discount_waterfall(lines: DataFrame, group_cols: Sequence[str], value_col: str, discount_col: str,
                       first_flag_col: str, position_col: str, out_col: str = "discounted_value",
                       num_ranges: int | None = None, hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Consume a group's discount line by line — flagged lines first, then
    the highest value, then the original position.

    All amounts are whole cents (rounded as N40, so unparsable ones are 0),
    which makes each step exact. While something of the discount remains, a
    line takes ``least(value, remaining)``: a negative line goes to 0 and
    gives its amount back to the discount. Once nothing remains, later lines
    stay as they are. So what remains before a line is ``discount`` less the
    sum of the lines before it, provided that sum has stayed below the
    discount so far, else 0 — a running sum and its running peak.

    ``out_col`` has the type of ``value_col`` where that is numeric, else
    double. A null flag counts as unflagged; without a discount above 0 the
    (rounded) values stay.
    """
    taken_names = ("_cents", "_first", "_prior", "_peak")
    rows = (lines.withColumn("_cents", cents(F.col(value_col)))
            .withColumn("_first", F.coalesce(F.col(first_flag_col), F.lit(False))))
    order = [F.col("_first").desc(), F.col("_cents").desc(), F.col(position_col).asc()]
    run = prefix_sum_and_peak(rows, group_cols, order, "_cents", "_prior", "_peak", num_ranges, hot_threshold)
    d = cents(F.col(discount_col))
    taken = F.when(d > F.col("_peak"), F.least(F.col("_cents"), d - F.col("_prior"))).otherwise(F.lit(0))
    kind = lines.schema[value_col].dataType
    out = ((F.col("_cents") - taken) / 100).cast(kind if isinstance(kind, NumericType) else "double")
    return run.withColumn(out_col, out).drop(*taken_names)
