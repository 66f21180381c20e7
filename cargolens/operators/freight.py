"""Freight quote operators: best option (W1, W2), product lines (A2),
order per quote (J15) and the daily freight rollup (A1).

Canonical inputs (column names; extra columns are ignored):

* quotes   ``id, company_id, date, quoted_at, channel, destination_state,
  quote_id, invoice_value``
* options  ``id, freight_quote_id, line_index, shipping_value, deadline,
  carrier`` (W2 also ``carrier_deadline, price``)
* items    ``quote_id, product_id`` (``quote_id`` is the quote surrogate id)
* orders   ``id, company_id, quote_id, freight_amount`` (``quote_id`` is the
  partner quote id text)

Every "first row per key" below is an aggregate (``min`` of a struct
whose fields are the ordering), never a window. Straight from a scan it
combines map-side; ``best_option_score`` (W2) first keeps the cheapest option
of each (quote, deadline), so what meets the quote's minima again is one row
per distinct deadline, whatever the number of options.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.dates import local_date
from cargolens.functions.freight_labels import deadline_bucket, freight_range
from cargolens.session import write_once

ROLLUP_KEYS = ["company_id", "date", "channel", "state", "freight_range",
               "deadline_bucket", "courier", "product_id"]
QUOTES_A_PORTION = 4_000_000


def cheapest_option(options: DataFrame, quote_col: str = "freight_quote_id") -> DataFrame:
    """Per quote, the option with the lowest value, then the lowest total
    deadline; options without value or deadline never win. Ties go to the
    lowest ``line_index`` (then option id), which makes the pick stable.

    Output: ``quote_col, shipping_value, deadline, carrier, line_index``.
    """
    valid = options.where(F.col("shipping_value").isNotNull() & F.col("deadline").isNotNull())
    order = F.struct(
        F.col("shipping_value").try_cast("double").alias("v"),
        F.col("deadline").alias("d"),
        F.col("line_index").alias("i"),
        F.col("id").alias("oid"),
        F.col("carrier").alias("carrier"),
    )
    best = valid.groupBy(quote_col).agg(F.min(order).alias("b"))
    return best.select(
        quote_col,
        F.col("b.v").alias("shipping_value"),
        F.col("b.d").alias("deadline"),
        F.col("b.carrier").alias("carrier"),
        F.col("b.i").alias("line_index"),
    )


def best_option_score(options: DataFrame, quote_col: str = "freight_quote_id") -> DataFrame:
    """Best option by dominance, else by score.

    Valid options have a finite ``carrier_deadline > 0`` and a finite ``price >= 0``. If one
    valid option has both the minimum deadline and the minimum price it
    wins; otherwise the lowest ``deadline / min_deadline + price / min_price``
    wins (a minimum price of 0 counts as 1). Ties: first in line order.

    Of the options of one quote with one carrier deadline only the cheapest
    (first in line order) can win, by either rule. That cut combines map-side
    and is dealt by (quote, deadline): a quote with a third of all options is
    read by many tasks and leaves as many rows as it has distinct deadlines
    (days). Only those rows are reduced to minima, joined with them on the
    quote and reduced to the winner.
    Output: ``quote_col, line_index, carrier_deadline, price, by_dominance``.
    """
    valid = (options
             .select(quote_col, "line_index",
                     F.col("carrier_deadline").try_cast("double").alias("cd"),
                     F.col("price").try_cast("double").alias("p"))
             .where((F.col("cd") > 0) & (F.col("cd") < float("inf")) & (F.col("p") >= 0) & (F.col("p") < float("inf"))))
    cheapest = (valid.groupBy(quote_col, "cd").agg(F.min(F.struct("p", "line_index")).alias("c"))
                .select(quote_col, "cd", "c.p", "c.line_index"))
    minima = cheapest.groupBy(quote_col).agg(F.min("cd").alias("min_cd"), F.min("p").alias("min_p"))
    scored = cheapest.join(minima, quote_col)
    dominant = (F.col("cd") == F.col("min_cd")) & (F.col("p") == F.col("min_p"))
    denom_p = F.when(F.col("min_p") == 0, F.lit(1.0)).otherwise(F.col("min_p"))
    score = F.col("cd") / F.col("min_cd") + F.col("p") / denom_p
    key = F.struct(
        F.when(dominant, 0).otherwise(1).alias("k"),
        F.when(dominant, F.lit(0.0)).otherwise(score).alias("s"),
        F.col("line_index").alias("i"),
        F.col("cd").alias("cd"),
        F.col("p").alias("p"),
    )
    best = scored.groupBy(quote_col).agg(F.min(key).alias("b"))
    return best.select(
        quote_col,
        F.col("b.i").alias("line_index"),
        F.col("b.cd").alias("carrier_deadline"),
        F.col("b.p").alias("price"),
        (F.col("b.k") == 0).alias("by_dominance"),
    )


def distinct_product_lines(items: DataFrame, quote_col: str = "quote_id") -> tuple[DataFrame, DataFrame]:
    """A2 helper: distinct (quote, product) pairs (a null product is one line)
    and the number of lines per quote. Both are aggregations (no window), so
    a quote with a huge cart is counted with map-side partial counts.
    """
    pairs = items.select(F.col(quote_col).alias("_q"), "product_id").distinct()
    counts = pairs.groupBy("_q").agg(F.count(F.lit(1)).alias("n_lines"))
    return pairs, counts


def product_lines(parent_ids: DataFrame, items: DataFrame, item_key: str = "quote_id") -> DataFrame:
    """A2 lines: ``(_q, product_id, n_lines)`` for the parents' items (to be
    inner-joined with the parents); a parent of ``parent_ids`` (column
    ``_q``) without items gets one line with a null product and
    ``n_lines = 1``.

    Only the id column of the parents is read twice (for the anti branch),
    so the parents' own attributes are computed once by the caller.
    """
    pairs, counts = distinct_product_lines(items, item_key)
    # pairs of parents outside ``parent_ids`` are dropped by the caller's inner
    # join with the parents, so no semi join is needed here
    lined = pairs.join(counts, "_q", "inner")
    empty = (parent_ids.join(counts, "_q", "left_anti")
             .select("_q", F.lit(None).cast(pairs.schema["product_id"].dataType).alias("product_id"),
                     F.lit(1).cast("bigint").alias("n_lines")))
    return lined.select("_q", "product_id", "n_lines").unionByName(empty)


def allocate_evenly(parents: DataFrame, items: DataFrame, parent_key: str,
                    value_cols: Iterable[str], item_key: str = "quote_id") -> DataFrame:
    """A2: spread each parent's values evenly over its distinct product lines.

    A parent without items keeps one line with a null product. Output: the
    parent columns plus ``product_id``, ``n_lines`` and ``<col>_share``.
    The skewed side (pairs) is inner-joined, so adaptive execution can
    split a hot parent; parents without lines come through an anti branch.
    """
    lines = product_lines(parents.select(F.col(parent_key).alias("_q")), items, item_key)
    out = parents.join(lines, parents[parent_key] == lines["_q"], "inner").drop("_q")
    for c in value_cols:
        out = out.withColumn(f"{c}_share", F.col(c).try_cast("double") / F.col("n_lines"))
    return out


def order_per_quote(orders: DataFrame) -> DataFrame:
    """J15 input: one freight order per (company, quote id) — the last one
    (highest order id). Output ``company_id, quote_id, freight_amount``.
    """
    last = orders.groupBy("company_id", "quote_id").agg(
        F.max(F.struct(F.col("id").alias("i"),
                       F.col("freight_amount").try_cast("double").alias("a"))).alias("o"))
    return last.select("company_id", "quote_id", F.col("o.a").alias("freight_amount"))


def quote_day(quotes: DataFrame, zone: str = "America/Sao_Paulo") -> Column:
    """The quote's local day: its stored ``date``, else ``quoted_at`` in ``zone``."""
    return F.coalesce(F.col("date").cast("date"), local_date(F.col("quoted_at"), zone))


def _day_scan(days: list[dt.date]) -> Column:
    """A filter for the scan that keeps every quote of ``days`` (and some
    more): the stored day, or for quotes without one a ``quoted_at`` no
    further from the days than any zone is from UTC."""
    if not days:
        return F.lit(False)
    low, high = min(days) - dt.timedelta(days=1), max(days) + dt.timedelta(days=2)
    near = (F.col("quoted_at") >= F.lit(low)) & (F.col("quoted_at") < F.lit(high))
    return F.col("date").cast("date").isin(days) | (F.col("date").isNull() & near)


def _to_num(c: Column) -> Column:
    """Reference ``toNum``: null or non-finite → 0."""
    d = c.try_cast("double")
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(0.0)).otherwise(d)


def freight_rollup(quotes: DataFrame, options: DataFrame, items: DataFrame, orders: DataFrame,
                   days: Iterable[str] | None = None, company_id: int | None = None,
                   zone: str = "America/Sao_Paulo") -> DataFrame:
    """A1: daily freight rollup for every company and day in one job.

    Per (company, day, channel, state, freight range, deadline bucket,
    courier, product):

    * ``total_simulations`` — number of (quote, product line) pairs;
    * ``total_orders`` — those pairs whose quote has a freight order;
    * ``total_value_simulations`` — Σ invoice value / lines of the quote;
    * ``total_value_orders`` — Σ freight amount / lines (0 without order).

    ``days`` (ISO dates) and ``company_id`` restrict the slice, as the
    command-line arguments do. Stored dates and a range of ``quoted_at``
    reach the quote scan; options, items and orders are cut to the chosen
    quotes (semi joins) before they are aggregated.
    """
    if days is not None:
        days = [dt.date.fromisoformat(d) for d in days]
        quotes = quotes.where(_day_scan(days))
    q = quotes.select(
        F.col("id").alias("qid"),
        F.col("company_id"),
        quote_day(quotes, zone).alias("date"),
        F.coalesce(F.trim(F.col("channel")), F.lit("")).alias("channel"),
        F.coalesce(F.upper(F.trim(F.nullif(F.col("destination_state"), F.lit("")))), F.lit("")).alias("state"),
        F.col("quote_id").alias("partner_quote_id"),
        _to_num(F.col("invoice_value")).alias("invoice_value"),
    ).where(F.col("date").isNotNull())
    if company_id is not None:
        q = q.where(F.col("company_id") == F.lit(company_id))
    if days is not None:
        q = q.where(F.col("date").isin(days))
    if days is not None or company_id is not None:
        options = options.join(q.select(F.col("qid").alias("freight_quote_id")), "freight_quote_id", "left_semi")
        items = items.join(q.select(F.col("qid").alias("quote_id")), "quote_id", "left_semi")
        orders = orders.join(q.select("company_id", F.col("partner_quote_id").alias("quote_id")),
                             ["company_id", "quote_id"], "left_semi")

    best = cheapest_option(options, "freight_quote_id")
    best = best.select(
        F.col("freight_quote_id").alias("bq"),
        freight_range(F.col("shipping_value")).alias("freight_range"),
        deadline_bucket(F.col("deadline")).alias("deadline_bucket"),
        F.coalesce(F.trim(F.col("carrier")), F.lit("")).alias("courier"),
    )
    ords = order_per_quote(orders).select(
        F.col("company_id").alias("oc"), F.col("quote_id").alias("oq"),
        _to_num(F.col("freight_amount")).alias("freight_amount"))

    attrs = (q.join(best, q["qid"] == best["bq"], "left")
             .join(ords, (q["company_id"] == ords["oc"]) & (q["partner_quote_id"] == ords["oq"]), "left")
             .select("qid", "company_id", "date", "channel", "state", "invoice_value",
                     F.coalesce("freight_range", F.lit(None).cast("string")).alias("freight_range"),
                     "deadline_bucket",
                     F.coalesce(F.col("courier"), F.lit("")).alias("courier"),
                     F.col("oq").isNotNull().alias("has_order"),
                     F.when(F.col("oq").isNotNull(), F.col("freight_amount")).otherwise(F.lit(0.0))
                     .alias("order_value")))

    lines = allocate_evenly(attrs, items, "qid", ["invoice_value", "order_value"], item_key="quote_id")
    return lines.groupBy(*ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("total_simulations"),
        F.count_if(F.col("has_order")).alias("total_orders"),
        F.sum("invoice_value_share").alias("total_value_simulations"),
        F.sum("order_value_share").alias("total_value_orders"),
    )


def rollup_in_portions(quotes: DataFrame, options: DataFrame, items: DataFrame, orders: DataFrame,
                       quotes_each: int = QUOTES_A_PORTION) -> DataFrame:
    """A1 (all of ``quotes``) on disks that do not hold the shuffles of all
    quotes at once. Quotes are dealt by the hash of their id to portions of
    about ``quotes_each``; options and items of a portion are known from their
    own rows, before any shuffle. Every measure is a sum over (quote, line)
    pairs, and a quote is in one portion, so the portions' rollups add up. Each
    is written, its shuffle files go, and the next one begins.
    """
    n = -(-quotes.count() // quotes_each)
    if n <= 1:
        return freight_rollup(quotes, options, items, orders)

    def portion(df: DataFrame, key: str, i: int) -> DataFrame:
        return df.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)) == i)

    parts = [write_once(freight_rollup(portion(quotes, "id", i), portion(options, "freight_quote_id", i),
                                       portion(items, "quote_id", i), orders), "rollup-portion") for i in range(n)]
    return reduce(DataFrame.unionByName, parts).groupBy(*ROLLUP_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("total_simulations", "total_orders", "total_value_simulations", "total_value_orders")])


def rollup_to_sink(rollup: DataFrame) -> DataFrame:
    """Cast the rollup to the stored column types (numeric(18,2), int)."""
    return rollup.select(
        F.col("company_id").cast("int"), F.col("date").cast("date"),
        "channel", "state", "freight_range", "deadline_bucket", "courier",
        F.col("product_id").cast("int"),
        F.col("total_simulations").cast("int"), F.col("total_orders").cast("int"),
        F.col("total_value_simulations").cast("decimal(18,2)"),
        F.col("total_value_orders").cast("decimal(18,2)"),
    )
