"""Bindings: the driver's test tables turned into operator inputs.

These are fixture definitions (FIXTURES.md §2), not operators. Each
binding is lazy and reads whole tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.sources.tables import Tables

# Line order used wherever "arrival order" of lineitem rows matters:
# (l_orderkey, l_linenumber) is not unique, so every column takes part.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def with_line_index(lineitem: DataFrame) -> DataFrame:
    """Positional index of each line inside its order (1-based), computed
    with range-partitioned prefix counts so a huge order is split across
    tasks (identical duplicate lines are interchangeable)."""
    from cargolens.operators.running import row_number_within
    return row_number_within(lineitem, ["l_orderkey"], [F.col(c) for c in LINE_ORDER], "line_index")


def tenant(t: Tables) -> DataFrame:
    """customer → (c_custkey, company_id, state); nation is a 25-row table."""
    return (t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("n_regionkey").alias("company_id"),
                    F.concat(F.lit("S"), (F.col("n_nationkey") % 3).cast("string")).alias("state")))


def tenant_orders(t: Tables) -> DataFrame:
    return t.orders.join(tenant(t), F.col("o_custkey") == F.col("c_custkey"))


def freight_quotes(t: Tables) -> DataFrame:
    o = tenant_orders(t)
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("company_id"),
        F.date_trunc("year", F.col("o_orderdate")).cast("date").alias("date"),
        F.col("o_orderdate").alias("quoted_at"),
        F.col("o_orderpriority").alias("channel"),
        F.col("state").alias("destination_state"),
        F.col("o_orderkey").cast("string").alias("quote_id"),
        F.col("o_totalprice").alias("invoice_value"),
    )


def freight_options(t: Tables) -> DataFrame:
    li = with_line_index(t.lineitem)
    shipping = (F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), F.lit(None).cast("double"))
                .when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.lit(0.0))
                .when(F.col("l_orderkey") % 97 == 0, F.col("l_extendedprice"))
                .otherwise(F.floor(F.col("l_extendedprice") * 2) / 100))
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("line_index")).alias("id"),
        F.col("l_orderkey").alias("freight_quote_id"),
        F.col("line_index"),
        shipping.cast("double").alias("shipping_value"),
        (F.col("l_quantity").cast("int") + 3 * (F.col("l_linenumber") - 1)).alias("deadline"),
        F.concat(F.lit(" CARRIER_"), (F.col("l_suppkey") % 4).cast("string"), F.lit(" ")).alias("carrier"),
    )


def freight_items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("quote_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_partkey") % 5).alias("product_id"),
    )


def freight_orders(t: Tables) -> DataFrame:
    o = tenant_orders(t).where(F.col("o_orderstatus") == "F")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("company_id"),
        F.col("o_orderkey").cast("string").alias("quote_id"),
        (F.floor(F.col("o_totalprice") * 5) / 100).alias("freight_amount"),
    )


def w2_options(t: Tables) -> DataFrame:
    """W2 binding: deadline = l_quantity % 10 (0 invalid), price 0 on line 1."""
    li = with_line_index(t.lineitem)
    return li.select(
        F.col("l_orderkey").alias("freight_quote_id"),
        F.col("line_index"),
        (F.col("l_quantity") % 10).alias("carrier_deadline"),
        F.when(F.col("l_linenumber") == 1, F.lit(0.0))
        .otherwise(F.floor(F.col("l_extendedprice") * 2) / 100).alias("price"),
    )
