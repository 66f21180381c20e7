"""Booking procedure lines (W8) — the discount waterfall (W7) is in
``running.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.functions.parse import finite, js_number, money_2


def clean_lines(lines: DataFrame) -> DataFrame:
    """Typed id, name, value (cents-rounded) and quantity (default 1); lines
    with an id of 0 or less or without a name go."""
    qty = finite(js_number(F.coalesce(F.col("quantity").cast("string"), F.lit("1"))))
    return (lines
            .withColumn("id", F.coalesce(finite(js_number(F.col("id").cast("string"))), F.lit(0.0)).cast("bigint"))
            .withColumn("name", F.coalesce(F.col("name").cast("string"), F.lit("")))
            .withColumn("value", money_2(F.col("value_text")))
            .withColumn("quantity", F.when(qty.isNull() | (qty == 0), F.lit(1)).otherwise(qty).cast("bigint"))
            .where((F.col("id") > 0) & (F.col("name") != "")))


def choose_procedures(event_lines: DataFrame, tx_lines: DataFrame, tx_bookings: DataFrame,
                      key: str = "booking_id") -> DataFrame:
    """A booking's procedures come from its transaction when it has one
    (deleted lines dropped), else from the event; lines with id ≤ 0 or no
    name are dropped; quantity defaults to 1; money is rounded to cents.

    Inputs carry ``key, line_index, id, name, value_text, quantity`` (and
    ``deleted`` on the transaction side); ``tx_bookings`` lists the bookings
    whose transaction has content.
    """
    cols = [key, "line_index", "id", "name", "value", "quantity"]
    tx = clean_lines(tx_lines.where(~F.coalesce(F.col("deleted"), F.lit(False)))).select(*cols) \
        .withColumn("source", F.lit("transaction"))
    ev = event_lines.join(tx_bookings.select(key), key, "left_anti")
    ev = clean_lines(ev).select(*cols).withColumn("source", F.lit("event"))
    return tx.unionByName(ev)
