"""ERP order assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.parse import half_up, to_int_loose, to_number_loose


def group_rows_into_orders(rows: DataFrame, key_col: str, item_order_col: str, synced_col: str,
                           header_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A3: one order per mapped external id. Rows with a blank key are
    dropped (returned second, for the counter). The order's version is the
    greatest ``synced_col`` of its rows; header fields come from its first
    row in item-external-id order (a map-side ``min``, no group collection)."""
    k = F.trim(F.col(key_col).cast("string"))
    keyed = rows.withColumn("_k", k)
    blank = keyed.where(F.col("_k").isNull() | (F.col("_k") == "")).drop("_k")
    good = keyed.where(F.col("_k") != "")
    first = F.min(F.struct(F.col(item_order_col).alias("_o"), F.struct(*header_cols).alias("_h")))
    g = good.groupBy("_k").agg(first.alias("_f"), F.max(synced_col).alias("version"),
                               F.count(F.lit(1)).alias("n_rows"))
    return g.select(F.col("_k").alias("external_id"), *[F.col(f"_f._h.{c}").alias(c) for c in header_cols],
                    "version", "n_rows"), blank


def order_total_from_lines(lines: DataFrame, key_col: str, qty_col: str, price_col: str) -> DataFrame:
    """A4: Σ int(qty) × round(price, 2) per order (duplicated lines count
    twice), added as decimals; null when no line has both numbers."""
    q = to_int_loose(F.col(qty_col).cast("string")).cast("decimal(18,0)")
    p = half_up(to_number_loose(F.col(price_col).cast("string")), 2).try_cast("decimal(18,2)")
    return lines.groupBy(key_col).agg(F.sum((q * p).cast("decimal(28,2)")).cast("double").alias("total_from_lines"))


def shipment_summary(shipments: DataFrame, order_col: str, promised_col: str, delivered_col: str,
                     delta_col: str, value_col: str) -> DataFrame:
    """A5: per freight order — latest promised date, latest delivery date,
    greatest delta and Σ product value (null when no value)."""
    return shipments.groupBy(order_col).agg(
        F.max(promised_col).alias("promised_date"), F.max(delivered_col).alias("delivery_date"),
        F.max(delta_col).alias("max_delta"), F.sum(value_col).alias("products_value"))


def timeline_summary(events: DataFrame, order_col: str, date_col: str, hour_col: str, desc_col: str,
                     seq_col: str, delivered_word: str = "entregue") -> DataFrame:
    """First dated entry (date, hour) in timeline order, earliest date,
    and the last date whose description is the delivered word."""
    dated = events.where(F.col(date_col).isNotNull() & (F.trim(F.col(date_col).cast("string")) != ""))
    is_del = F.lower(F.trim(F.col(desc_col))) == delivered_word
    return dated.groupBy(order_col).agg(
        F.min_by(F.struct(F.col(date_col).alias("date"), F.col(hour_col).alias("hour")), F.col(seq_col)).alias("first"),
        F.min(date_col).alias("min_date"),
        F.max_by(F.col(date_col), F.when(is_del, F.col(seq_col))).alias("delivered_date"),
    ).select(order_col, F.col("first.date").alias("first_date"), F.col("first.hour").alias("first_hour"),
             "min_date", "delivered_date")


def version_filter(incoming: DataFrame, stored: DataFrame, keys: Sequence[str], version_col: str,
                   stored_version_col: str = "stored_version") -> DataFrame:
    """Drop incoming groups whose version is not newer than the stored
    one; when either version is unknown the row passes."""
    s = stored.select(*keys, F.col(version_col).alias(stored_version_col))
    j = incoming.join(s, list(keys), "left")
    skip = F.col(version_col).isNotNull() & F.col(stored_version_col).isNotNull() \
        & (F.col(version_col) <= F.col(stored_version_col))
    return j.where(~skip).drop(stored_version_col)


def commission(item_value: Column | None, order_value: Column | None) -> Column:
    """Item-level mapping, else order-level, else '0'."""
    parts = [c.cast("string") for c in (item_value, order_value) if c is not None]
    return F.coalesce(*parts, F.lit("0"))


def order_level_commission(raw: Column) -> Column:
    """I17 (order level): N2 at 6 decimals, '0' when unparsable."""
    n = to_number_loose(raw.cast("string"))
    return F.coalesce(half_up(n, 6).cast("decimal(38,6)").cast("string"), F.lit("0"))
