"""Incremental rules and backfills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.dates import brazil_date, brazil_time, date_hour_strict
from cargolens.operators.freight import best_option_score
from cargolens.operators.upsert import insert_if_absent


def watermark_filter(rows: DataFrame, control: DataFrame, keys: Sequence[str], synced_col: str | None,
                     cursor_col: str = "last_processed_at", force: bool = False) -> DataFrame:
    """Rows with ``synced_col`` after the stored cursor; rows pass when
    forced, when the cursor is unset or when the column is unmapped
    (``synced_col=None``). Once a cursor is set, a row without a timestamp
    does not pass."""
    if force or synced_col is None:
        return rows
    j = rows.join(control.select(*keys, cursor_col), list(keys), "left")
    ok = F.col(cursor_col).isNull() | (F.col(synced_col) > F.col(cursor_col))
    return j.where(ok).drop(cursor_col)


def changed_rows(incoming: DataFrame, stored: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """I4: incoming rows that are new or differ (null-safe) in a tracked field."""
    s = stored.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in tracked]).withColumn("_known", F.lit(True))
    j = incoming.join(s, list(keys), "left")
    diff = F.lit(False)
    for c in tracked:
        diff = diff | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return j.where(F.col("_known").isNull() | diff).select(*incoming.columns)


def lock_guard(new: Column, old: Column, locked: Column) -> Column:
    """A manually locked row keeps its stored value."""
    return F.when(F.coalesce(locked, F.lit(False)), old).otherwise(new)


def keep_or_fill(new: Column, old: Column, fill_only: bool = False) -> Column:
    """Never blank a stored value (``coalesce(new, old)``); with
    ``fill_only`` the stored value wins and the new one only fills a gap."""
    return F.coalesce(old, new) if fill_only else F.coalesce(new, old)


def order_date_cascade(*candidates: Column) -> Column:
    """I8: the first available of the candidate date columns, in order."""
    return F.coalesce(*candidates)


def order_dates(listing: DataFrame, details: DataFrame, known: DataFrame, key: str = "external_id") -> DataFrame:
    """I8: the date of every listed order, by a gated cascade.

    1. the marketplace's creation time, 2. list day with a valid hour. Orders
    without either that are not ``known`` (stored) go on, and only they meet
    ``details``: 3. the detail's creation time, 4. its day (else the list's)
    with its hour, 5. its modification time, 6. the list's. A known order
    without a date of its own keeps the stored one.

    ``listing``: key, created_sql, list_date, list_hour, modified;
    ``details``: key, created_sql, date, hour, modified (several rows of one
    key: the lowest); ``known``: key, order_date. Output: key, order_date.
    """
    from cargolens.operators.staging import sql_datetime
    first = F.coalesce(sql_datetime(F.col("created_sql")), date_hour_strict(F.col("list_date"), F.col("list_hour")))
    listed = listing.select(key, first.alias("_first"), "list_date", "modified")
    stored = known.select(key, F.col("order_date").alias("_stored"), F.lit(True).alias("_known"))
    one = details.groupBy(key).agg(F.min(F.struct("created_sql", "date", "hour", F.col("modified").alias("changed"))).alias("_d"))
    asked = (listed.where(F.col("_first").isNull()).join(stored, key, "left_anti").join(one, key, "left")
             .select(key, order_date_cascade(
                 sql_datetime(F.col("_d.created_sql")),
                 date_hour_strict(F.coalesce("_d.date", "list_date"), F.col("_d.hour")),
                 sql_datetime(F.col("_d.changed")), sql_datetime(F.col("modified"))).alias("order_date")))
    rest = (listed.join(stored, key, "left").where(F.col("_first").isNotNull() | F.col("_known"))
            .select(key, F.coalesce("_first", "_stored").alias("order_date")))
    return rest.unionByName(asked)


def should_write_order_date(stored: Column, new: Column) -> Column:
    """Write when nothing is stored, when the day differs, or when the
    stored time is midnight and the new one is not."""
    midnight = lambda c: F.date_format(c, "HH:mm:ss") == "00:00:00"
    return new.isNotNull() & (stored.isNull() | (F.to_date(stored) != F.to_date(new))
                              | (midnight(stored) & ~midnight(new)))


def backfill_local_datetime(df: DataFrame, ts_col: str, date_col: str, time_col: str,
                            company_col: str | None = None, company_id=None) -> DataFrame:
    """Fill local (Sao Paulo) date and time text where either is
    missing; optional restriction to one company."""
    need = F.col(date_col).isNull() | F.col(time_col).isNull()
    if company_col is not None and company_id is not None:
        need = need & (F.col(company_col) == F.lit(company_id))
    return (df.withColumn("_need", need)
            .withColumn(date_col, F.when(F.col("_need"), brazil_date(F.col(ts_col))).otherwise(F.col(date_col)))
            .withColumn(time_col, F.when(F.col("_need"), brazil_time(F.col(ts_col))).otherwise(F.col(time_col)))
            .drop("_need"))


def backfill_best_option(quotes: DataFrame, options: DataFrame, quote_key: str = "id",
                         deadline_col: str = "best_deadline", cost_col: str = "best_freight_cost") -> DataFrame:
    """Quotes missing either best field get W2's pick; no valid option
    leaves them null; quotes already complete are untouched, and their options
    leave before any is scored."""
    need = F.col(deadline_col).isNull() | F.col(cost_col).isNull()
    open_quotes = quotes.where(need).select(F.col(quote_key).alias("freight_quote_id"))
    best = best_option_score(options.join(open_quotes, "freight_quote_id", "left_semi"), "freight_quote_id").select(
        F.col("freight_quote_id").alias("_q"), F.col("carrier_deadline").alias("_bd"), F.col("price").alias("_bp"))
    j = quotes.join(best, quotes[quote_key] == best["_q"], "left").withColumn("_need", need)
    return (j.withColumn(deadline_col, F.when(F.col("_need"), F.col("_bd")).otherwise(F.col(deadline_col)))
            .withColumn(cost_col, F.when(F.col("_need"), F.col("_bp")).otherwise(F.col(cost_col)))
            .drop("_q", "_bd", "_bp", "_need"))


def options_from_stored_json(quotes: DataFrame, json_col: str, quote_key: str, option_schema: str) -> DataFrame:
    """Option rows from a quote's stored payload (a JSON array; anything
    else gives none), with their position as ``line_index``."""
    arr = F.from_json(F.col(json_col), f"array<{option_schema}>")
    return quotes.select(F.col(quote_key).alias("freight_quote_id"),
                         F.posexplode(F.when(F.trim(F.col(json_col)).startswith("["), arr)).alias("line_index", "o")) \
        .select("freight_quote_id", "line_index", "o.*")


def backfill_options(stored_options: DataFrame, quotes: DataFrame, json_col: str, quote_key: str,
                     option_schema: str) -> DataFrame:
    """Insert-or-ignore the parsed options on (quote, line_index)."""
    parsed = options_from_stored_json(quotes, json_col, quote_key, option_schema)
    return insert_if_absent(stored_options, parsed.select(*stored_options.columns),
                            ["freight_quote_id", "line_index"])


def missing_parents(children: DataFrame, parents: DataFrame, child_ref: str, parent_key: str) -> DataFrame:
    """Parent ids referenced by children but not stored (to fetch)."""
    refs = children.select(F.col(child_ref).alias(parent_key)).where(F.col(parent_key).isNotNull()).distinct()
    return refs.join(parents.select(parent_key), parent_key, "left_anti")


def freight_order_plan(incoming: DataFrame, stored: DataFrame, key: str, force: bool) -> DataFrame:
    """I16: stored freight orders are skipped unless forced; adds ``action``
    ('insert' / 'skip' / 'update')."""
    s = stored.select(F.col(key)).distinct().withColumn("_known", F.lit(True))
    j = incoming.join(s, key, "left")
    act = F.when(F.col("_known").isNull(), F.lit("insert")).otherwise(F.lit("update" if force else "skip"))
    return j.withColumn("action", act).drop("_known")
