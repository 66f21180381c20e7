"""Profiles, counters and run audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def source_profile(df: DataFrame, key_col: str, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys, date range and rows without key — one pass
    (optionally per ``by`` group)."""
    k = F.trim(F.col(key_col).cast("string"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(F.when(k != "", k)).alias("distinct_keys"),
                  F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.count_if(k.isNull() | (k == "")).alias("rows_without_key"))


def run_counters(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Named counters (inserted, updated, skipped, …) in one aggregate."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def high_water_mark(df: DataFrame, ts_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Greatest processed timestamp (per key)."""
    return (df.groupBy(*keys) if keys else df.groupBy()).agg(F.max(ts_col).alias("high_water_mark"))


def missing_field_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A10: the columns with at least one null/blank value, with counts
    (an aggregate of counters, then unpivot)."""
    blanks = [F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(c) for c in columns]
    counts = df.agg(*blanks)
    long = counts.unpivot([], list(columns), "field", "missing")
    return long.where(F.col("missing") > 0)


def next_numeric_code(df: DataFrame, code_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """1 + the greatest code that is all digits (a number, not a text max)."""
    c = F.trim(F.col(code_col).cast("string"))
    n = F.when(c.rlike(r"^\d+$"), c.try_cast("bigint"))
    return (df.groupBy(*keys) if keys else df.groupBy()).agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("next_code"))


def pending_days(df: DataFrame, ts_col: str, need: Column, zone: str = "America/Sao_Paulo") -> DataFrame:
    """Distinct local days that still have rows to backfill, sorted."""
    d = F.date_format(F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), zone), "yyyy-MM-dd")
    return df.where(need).select(d.alias("day")).distinct().orderBy("day")


def observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Attach run counters to a DataFrame without a second pass;
    ``obs.get`` holds them after the write action."""
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs


def audit_row(spark, company_id: int, entity: str, status: str, counters: dict, started_at: dt.datetime,
              finished_at: dt.datetime | None = None, errors: str | None = None) -> DataFrame:
    """One run-audit row (PROCESSANDO → FINALIZADO / ERRO) to append to
    the run-metrics table."""
    import json
    return spark.createDataFrame(
        [(company_id, entity, status, json.dumps(counters, default=str), errors, started_at, finished_at)],
        "company_id long, entity string, status string, counters string, errors string, "
        "started_at timestamp, finished_at timestamp")


# --- set operations ------------------------------------------------------------------

def key_set_union(*key_sets: DataFrame) -> DataFrame:
    """Distinct union of lookup key sets."""
    u = key_sets[0]
    for k in key_sets[1:]:
        u = u.unionByName(k)
    return u.distinct()


def date_spine(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """U4: every day from start to end inclusive, per bounds row; a reversed
    range is an error."""
    s, e = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    until = F.when(s > e, F.raise_error(F.lit("date range reversed")).cast("date")).otherwise(e)
    return bounds.select("*", F.explode(F.sequence(s, until)).alias("day"))


def date_chunks(bounds: DataFrame, start_col: str, end_col: str, days: int) -> DataFrame:
    """[start, end] cut into chunks of at most ``days`` days (a reversed
    range is swapped first)."""
    s0, e0 = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    s, e = F.least(s0, e0), F.greatest(s0, e0)
    starts = F.sequence(s, e, F.expr(f"INTERVAL {days} DAYS"))
    ex = bounds.select("*", F.explode(starts).alias("chunk_start"))
    return ex.withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1),
                                              F.greatest(F.col(start_col).cast("date"), F.col(end_col).cast("date"))))


def relative_windows(as_of: Column) -> dict[str, Column]:
    """The scheduler's windows computed from an explicit ``as_of``
    instant (never the clock)."""
    sp_day = F.to_date(F.from_utc_timestamp(as_of.cast("timestamp"), "America/Sao_Paulo"))
    utc_day = F.to_date(as_of.cast("timestamp"))
    return {
        "yesterday_sao_paulo": F.date_sub(sp_day, 1),
        "utc_yesterday": F.date_sub(utc_day, 1), "utc_today": utc_day,
        "recent_start": F.date_sub(utc_day, 2),
        "ahead_start": F.date_sub(utc_day, 1), "ahead_end": F.date_add(utc_day, 30),
    }
