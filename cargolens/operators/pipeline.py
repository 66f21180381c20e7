"""Entity dependency order (I18) and audited runs.

The source system syncs one company's entities in a fixed order so that
later entities resolve references against fresh snapshots: reps →
customer groups → customers → products → orders. Here the order is a plain
function passing DataFrames; every company runs in the same job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.operators.audit import observed
from cargolens.operators.lookup import keyed_dimension, lookup
from cargolens.operators.upsert import upsert

ENTITY_ORDER = ["representatives", "customers_group", "customers", "products", "orders"]


def sync_entities(stored: Mapping[str, DataFrame], incoming: Mapping[str, DataFrame],
                  keys: Mapping[str, list[str]]) -> dict[str, DataFrame]:
    """Upsert every entity in dependency order; returns the new
    snapshots (entities without incoming rows are kept as stored)."""
    out: dict[str, DataFrame] = {}
    for name in ENTITY_ORDER:
        if name not in stored and name not in incoming:
            continue
        if name in incoming and name in stored:
            out[name] = upsert(stored[name], incoming[name], keys[name]).drop("_action")
        else:
            out[name] = stored.get(name, incoming.get(name))
    return out


def resolve_item_refs(items: DataFrame, snapshots: Mapping[str, DataFrame],
                      refs: Mapping[str, tuple[Column, str, str]]) -> DataFrame:
    """Resolve item references against the (fresh) snapshots: ``refs`` maps
    output column → (probe key, entity, key column)."""
    out = items
    for col, (probe, entity, key_col) in refs.items():
        dim = keyed_dimension(snapshots[entity], F.col(key_col).cast("string"), key_col)
        out = lookup(out, probe.cast("string"), dim, {key_col: col})
    return out


def audited_write(spark: SparkSession, df: DataFrame, write, company_id: int, entity: str,
                  metrics: Mapping[str, Column], record: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Run ``write(df)`` with counters observed in the same pass and
    return the audit row. ``record`` is given a PROCESSANDO row before the
    write and the closing row after it: FINALIZADO, or ERRO with the error,
    which is then raised again."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def audit_row(status: str, counters: Mapping[str, int], err: str | None, finished: dt.datetime | None) -> DataFrame:
        row = spark.createDataFrame(
            [(company_id, entity, status, {k: int(v) for k, v in counters.items()}, err, started, finished)],
            "company_id long, entity string, status string, counters map<string,bigint>, errors string, "
            "started_at timestamp_ntz, finished_at timestamp_ntz")
        if record is not None:
            record(row)
        return row

    audit_row("PROCESSANDO", {}, None, None)
    obs_df, obs = observed(df, f"audit_{entity}", dict(metrics))
    try:
        write(obs_df)
    except Exception as e:
        audit_row("ERRO", {}, f"{type(e).__name__}: {e}", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        raise
    return audit_row("FINALIZADO", obs.get, None, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
