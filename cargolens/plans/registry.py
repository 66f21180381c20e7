"""Query registry: every operator is exposed as a named query over the
test tables, with (where SQL can express it) an equivalent DuckDB query.

A query is ``fn(spark, sf_dir) -> DataFrame``. Oracle SQL runs on views
named after the test tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` as query ``name`` with an optional oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that the decorators run."""
    from cargolens.plans import (  # noqa: F401
        q_freight,
        q_norm,
        q_status,
        q_rank,
        q_join,
        q_stock,
        q_upsert,
        q_incr,
        q_mapping,
        q_payload,
        q_staged,
        q_stream,
        q_pipeline,
        q_keys,
    )
