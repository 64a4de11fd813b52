"""Registered queries: one per operator of the inventory, each with its DuckDB twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on the driver's test tables
through the raw-layer mapping of ``cardmart.sources.driver_tables``.
``ORACLE[name]`` is independent SQL over the same parquet views (with the
mapping written as CTEs in ``oracle_views``).  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name`` with an optional oracle SQL twin."""
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from cardmart.plans import (  # noqa: F401
        queries_answers, queries_landing, queries_ledger, queries_loads, queries_relational, queries_respond, queries_streaming, queries_text, queries_vectors)
