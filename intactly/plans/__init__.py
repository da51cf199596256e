"""Query catalogue: every registered query and its DuckDB oracle."""

from __future__ import annotations

import importlib

# Plan modules in catalogue order.
_MODULES = ("integrity", "manifest", "publish", "ingest", "olap", "model", "incremental")


def _load():
    queries, sql = {}, {}
    for name in _MODULES:
        module = importlib.import_module(f"intactly.plans.{name}")
        queries.update(module.QUERIES)
        sql.update(module.SQL)
    return queries, sql


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
