"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import importlib

# Operator modules by their number.
MODULES = ("decontaminate", "lmscore", "urlrules", "quality", "packing", "toxicity", "tokens", "jaccard", "vectors",
           "licences", "resample", "repeats", "prefixes")


def _merged(what: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(importlib.import_module(f"intactly.llm.{name}"), what))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
