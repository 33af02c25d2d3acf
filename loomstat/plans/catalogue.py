"""All queries of the library; importing the modules registers them."""

from __future__ import annotations

import importlib

from .registry import ORACLE_SQL, QUERIES

for _name in ("registry_queries", "evidence_queries", "planning_queries", "expression_queries", "source_queries", "scale_queries", "profile_queries", "bulk_queries"):
    importlib.import_module(f"{__package__}.{_name}")


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL
