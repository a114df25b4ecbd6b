"""Collects the query modules of this package into one registry."""

from __future__ import annotations

from importlib import import_module

#: Query modules; each has QUERIES (name -> callable) and ORACLES (name -> SQL).
MODULES = ("vector_queries", "relational_queries", "scalar_queries", "interval_queries", "quality_queries", "workflow_queries", "analysis_queries", "evaluation_queries")


def _merged(attribute: str) -> dict:
    found: dict = {}
    for module in MODULES:
        part = getattr(import_module(f"{__package__}.{module}"), attribute)
        clash = found.keys() & part.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        found.update(part)
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLES")
