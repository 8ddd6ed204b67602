"""All registered queries and their comparison SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["feed_queries", "fold_queries", "type_queries", "schema_queries", "metric_queries", "sink_queries"]


def collect(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"feedfold.plans.{name}"), attribute)
        clash = found.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        found.update(part)
    return found
