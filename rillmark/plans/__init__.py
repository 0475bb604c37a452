"""Registered queries over the driver tables."""

from __future__ import annotations

from importlib import import_module

from rillmark.registry import QUERIES, Query

SECTIONS = ["sources_sinks", "scalars", "composition", "aggregates", "ordered", "policies", "eventlog", "streaming"]


def all_queries() -> dict[str, Query]:
    for section in SECTIONS:
        import_module(f"rillmark.plans.{section}")
    return dict(QUERIES)
