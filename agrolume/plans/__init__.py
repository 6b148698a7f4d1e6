"""Derived tables, registered queries and their oracles."""

from __future__ import annotations

from importlib import import_module

QUERY_MODULES = (
    "pixel_queries",
    "zonal_queries",
    "selection_queries",
    "temporal_queries",
    "composite_queries",
    "geo_queries",
    "source_queries",
    "catalog_queries",
    "readiness_queries",
    "stream_queries",
)


def load() -> None:
    """Import every query module so the registry is filled."""
    for name in QUERY_MODULES:
        import_module(f"agrolume.plans.{name}")
