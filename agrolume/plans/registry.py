"""Key -> (Spark builder, oracle SQL) registry behind the driver contract."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from agrolume.plans.world import World, with_tables

Builder = Callable[[World], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    build: Builder
    oracle: str | None
    tables: tuple[str, ...] = ()


REGISTRY: dict[str, Query] = {}


def query(key: str, oracle: str | None = None, *, tables: str = "") -> Callable[[Builder], Builder]:
    """Register ``fn(world)`` under ``key``.

    ``oracle`` is the DuckDB statement (or its tail, when ``tables`` names the
    derived tables that must be put in front of it as common table expressions).
    """

    def register(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key: {key}")
        REGISTRY[key] = Query(key, fn, oracle, tuple(tables.split()))
        return fn

    return register


def as_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(entry: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: entry.build(World(spark, sf_dir))

    return {key: bind(entry) for key, entry in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {
        key: with_tables(list(entry.tables), entry.oracle)
        for key, entry in REGISTRY.items()
        if entry.oracle is not None
    }
