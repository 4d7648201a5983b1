"""Name to query, and name to checking SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemorph.session import configure
from telemorph.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = [
    "scan_queries", "row_queries", "metric_queries", "field_queries", "retention_queries",
    "document_queries", "builder_queries", "request_queries", "construct_queries",
]


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"telemorph.queries.{module}")
