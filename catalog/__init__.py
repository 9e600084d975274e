"""Every operator as a query over the given tables, with its SQL twin."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightloom.runtime import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ["scans", "projection", "joining", "statistics", "sequences", "scalars",
            "texts", "modelling", "forecasting", "streams"]


def entry(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")

    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
