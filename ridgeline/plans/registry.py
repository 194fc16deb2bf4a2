"""Registry of queries: each operator applied to the tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("peaks", "scalars", "joins", "aggregates", "windows", "ordering", "strings", "maths", "signals", "storage", "search", "models", "sources", "pixels")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with its SQL."""

    def keep(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"ridgeline.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(_SQL)
