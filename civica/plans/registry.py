"""Registry of catalogue queries and their independent SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    ids: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register ``build(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB text computing the same result from the raw
    tables (``None`` when the operator is not expressible in SQL)."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, ids, fn, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
