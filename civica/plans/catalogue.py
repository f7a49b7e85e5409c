"""The query catalogue: every registered query and its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civica.plans import q_aggregates, q_io, q_joins, q_models, q_tables  # noqa: F401  (register queries)
from civica.plans.registry import REGISTRY


def _utc(build):
    """Catalogue semantics (years of timestamps) are defined in UTC."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)
    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _utc(q.build) for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql}
