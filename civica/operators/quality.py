"""Data-quality operators (Q1-Q7)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civica.operators.columns import require_columns  # noqa: F401  (Q3)
from civica.operators.rows import not_in  # noqa: F401  (Q7)


def profile(df: DataFrame, stage: str) -> DataFrame:
    """Q1: shape and null count of every column at a pipeline stage, from
    one aggregate pass.  Each call is an action when collected, so it is
    meant for opt-in diagnostics, not the hot path."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__z{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__z{i}").alias("n_null"))
                      for i, c in enumerate(cols)])
    return wide.select(F.lit(stage).alias("stage"), F.col("__n").alias("n_rows"),
                       F.lit(len(cols)).alias("n_columns"), F.inline(pairs))


class Profiles:
    """Q1 in passing: the rows of ``profile`` for every watched stage, counted
    while the stage's own write runs, so that nothing is read again.

    ``watch`` is put on a frame just before it is written; ``rows`` waits for
    that write.  Counts are taken in the write's last stage, where a task that
    is run again counts once.  A stage watched twice is an error."""

    def __init__(self) -> None:
        self._stages: dict[str, tuple[list[str], Observation]] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        if stage in self._stages:
            raise ValueError(f"stage {stage!r} is watched already")
        seen = Observation(f"{stage}-{uuid.uuid4().hex[:8]}")
        self._stages[stage] = (df.columns, seen)
        return df.observe(seen, F.count(F.lit(1)).alias("n"),
                          *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])

    def rows(self, spark: SparkSession) -> DataFrame:
        out = []
        for stage, (cols, seen) in self._stages.items():
            got = seen.get
            out += [(stage, got["n"], len(cols), c, got["n"] - got[f"c{i}"]) for i, c in enumerate(cols)]
        return spark.createDataFrame(out, "stage string, n_rows long, n_columns int, column_name string, n_null long")


def range_check(df: DataFrame, keys: Sequence[str], value: str, lo: float = 95.0, hi: float = 105.0,
                out: str = "total") -> DataFrame:
    """Q2: per key, the total of ``value`` and whether it lies in [lo, hi]."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out)) \
             .withColumn("in_range", F.col(out).between(lo, hi))


def ensure_not_empty(df: DataFrame, what: str = "training frame") -> DataFrame:
    """Q4: fail early on an empty input (one ``LIMIT 1`` job)."""
    if df.isEmpty():
        raise ValueError(f"the {what} is empty after preprocessing")
    return df


def min_history(df: DataFrame, series: Sequence[str], value: str, n: int = 3,
                out: str = "n_points") -> DataFrame:
    """Q5: series with at least ``n`` non-null points, with their count."""
    return df.groupBy(*series).agg(F.count(value).alias(out)).where(F.col(out) >= n)


def with_min_history(df: DataFrame, series: Sequence[str], value: str, n: int = 3) -> DataFrame:
    """Q5: keep the rows of series with enough history (semi join on the
    aggregated series list)."""
    return df.join(min_history(df, series, value, n).select(*series), list(series), "left_semi")


def duplicate_keys(df: DataFrame, key: Sequence[str], check: str) -> DataFrame:
    """Q6: number of key values held by more than one row."""
    d = df.groupBy(*key).count().where(F.col("count") > 1)
    return d.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(check).alias("check_name"), "n_violations")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, check: str) -> DataFrame:
    """Q6: child rows whose non-null foreign key has no parent (anti join)."""
    o = child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return o.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(check).alias("check_name"), "n_violations")


def constraint_audit(checks: Sequence[DataFrame]) -> DataFrame:
    """Q6: union of primary-key and foreign-key checks; Spark does not
    enforce declared constraints, so they are audited instead."""
    return reduce(lambda a, b: a.unionByName(b), checks)
