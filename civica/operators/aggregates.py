"""Aggregations.

Every grouped aggregate here is algebraic (sum, count, min, max, avg,
min_by), so Spark computes partial aggregates before the shuffle and a hot
key costs one row per map task, not one task holding the whole group.
Global statistics are scalar subqueries (one small job, result inlined as
a literal) rather than cross joins or windows without a partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, count_col: str = "n") -> DataFrame:
    """A1: frequency per non-null value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count_col))


def group_sums(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """A2/A3: ``{out: column}`` sums per key.  Like pandas, a group whose
    values are all null sums to 0, and integer sums stay integers."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(o) for o, c in measures.items()])


def global_means(df: DataFrame, columns: Sequence[str]) -> Column:
    """A4: one scalar-subquery struct holding the mean of every column."""
    return df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()


def fill_global_mean(df: DataFrame, columns: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """M9: replace nulls by the column mean (of ``source``, default ``df``).
    All means come from one aggregate job."""
    if not columns:
        return df
    means = global_means(source if source is not None else df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), means[c]) for c in columns})


def masked_sum(df: DataFrame, value: str, mask: Column | None = None, out: str = "total",
               keys: Sequence[str] = ()) -> DataFrame:
    """A5: sum of ``value`` where ``mask`` holds; an empty selection is 0."""
    v = F.when(mask, F.col(value)) if mask is not None else F.col(value)
    return df.groupBy(*keys).agg(F.coalesce(F.sum(v), F.lit(0)).alias(out))


def extents(df: DataFrame, columns: Sequence[str] | str, keys: Sequence[str] = (),
            distinct: Sequence[str] = ()) -> DataFrame:
    """A6 (+A7 counts): minimum and maximum of each column, and the number
    of distinct values of ``distinct`` columns, in one aggregate."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    aggs = [f(c).alias(f"{p}_{c}") for c in cols for p, f in (("min", F.min), ("max", F.max))]
    aggs += [F.count_distinct(c).alias(f"n_{c}") for c in distinct]
    return df.groupBy(*keys).agg(*aggs)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long table (column, n_null) from one aggregate pass."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("n_null"))
                      for i, c in enumerate(cols)])
    return wide.select(F.inline(pairs))


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns) as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def correlation(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation and R² of y on x.  ``regr_r2`` returns null
    for a constant input where ``corr`` may fail under ANSI mode, so the
    correlation is derived from the regression moments with a guard."""
    sxx = F.regr_sxx(y, x)
    syy = F.regr_syy(y, x)
    sxy = F.regr_sxy(y, x)
    corr = F.when((sxx > 0) & (syy > 0), sxy / F.sqrt(sxx * syy))
    return df.groupBy(*keys).agg(F.regr_count(y, x).alias("n"), corr.alias("corr"),
                                 F.regr_r2(y, x).alias("r2"))
