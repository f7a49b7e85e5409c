"""Row filters, ordering, distinct and unions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.session import cut_lineage

_INT_DIGITS = {"tinyint": (3, 127), "smallint": (5, 32767), "int": (10, 2**31 - 1), "bigint": (19, 2**63 - 1)}


def _integer_prefix(column: str, dtype: str, prefix: str):
    """Exact range form of ``cast(x as string) LIKE 'prefix%'`` for an
    integer column: non-negative x in [p·10^k, (p+1)·10^k − 1] for every
    possible number of extra digits k.  Ranges push down to Parquet
    row-group statistics; the string form cannot."""
    digits, top = _INT_DIGITS[dtype]
    p = int(prefix)
    c = F.col(column)
    if p == 0:
        return c == F.lit(0).cast(dtype)
    conds = []
    for k in range(0, digits - len(prefix) + 1):
        lo, hi = p * 10 ** k, min((p + 1) * 10 ** k - 1, top)
        if lo > top:
            break
        conds.append(c.between(F.lit(lo).cast(dtype), F.lit(hi).cast(dtype)))
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def prefix_filter(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """keep rows whose stringified code starts with ``prefix``.
    Like the reference this also keeps ``130`` for prefix ``13``.  On an
    integer column a digit prefix becomes exact value ranges (pushed to the
    scan); otherwise the string test is used (pushed as StringStartsWith)."""
    dtype = df.schema[column].dataType.simpleString()
    if dtype in _INT_DIGITS and prefix.isdigit() and (prefix == "0" or not prefix.startswith("0")):
        return df.where(_integer_prefix(column, dtype, prefix))
    return df.where(F.col(column).cast("string").startswith(prefix))


def equals_filter(df: DataFrame, column: str, value) -> DataFrame:
    """equality filter (pushed to the Parquet scan)."""
    return df.where(F.col(column) == F.lit(value))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """drop rows with a null in ``subset`` (``how='any'``) or with all
    of them null (``how='all'``)."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """drop columns holding no value.  One aggregate job counts the
    non-null values of every column at once; the result is a single row."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    empty = [c for i, c in enumerate(df.columns) if counts[f"n{i}"] == 0]
    return df.drop(*empty)


def keep_or_other(df: DataFrame, column: str, keep: DataFrame, keep_column: str | None = None,
                  out: str | None = None, other: str = "AUTRE") -> DataFrame:
    """value stays if it is in ``keep`` (a bounded list such as a
    top-20), otherwise becomes ``other``.  ``keep`` is broadcast only if its
    plan proves it small (a LIMIT); otherwise AQE decides at runtime."""
    from civica.operators.joins import bounded_broadcast
    kc = keep_column or column
    k = keep.select(F.col(kc).alias("__keep")).distinct()
    return (df.join(bounded_broadcast(k), F.col(column) == F.col("__keep"), "left")
              .withColumn(out or column, F.when(F.col("__keep").isNotNull(), F.col(column)).otherwise(F.lit(other)))
              .drop("__keep"))


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """F8: distinct values of ``column`` absent from ``other`` (anti join)."""
    oc = other_column or column
    return (df.select(column).distinct()
              .join(other.select(F.col(oc).alias(column)).distinct(), column, "left_anti"))


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """rows of the latest period.  The maximum is a scalar subquery:
    one small aggregate job, then a pushed-down equality filter."""
    return df.where(F.col(period) == df.agg(F.max(period)).scalar())


def sort_rows(df: DataFrame, keys: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Multi-key sort; callers supply tie columns for a total order."""
    return df.orderBy(*keys, ascending=ascending)


def top_counts(df: DataFrame, column: str, n: int = 20, count_col: str = "n") -> DataFrame:
    """A1+T2: the ``n`` most frequent non-null values; ties broken by value.
    Partial aggregation happens map-side, then a bounded take-ordered."""
    from civica.operators.aggregates import value_counts
    if count_col == column:
        raise ValueError(f"count column {count_col!r} collides with the value column")
    return value_counts(df, column, count_col).orderBy(F.col(count_col).desc(), F.col(column)).limit(n)


def top_counts_pruned(df: DataFrame, column: str, n: int = 20, count_col: str = "n", buckets: int = 1 << 16,
                      hashes: int = 2) -> DataFrame:
    """A1+T2 for columns of very many values: the rows of ``top_counts``,
    without a shuffle of all values where counts are skewed.

    1. Rows are counted per bucket of ``hashes`` hash functions: at most
       ``hashes * buckets`` rows leave a task.  A value has at most the count
       of each of its buckets.
    2. The values of the ``n`` heaviest buckets are counted exactly; the
       n-th of these counts is a floor that every top value reaches.
    3. Only values whose buckets all reach the floor are counted.

    Exact at any data: where counts are nearly even, no bucket is ruled out
    and every value is counted.  ``df`` is read three times, this column
    alone.  Nulls don't count; ties are broken by value; an empty column has
    no rows; with fewer than ``n`` values all are returned."""
    from civica.operators.aggregates import value_counts
    if count_col == column:
        raise ValueError(f"count column {count_col!r} collides with the value column")
    d = df.select(column).where(F.col(column).isNotNull())

    def bucket(h: int):
        return F.pmod(F.xxhash64(F.lit(h), F.col(column)), F.lit(buckets)).cast("int")

    pairs = F.array(*[F.struct(F.lit(h).alias("h"), bucket(h).alias("b")) for h in range(hashes)])
    totals = cut_lineage(d.select(F.inline(pairs)).groupBy("h", "b").agg(F.count(F.lit(1)).alias("total")), name="buckets")
    heavy = [r["b"] for r in totals.where("h = 0").orderBy(F.col("total").desc(), "b").limit(n).collect()]
    top = value_counts(d.where(bucket(0).isin(heavy)), column, "__n").orderBy(F.col("__n").desc()).limit(n)
    n_top, floor = top.agg(F.count(F.lit(1)), F.min("__n")).first()
    floor = floor if n_top == n else 0
    for h in range(hashes):   # at most ``buckets`` rows each
        reach = totals.where((F.col("h") == h) & (F.col("total") >= floor)).select(F.col("b").alias("__b"))
        d = d.join(F.broadcast(reach), bucket(h) == F.col("__b"), "left_semi")
    return value_counts(d, column, count_col).orderBy(F.col(count_col).desc(), F.col(column)).limit(n)


def distinct_on(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """T4: distinct rows over a column subset."""
    return df.select(*columns).distinct()


def head_rows(df: DataFrame, n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """T5: first ``n`` rows; with an order the preview is deterministic."""
    return (df.orderBy(*order) if order else df).limit(n)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate same-schema tables by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_missing(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate tables whose columns differ; absent columns → null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
