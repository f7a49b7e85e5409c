"""Model features: hash split (M1), exact robust scaling (M2).

Mean imputation (M9) is ``civica.operators.aggregates.fill_global_mean``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Relative accuracy of the sketches that narrow an order statistic down.
SKETCH_ACCURACY = 100_000


def hash_bucket(keys: Sequence[str], seed: int = 42, modulo: int = 100) -> Column:
    """Stable pseudo-random bucket: first 8 hex digits of
    ``md5(key1|key2|…#seed)`` as an integer, modulo ``modulo``.  Unlike
    ``randomSplit`` it does not depend on partitioning or task retries."""
    s = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") % modulo


def hash_split(df: DataFrame, keys: Sequence[str], train_pct: int = 80, seed: int = 42,
               out: str = "split") -> DataFrame:
    """M1: label each row ``train`` or ``test`` (80/20 by default)."""
    return df.withColumn(out, F.when(hash_bucket(keys, seed) < train_pct, F.lit("train")).otherwise(F.lit("test")))


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles under positional names, NaN as null."""
    cast = [F.col(f"`{c}`").cast("double") for c in columns]
    return df.select(*[F.when(~F.isnan(x), x).alias(f"x{i}") for i, x in enumerate(cast)])


def order_statistics(df: DataFrame, wanted: Sequence[tuple[str, float]]) -> dict[tuple[str, float], float | None]:
    """For each (column, position) the exact value at that 0-based rank, or,
    between two ranks, their linear interpolation; positions are shares of
    ``n - 1``.  No column is ever gathered, and only comparisons are made, so
    any spread of values and infinities are fine.

    Each pass sketches (``percentile_approx``) every value still in question
    for all columns in one aggregate, then counts exactly, in another, how
    many values lie below and at the sketched candidates.  A candidate whose
    count covers the rank is the answer; otherwise the open interval between
    its neighbours is left.  An interval loses its candidates in every pass,
    and all but a few of ``SKETCH_ACCURACY``-ths of its values as a rule."""
    columns = list(dict.fromkeys(c for c, _ in wanted))
    vals = _values(df, columns)
    sizes = vals.agg(*[F.count(f"x{i}").alias(f"n{i}") for i in range(len(columns))]).first()
    n = {c: sizes[i] for i, c in enumerate(columns)}
    open_ = {(columns.index(c), r): [None, None, 0, n[c]] for c, p in wanted if n[c]
             for r in {math.floor((n[c] - 1) * p), math.ceil((n[c] - 1) * p)}}
    found: dict[tuple[int, int], float] = {}
    while open_:
        keys = list(open_)
        sketches = []
        for j, (i, rank) in enumerate(keys):
            lo, hi, below, inside = open_[i, rank]
            x = F.col(f"x{i}")
            keep = x.isNotNull()
            keep = keep if lo is None else keep & (x > F.lit(lo))
            keep = keep if hi is None else keep & (x < F.lit(hi))
            at, margin = (rank - below + 0.5) / inside, 1.5 / SKETCH_ACCURACY
            shares = [min(1.0, max(0.0, at + m)) for m in (-margin, 0.0, margin)]
            sketches.append(F.percentile_approx(F.when(keep, x), shares, SKETCH_ACCURACY).alias(f"s{j}"))
        row = vals.agg(*sketches).first()
        tries = {k: sorted(set(row[j])) for j, k in enumerate(keys)}
        counts = [(f(F.col(f"x{i}"), F.lit(v)), k, v, what) for k in keys for v in tries[k] for i in [k[0]]
                  for what, f in (("lt", lambda a, b: a < b), ("le", lambda a, b: a <= b))]
        row = vals.agg(*[F.count_if(c).alias(f"c{j}") for j, (c, *_) in enumerate(counts)]).first()
        number = {(k, v, what): row[j] for j, (_, k, v, what) in enumerate(counts)}
        for k in keys:
            rank, state = k[1], open_[k]
            for v in tries[k]:
                lt, le = number[k, v, "lt"], number[k, v, "le"]
                if lt <= rank < le:
                    found[k] = v
                    del open_[k]
                    break
                if le <= rank:
                    end = state[2] + state[3]
                    state[0], state[2], state[3] = v, le, end - le
                else:
                    state[1], state[3] = v, lt - state[2]
                    break
    out: dict[tuple[str, float], float | None] = {}
    for c, p in wanted:
        if not n[c]:
            out[c, p] = None
            continue
        at = (n[c] - 1) * p
        a, b = (found[columns.index(c), f(at)] for f in (math.floor, math.ceil))
        w = at - math.floor(at)
        # Equal ends need no interpolation (two infinities); far ends may not be subtracted.
        out[c, p] = a if a == b or w == 0 else (a + w * (b - a) if math.isfinite(b - a) else a * (1 - w) + b * w)
    return out


def kth_smallest(df: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, float | None]:
    """Exact order statistics (0-based ranks) of the non-null values."""
    n = _values(df, [column]).agg(F.count("x0")).first()[0]
    if not n:
        return {k: None for k in ranks}
    share = {k: k / (n - 1) if n > 1 else 0.0 for k in ranks}
    got = order_statistics(df, [(column, s) for s in share.values()])
    return {k: got[column, s] for k, s in share.items()}


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation (numpy's default,
    ``percentile`` in Spark SQL, ``quantile_cont`` in SQL engines)."""
    got = order_statistics(df, [(column, p) for p in probs])
    return [got[column, p] for p in probs]


def robust_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled",
                 source: DataFrame | None = None) -> DataFrame:
    """M2: ``(x − median) / (q75 − q25)`` with exact quantiles of ``source``
    (default ``df``, e.g. the training rows); a zero range scales by 1.  All
    columns share each pass."""
    src = source if source is not None else df
    q = order_statistics(src, [(c, p) for c in columns for p in (0.25, 0.5, 0.75)])
    out = {}
    for c in columns:
        q25, q50, q75 = (q[c, p] for p in (0.25, 0.5, 0.75))
        iqr = (q75 - q25) if q25 is not None else None
        scale = iqr if iqr not in (None, 0.0) else 1.0
        out[f"{c}{suffix}"] = (F.col(c) - F.lit(q50 if q50 is not None else 0.0)) / F.lit(scale)
    return df.withColumns(out)
