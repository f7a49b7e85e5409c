"""Party totals, shares, caps and rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civica.functions.numbers import floor_at
from civica.functions.text import contains_any, keyword_pattern
from civica.operators.aggregates import masked_sum


def party_totals(df: DataFrame, keys: Sequence[str], name: str, value: str,
                 parties: Mapping[str, Sequence[str]], residual: str = "AUTRES",
                 out: str = "voix", label: str = "parti") -> DataFrame:
    """Per key, the summed ``value`` of rows whose name matches each
    party's keywords (a row may count for several parties) and a residual
    ``max(0, total − assigned)``.  Rows are first added up per name, so the
    patterns look at each name once; then one conditional sum per party (no
    explode, no join).  Parties without a match get 0."""
    df = df.groupBy(*keys, name).agg(F.sum(value).alias(value))
    named = [p for p, kws in parties.items() if kws]
    aggs = [F.coalesce(F.sum(F.when(F.coalesce(F.col(name).rlike(keyword_pattern(parties[p])), F.lit(False)),
                                    F.col(value))), F.lit(0.0)).alias(f"__p{i}")
            for i, p in enumerate(named)]
    wide = df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("__total"), *aggs)
    assigned = sum((F.col(f"__p{i}") for i in range(len(named))), F.lit(0.0))
    pairs = [F.struct(F.lit(p).alias(label), F.col(f"__p{i}").alias(out)) for i, p in enumerate(named)]
    pairs.append(F.struct(F.lit(residual).alias(label), F.greatest(F.lit(0.0), F.col("__total") - assigned).alias(out)))
    return wide.select(*keys, F.inline(F.array(*pairs)))


def normalise_shares(df: DataFrame, keys: Sequence[str], value: str, out: str = "share") -> DataFrame:
    """``value / Σ value × 100`` per key, so shares sum to exactly 100.
    Runs on already aggregated rows (keys × labels), so the window per key
    holds a handful of rows."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn(out, F.try_divide(F.col(value) * F.lit(100.0), total))


def masked_total(df: DataFrame, keys: Sequence[str], name: str, value: str, keywords: Sequence[str],
                 out: str) -> DataFrame:
    """Per key, sum of ``value`` over rows whose name contains one of
    the keywords (F7 case-insensitive match, A5 masked sum: empty → 0).
    Rows are first added up per name, so a name is matched once."""
    per = df.groupBy(*keys, name).agg(F.sum(value).alias(value))
    return masked_sum(per, value, contains_any(name, keywords), out, keys)


def rank_within(df: DataFrame, keys: Sequence[str], value: str, out: str = "rang",
                ties: Sequence[str] = ()) -> DataFrame:
    """Rank labels per key by ``value`` descending (1 = leader).  Runs
    on aggregated rows."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc(), *ties)
    return df.withColumn(out, F.row_number().over(w))


def apply_caps(df: DataFrame, label: str, value: str, caps: Mapping[str, float], default_cap: float,
               lo: float = 0.0, floor: float | None = 1.0, out: str | None = None) -> DataFrame:
    """Clip each label's value to ``[lo, cap(label)]`` then apply the
    floor ``max(floor, x)``.  Caps are a literal map expression (bounded)."""
    cap = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), F.col(label)),
                     F.lit(default_cap)) if caps else F.lit(default_cap)
    v = F.least(F.greatest(F.col(value), F.lit(lo)), cap)
    v = F.when(F.col(value).isNull(), F.lit(None)).otherwise(v)
    if floor is not None:
        v = floor_at(v, floor)
    return df.withColumn(out or value, v)


def renormalise_with_residual(df: DataFrame, keys: Sequence[str], label: str, value: str,
                              residual: str = "AUTRES", out: str = "share") -> DataFrame:
    """M13 (second half): shares of the predicted values rescaled to 100 per
    key, then a residual row ``100 − Σ`` if the raw total was below 100,
    else 0 (as the reference does, the residual uses the raw total)."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    scaled = df.withColumn("__raw_total", total).withColumn(
        out, F.when(F.col("__raw_total") > 0, F.col(value) / F.col("__raw_total") * 100).otherwise(F.col(value)))
    resid = scaled.groupBy(*keys).agg(F.max("__raw_total").alias("__raw_total"), F.sum(out).alias("__s"))
    resid = resid.select(*keys, F.lit(residual).alias(label), F.lit(None).cast("double").alias(value),
                         F.when(F.col("__raw_total") < 100, F.lit(100.0) - F.col("__s")).otherwise(F.lit(0.0)).alias(out))
    return scaled.select(*keys, label, value, out).unionByName(resid)

