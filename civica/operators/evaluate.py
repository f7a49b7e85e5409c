"""Model evaluation (M10-M12, M21).  Every metric is one or two grouped
aggregates; nothing is collected to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.operators.aggregates import group_sums


def r2(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = (), out: str = "r2") -> DataFrame:
    """``1 − Σ(y − ŷ)² / Σ(y − ȳ)²``.  Σ(y − ȳ)² is the population
    variance times n (``var_pop``, a stable one-pass moment)."""
    d = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    sse = F.sum((F.col(y) - F.col(yhat)) ** 2)
    sst = F.var_pop(y) * F.count(F.lit(1))
    return d.groupBy(*keys).agg((F.lit(1.0) - F.try_divide(sse, sst)).alias(out))


def mae(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = (), out: str = "mae") -> DataFrame:
    """Mean absolute error."""
    return df.groupBy(*keys).agg(F.avg(F.abs(F.col(y) - F.col(yhat))).alias(out))


def majority_labels(df: DataFrame, keys: Sequence[str], label: str, y: str, yhat: str) -> DataFrame:
    """Per key, the label with the largest true total and the label
    with the largest predicted total (ties → smallest label), from one
    aggregate of the totals."""
    g = group_sums(df, [*keys, label], {y: y, yhat: yhat})
    best = lambda v: F.min_by(label, F.struct((-F.col(v)).alias("v"), F.col(label).alias("l")))
    return g.groupBy(*keys).agg(best(y).alias(f"{label}_true"), best(yhat).alias(f"{label}_pred"))


def class_metrics(pairs: DataFrame, true: str, pred: str) -> DataFrame:
    """Accuracy, support-weighted precision (0 for a label never
    predicted) and support-weighted F1, from per-label confusion counts.
    Labels only ever predicted have no support and weigh 0."""
    # Each pair counts once for its true and once for its predicted label.
    hit = (F.col(true) == F.col(pred)).cast("int")
    sides = F.array(F.struct(F.col(true).alias("label"), F.lit(1).alias("s"), F.coalesce(hit, F.lit(0)).alias("t"), F.lit(0).alias("p")),
                    F.struct(F.col(pred).alias("label"), F.lit(0).alias("s"), F.lit(0).alias("t"), F.lit(1).alias("p")))
    per = pairs.select(F.inline(sides)).groupBy("label").agg(
        F.sum("s").alias("support"), F.sum("t").alias("tp"), F.sum("p").alias("predicted")).where("support > 0")
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("support")
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    s = F.sum("support")
    return per.agg((F.sum("tp") / s).alias("accuracy"), (F.sum(prec * F.col("support")) / s).alias("precision"),
                   (F.sum(f1 * F.col("support")) / s).alias("f1"), s.alias("n"))
