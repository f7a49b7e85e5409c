"""Vote model: features, training, scenario projection.

Training uses MLlib's distributed tree learners on a ``VectorAssembler``
frame; the training rows are persisted while the learner makes its pass
per level and round.  Nulls are imputed (M9) before
assembly: MLlib trees, unlike the reference's histogram booster, do not
route missing values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.functions.numbers import clip
from civica.operators.quality import ensure_not_empty


def train_model(train: DataFrame, features: Sequence[str], label: str, kind: str = "gbt",
                max_iter: int = 300, max_depth: int = 5, step: float = 0.1, seed: int = 42,
                num_trees: int = 100) -> PipelineModel:
    """Fit a gradient-boosted (``gbt``) or random-forest
    (``forest``) regressor.  Q4 guards against an empty frame."""
    ensure_not_empty(train.select(label))
    assembler = VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="keep")
    if kind == "gbt":
        est = GBTRegressor(featuresCol="__features", labelCol=label, predictionCol="prediction",
                           maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=seed)
    elif kind == "forest":
        est = RandomForestRegressor(featuresCol="__features", labelCol=label, predictionCol="prediction",
                                    numTrees=num_trees, maxDepth=max_depth, seed=seed)
    else:
        raise ValueError(kind)
    data = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[assembler, est]).fit(data)
    finally:
        data.unpersist()


def predict(model: PipelineModel, df: DataFrame, out: str = "pred_voix", floor: float | None = None) -> DataFrame:
    """M7: score rows; every input column (keys included) is carried
    through, so truth and prediction stay aligned without an index (J8)."""
    p = model.transform(df).drop("__features").withColumnRenamed("prediction", out)
    return p.withColumn(out, clip(out, lo=floor)) if floor is not None else p


# Scenario factors applied to the latest-year indicator means
# (unchanged for 2027; unemployment ×1.5, poverty ×0.5, crime ×2.0 for 2032).
SCENARIOS = {2027: {"chomage": 1.0, "pauvrete": 1.0, "police": 1.0},
             2032: {"chomage": 1.5, "pauvrete": 0.5, "police": 2.0}}


def scenario_frame(latest: DataFrame, history: DataFrame, period: str, groups: Mapping[str, Sequence[str]],
                   scenarios: Mapping[int, Mapping[str, float]] = SCENARIOS) -> DataFrame:
    """One row per latest row and scenario year.  Indicator columns
    are replaced by their mean over the latest period of ``history`` (F9 +
    A4) times the scenario factor of their group.  The means come from one
    scalar subquery: per-period means (partially aggregated, one row per
    period) and ``max_by`` the period, so ``history`` is read once.  The
    scenario table is a literal array exploded per row (a generator, no
    join and no data-dependent size)."""
    cols = [c for g in groups.values() for c in g]
    per_period = history.groupBy(period).agg(*[F.avg(c).alias(c) for c in cols])
    means = per_period.agg(F.max_by(F.struct(*cols), F.col(period))).scalar()
    group_of = {c: g for g, cs in groups.items() for c in cs}
    sc = F.array(*[F.struct(F.lit(int(y)).alias("__year"),
                            *[F.lit(float(f.get(g, 1.0))).alias(f"__f_{g}") for g in groups])
                   for y, f in sorted(scenarios.items())])
    x = latest.withColumn("__s", F.explode(sc))
    repl = {c: means[c] * F.col(f"__s.__f_{group_of[c]}") for c in cols}
    repl[period] = F.col("__s.__year")
    return x.withColumns(repl).drop("__s")


def national_totals(preds: DataFrame, period: str, label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Predicted totals per period and label (R8 with zero fill)."""
    from civica.operators.reshape import unstack_zero_fill
    return unstack_zero_fill(preds, [period], label, value, labels)
