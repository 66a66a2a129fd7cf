"""Random-forest forecasts on look-back features with MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.operators.series import FEATURES

# Number of trees tried, folds, hold-out share, seed.
TREES = (10, 15, 20, 25)
FOLDS = 5
HOLD_OUT = 0.25
SEED = 42
# Fewest training rows of a series with a model of its own; series fitted at a time.
LEAST_ROWS = 50
PARALLEL = 4


def train_supervised(
    features: DataFrame, trees: Sequence[int] = TREES, folds: int = FOLDS, seed: int = SEED
) -> tuple[PipelineModel, float]:
    """Choose the number of trees by cross-validation on 75 %, measure on the rest, refit on all.

    Returns the refitted model and the RMSE on the held-out rows.
    """
    forest = RandomForestRegressor(featuresCol="scaled", labelCol="target", seed=seed)
    stages = Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
            forest,
        ]
    )
    score = RegressionEvaluator(labelCol="target", metricName="rmse")
    grid = ParamGridBuilder().addGrid(forest.numTrees, list(trees)).build()
    # Split by a hash of the row's identity: a lost task gets the same rows again.
    part = F.pmod(F.xxhash64("series", "date", F.lit(seed)), F.lit(1000))
    train = features.where(part >= int(HOLD_OUT * 1000))
    test = features.where(part < int(HOLD_OUT * 1000))
    search = CrossValidator(
        estimator=stages, estimatorParamMaps=grid, evaluator=score, numFolds=folds, seed=seed, parallelism=4
    )
    found = search.fit(train)
    rmse = score.evaluate(found.transform(test))
    best = found.bestModel.stages[-1].getNumTrees
    final = stages.copy({forest.numTrees: best}).fit(features)
    return final, rmse


def forecast_supervised(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predicted revenue of the 30 days from each date on."""
    return model.transform(features).select("series", "date", "prediction")


def predict_on_date(model: PipelineModel, features: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Predictions for requested ``(series, date)`` rows, and the requests without features."""
    found = wanted.join(features, ["series", "date"])
    missing = wanted.join(features.select("series", "date"), ["series", "date"], "left_anti")
    return forecast_supervised(model, found), missing


def train_each(
    training: DataFrame, trees: Sequence[int] = TREES, folds: int = FOLDS, seed: int = SEED
) -> dict[str, tuple[PipelineModel, float]]:
    """``train_supervised`` for every series by itself; series with fewer than ``LEAST_ROWS`` rows have no model.

    The driver gets the names of the series, which are few: all, and the largest countries.
    """
    names = sorted(r["series"] for r in training.groupBy("series").count().where(F.col("count") >= LEAST_ROWS).collect())

    def fit(name: str) -> tuple[PipelineModel, float]:
        # One row per day: a series fits one partition, which its many short jobs read from memory.
        own = training.where(F.col("series") == name).coalesce(1).persist()
        try:
            return train_supervised(own, trees, folds, seed)
        finally:
            own.unpersist()

    with ThreadPool(PARALLEL) as pool:
        return dict(zip(names, pool.map(inheritable_thread_target(training.sparkSession)(fit), names), strict=True))


def forecast_each(models: dict[str, tuple[PipelineModel, float]], features: DataFrame) -> DataFrame:
    """``forecast_supervised`` with each series' own model; null for series without one."""
    fitted = F.coalesce(F.col("series").isin(list(models)), F.lit(False))
    out = features.where(~fitted).select("series", "date", F.lit(None).cast("double").alias("prediction"))
    for name, (model, _) in models.items():
        out = out.unionByName(forecast_supervised(model, features.where(F.col("series") == name)))
    return out


def predict_each_on_date(
    models: dict[str, tuple[PipelineModel, float]], features: DataFrame, wanted: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``predict_on_date`` with each series' own model."""
    found = wanted.join(features, ["series", "date"])
    missing = wanted.join(features.select("series", "date"), ["series", "date"], "left_anti")
    return forecast_each(models, found), missing
