"""Model fitting and scoring with ``pyspark.ml`` (distributed learners).

The reference trains scikit-learn / XGBoost models in one process; here the
same roles are Spark ML pipelines: imputation (GBT rejects missing values),
feature assembly, robust scaling, and a ridge or gradient-boosted regressor.
Hyper-parameter search (``operators.search``) scores sampled parameter maps over folds whose
preparation is fitted once, or proposes them by a density-ratio sampler.
"""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, RobustScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.operators.search import SearchResult, search_maps
from harvestlens.session import stored


def prep_stages(features: list[str], scale: bool = True):
    imputed = [f"__imp_{c}" for c in features]
    # relativeError 0: exact medians and quartiles
    stages = [Imputer(inputCols=features, outputCols=imputed, strategy="median", relativeError=0.0),
              VectorAssembler(inputCols=imputed, outputCol="__raw", handleInvalid="keep")]
    if scale:
        stages.append(RobustScaler(inputCol="__raw", outputCol="features",
                                   withCentering=True, withScaling=True, relativeError=0.0))
    else:
        stages[-1].setOutputCol("features")
    return stages


def usable_features(train: DataFrame, features: list[str]) -> list[str]:
    """The features with at least one value in the training rows (no median otherwise)."""
    n = train.agg(*[F.count(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(str(i))
                    for i, c in enumerate(features)]).first()
    return [c for i, c in enumerate(features) if n[str(i)]]


def _cast_features(df: DataFrame, features: list[str], target: str | None) -> DataFrame:
    cols = {c: F.col(c).cast("double") for c in features}
    if target and target in df.columns:
        cols[target] = F.col(target).cast("double")
    return df.withColumns(cols)


def gbt_pipeline(features: list[str], target: str, pred_col: str = "yield_pred",
                 **params) -> Pipeline:
    gbt = GBTRegressor(featuresCol="features", labelCol=target, predictionCol=pred_col,
                       seed=params.pop("seed", 42), **params)
    return Pipeline(stages=prep_stages(features) + [gbt])


def ridge_pipeline(features: list[str], target: str, pred_col: str = "yield_pred",
                   reg_param: float = 1.0) -> Pipeline:
    lr = LinearRegression(featuresCol="features", labelCol=target, predictionCol=pred_col,
                          regParam=reg_param, elasticNetParam=0.0)
    return Pipeline(stages=prep_stages(features) + [lr])


def fit(pipeline: Pipeline, train: DataFrame, features: list[str], target: str) -> PipelineModel:
    """Fit on the rows with a known target. Iterative learners read the data
    many times, so the input's lineage is cut once (``checkpoint`` writes to
    the shared ``spark.checkpoint.dir``)."""
    data = _cast_features(train, features, target).filter(F.col(target).isNotNull())
    return pipeline.fit(data.checkpoint(eager=True))


def predict(model: PipelineModel, df: DataFrame, features: list[str], keep: list[str],
            pred_col: str = "yield_pred") -> DataFrame:
    scored = model.transform(_cast_features(df, features, None))
    return scored.select(*keep, pred_col)


def fold_column(df: DataFrame, key_cols: list[str], k: int = 5, seed: int = 42,
                col: str = "fold") -> DataFrame:
    """Deterministic fold id 0..k-1 from a hash of the key."""
    h = F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))
    return df.withColumn(col, F.pmod(h, F.lit(k)).cast("int"))


def fold_table(train: DataFrame, features: list[str], target: str, key_cols: list[str], k: int = 5,
               seed: int = 42) -> DataFrame:
    """The rows with a known target, cast, with their fold; written once."""
    rows = _cast_features(train, features, target).filter(F.col(target).isNotNull())
    return stored(fold_column(rows.select(*key_cols, target, *features), key_cols, k, seed), "folds")


def random_search(pipeline: Pipeline, estimator, grid: dict, n_draws: int, train: DataFrame,
                  features: list[str], target: str, key_cols: list[str], k: int = 5,
                  metric: str = "r2", seed: int = 42, parallelism: int = 4) -> SearchResult:
    """Sample ``n_draws`` parameter maps of the full grid, score them by k-fold
    cross-validation, refit the best on all training rows. The pipeline's stages before the
    estimator are fitted once per fold, whatever the number of maps."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = [{p.name: v for p, v in m.items()} for m in builder.build()]
    rng = random.Random(seed)
    if n_draws < len(maps):
        maps = rng.sample(maps, n_draws)
    evaluator = RegressionEvaluator(labelCol=target, predictionCol=estimator.getPredictionCol(),
                                    metricName=metric)
    data = fold_table(train, features, target, key_cols, k, seed)
    return search_maps(pipeline.getStages()[:-1], estimator, maps, data, target, "fold", k, evaluator, parallelism)
