"""Registered model queries.

They fit on the engineered features of the daily training mart (yield target x soil x
NDVI x weather indicators, then the soil and interaction features) with a temporal split.
A fitted number can't be written in SQL, so what the oracles check is everything around
it: which rows are scored, their targets, that each has a finite prediction, that both
scoring routes agree, and the whole result of the rule model.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.functions.columns import numeric_columns, round_doubles
from harvestlens.operators.dataset import TemporalSplit, regression_metrics
from harvestlens.operators.models import (fit, fold_table, gbt_pipeline, prep_stages, predict,
                                          random_search, ridge_pipeline, usable_features)
from harvestlens.operators.search import Choice, Range, density_ratio_search
from harvestlens.operators.soil import feature_engineering
from harvestlens.plans.catalog_queries import _training, _training_sql
from harvestlens.plans.runlog import RunLog
from harvestlens.plans.sql_oracle import rounded
from harvestlens.session import scratch

Q: dict = {}
SQL: dict = {}

SPLIT = TemporalSplit(train_max_year=1998, test_min_year=1999)
KEYS = ["DEPT_ID", "harvest_year"]
TARGET = "RENDEMENT"

_TEST_ROWS = (f"SELECT DEPT_ID, harvest_year, RENDEMENT FROM ({_training_sql()}) t "
              f"WHERE harvest_year >= {SPLIT.test_min_year}")


def _data(spark, sf) -> tuple[DataFrame, list[str]]:
    """The engineered mart, written once (fits and folds read it many times), and the
    features that have a value in the training years."""
    mart = feature_engineering(_training(spark, sf)).checkpoint(eager=True)
    train, _ = SPLIT.split(mart, "harvest_year")
    return mart, usable_features(train, numeric_columns(mart, exclude=("harvest_year", "ANNEE", TARGET)))


def _present(scored: DataFrame) -> DataFrame:
    finite = F.col("yield_pred").isNotNull() & ~F.isnan("yield_pred")
    return round_doubles(scored.select(*KEYS, TARGET, finite.alias("predicted")))


def _fit_predict(pipeline_fn):
    def run(spark, sf):
        mart, features = _data(spark, sf)
        train, test = SPLIT.split(mart, "harvest_year")
        model = fit(pipeline_fn(features), train, features, TARGET)
        return predict(model, test, features, KEYS + [TARGET])
    return run


_ridge = _fit_predict(lambda f: ridge_pipeline(f, TARGET, reg_param=0.1))
_gbt = _fit_predict(lambda f: gbt_pipeline(
    f, TARGET, maxIter=20, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="0.8",
    minInstancesPerNode=2, minInfoGain=0.0))
Q["fit_ridge"] = lambda spark, sf: _present(_ridge(spark, sf))
Q["fit_gbt"] = lambda spark, sf: _present(_gbt(spark, sf))
SQL["fit_ridge"] = SQL["fit_gbt"] = rounded(f"SELECT *, true AS predicted FROM ({_TEST_ROWS}) t", [TARGET],
                                            KEYS + [TARGET, "predicted"], 6)


def _search(metric: str, grid: dict, n_draws: int):
    """The maps drawn and whether each has a finite score over 5 folds."""
    def run(spark, sf):
        mart, features = _data(spark, sf)
        train, _ = SPLIT.split(mart, "harvest_year")
        gbt = GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol="yield_pred", seed=42)
        found = random_search(Pipeline(stages=prep_stages(features) + [gbt]), gbt, grid, n_draws, train,
                              features, TARGET, KEYS, k=5, metric=metric, seed=42, parallelism=4)
        rows = [(", ".join(f"{n}={v}" for n, v in sorted(params.items())), bool(m == m)) for params, m in found.trials]
        return spark.createDataFrame(rows, "params string, finite boolean")
    return run


_R2_GRID = {"maxDepth": [2], "maxIter": [3, 6], "stepSize": [0.1, 0.3]}
_MAE_GRID = {"maxDepth": [2], "maxIter": [3, 6], "subsamplingRate": [0.8, 1.0]}


def _grid_sql(grid: dict) -> str:
    maps = [""]
    for name in sorted(grid):
        maps = [f"{m}, {name}={v}" if m else f"{name}={v}" for m in maps for v in grid[name]]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{m}', true)" for m in maps) + ") AS t(params, finite)"


Q["search_random"], SQL["search_random"] = _search("r2", _R2_GRID, 4), _grid_sql(_R2_GRID)
Q["cv_mae"], SQL["cv_mae"] = _search("mae", _MAE_GRID, 4), _grid_sql(_MAE_GRID)


# Every parameter of the learner that the full search varies. Its ranges for the number of trees
# and their depth are cut here as the maps above are (README).
_TPE_SPACE = {
    "maxIter": Range(2, 6, integer=True, log=True), "maxDepth": Range(1, 3, integer=True),
    "stepSize": Range(0.01, 0.3, log=True), "subsamplingRate": Range(0.6, 1.0),
    "featureSubsetStrategy": Choice(("0.5", "0.7", "0.9", "all")),
    "minInstancesPerNode": Range(1, 10, integer=True), "minInfoGain": Range(1e-8, 1.0, log=True),
    "minWeightFractionPerNode": Range(0.0, 0.1), "maxBins": Range(16, 64, integer=True, log=True),
}
_TPE_TRIALS, _TPE_STARTUP = 8, 4


def _q_search_tpe(spark, sf):
    """One row per trial: its parameters, its mean absolute error over 5 folds, and the best
    error up to it."""
    mart, features = _data(spark, sf)
    train, _ = SPLIT.split(mart, "harvest_year")
    gbt = GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol="yield_pred", seed=42)
    mae = RegressionEvaluator(labelCol=TARGET, predictionCol="yield_pred", metricName="mae")
    found = density_ratio_search(prep_stages(features), gbt, _TPE_SPACE, _TPE_TRIALS, fold_table(train, features, TARGET, KEYS),
                                 TARGET, "fold", 5, mae, seed=42, startup=_TPE_STARTUP)
    rows = [(i, {n: str(v) for n, v in p.items()}, s) for i, (p, s) in enumerate(found.trials, 1)]
    trials = spark.createDataFrame(rows, "trial int, params map<string,string>, mae double")
    best = F.min("mae").over(Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return trials.withColumn("best", best)  # a row per trial


Q["search_tpe"] = _q_search_tpe


def _runlog(spark) -> RunLog:
    """A log of this call's own, so that a result doesn't depend on earlier calls."""
    return RunLog(spark, scratch(spark, "runlog"))


def _q_score_batch(spark, sf):
    mart, features = _data(spark, sf)
    mart = mart.withColumnRenamed("harvest_year", "ANNEE")
    log = _runlog(spark)
    run_id = log.train_and_register(mart, "ridge_default", features, SPLIT, extra_params={"test_tag": "workflow"})
    log.promote("ridge_default", run_id)
    by_run = log.predict_run(mart, run_id).select("DEPT_ID", "ANNEE", F.col("yield_pred").alias("by_run"))
    return (log.predict_production(mart, "ridge_default").join(by_run, ["DEPT_ID", "ANNEE"])
            .select("DEPT_ID", "ANNEE", (F.col("yield_pred") == F.col("by_run")).alias("same"),
                    (F.col("model_run_id") == run_id).alias("of_run")))


Q["score_batch"] = _q_score_batch
SQL["score_batch"] = (f"SELECT DEPT_ID, harvest_year AS ANNEE, true AS same, true AS of_run "
                      f"FROM ({_training_sql()}) t")

# the rule model, restated: the yield of the year before, where there is one
_LAG_METRICS = f"""SELECT count(*) AS n_test, avg(abs(a.RENDEMENT - b.RENDEMENT)) AS mae
FROM ({_training_sql()}) a JOIN ({_training_sql()}) b
  ON a.DEPT_ID = b.DEPT_ID AND b.harvest_year = a.harvest_year - 1
WHERE a.harvest_year >= {SPLIT.test_min_year}"""


def _logged(spark, sf) -> RunLog:
    mart = _training(spark, sf).select(*KEYS, TARGET).withColumnRenamed("harvest_year", "ANNEE").checkpoint(eager=True)
    log = _runlog(spark)
    for note in ("first", "second"):
        log.train_and_register(mart, "lag1", [], SPLIT, extra_params={"note": note})
    return log


def _run_row(runs: DataFrame) -> DataFrame:
    return round_doubles(runs.select("model_id", F.col("params")["note"].alias("note"),
                                     F.col("metrics")["n_test"].cast("long").alias("n_test"),
                                     F.col("metrics")["mae"].alias("mae"), F.col("model_path").isNull().alias("is_rule")))


def _q_run_log(spark, sf):
    return _run_row(_logged(spark, sf).runs("lag1"))


def _q_latest_run(spark, sf):
    log = _logged(spark, sf)
    return _run_row(log.runs().join(log.latest().select("run_id"), "run_id"))


_RUN_COLS = ["model_id", "note", "n_test", "mae", "is_rule"]
Q["run_log"], Q["latest_run"] = _q_run_log, _q_latest_run
SQL["run_log"] = rounded(f"SELECT 'lag1' AS model_id, note, n_test, mae, true AS is_rule FROM ({_LAG_METRICS}) m, "
                         "(VALUES ('first'), ('second')) AS v(note)", ["mae"], _RUN_COLS, 6)
SQL["latest_run"] = rounded(f"SELECT 'lag1' AS model_id, 'second' AS note, n_test, mae, true AS is_rule "
                            f"FROM ({_LAG_METRICS}) m", ["mae"], _RUN_COLS, 6)


def _q_fit_metrics(spark, sf):
    m = regression_metrics(_ridge(spark, sf), TARGET, "yield_pred")
    return m.select("n", *[(F.col(c).isNotNull() & ~F.isnan(c)).alias(f"{c}_finite") for c in ("mae", "mse", "rmse", "r2")])


Q["fit_metrics"] = _q_fit_metrics
SQL["fit_metrics"] = (f"SELECT count(RENDEMENT) AS n, true AS mae_finite, true AS mse_finite, true AS rmse_finite, "
                      f"true AS r2_finite FROM ({_TEST_ROWS}) t")


def register(q: dict, sql: dict) -> None:
    q.update(Q)
    sql.update(SQL)
