"""Registered queries of fitted-model scoring, with numbers that SQL can check.

A ridge on two features has a closed form: with the training rows' population moments, the
coefficients solve (S + reg / sd(y) * diag(S)) b = s, S the features' covariances and s those
with the target (the learner penalises standardised features and target). Scaling before the
learner cancels out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlens.functions.columns import round_doubles
from harvestlens.operators.cleaning import holdout_split
from harvestlens.operators.models import fit, ridge_pipeline
from harvestlens.plans.catalog_queries import _training, _training_sql
from harvestlens.plans.scoring import ScoreTable, score_table
from harvestlens.plans.sql_oracle import rounded
from harvestlens.session import scratch, stored

FEATURES = ["ndvi_poly_mean", "floraison_heat_degree_days_25"]
HOLDOUT, REG = 2001, 0.1
UNKNOWN = "05"  # regions before this one have no actual in the held-out year
COLS = ["DEPT_ID", "harvest_year", "RENDEMENT", "yield_pred"]
METRICS = ["mae", "mse", "rmse", "r2"]


def _scores(spark, sf) -> ScoreTable:
    mart = stored(_training(spark, sf).select("DEPT_ID", "harvest_year", "RENDEMENT", *FEATURES), "mart")
    train, _ = holdout_split(mart, "harvest_year", HOLDOUT)
    model = fit(ridge_pipeline(FEATURES, "RENDEMENT", reg_param=REG), train, FEATURES, "RENDEMENT")
    unknown = (F.col("harvest_year") == HOLDOUT) & (F.col("DEPT_ID") < UNKNOWN)
    told = mart.withColumn("RENDEMENT", F.when(~unknown, F.col("RENDEMENT")))
    return score_table(model, told, FEATURES, scratch(spark, "scores"), "ridge_two_features")


def _sql() -> str:
    a, b = FEATURES
    mom = (f"SELECT avg({a}) AS ma, avg({b}) AS mb, avg(RENDEMENT) AS my, REGULAR * var_pop({a}) AS saa, REGULAR * var_pop({b}) AS sbb, "
           f"covar_pop({a}, {b}) AS sab, covar_pop({a}, RENDEMENT) AS say, covar_pop({b}, RENDEMENT) AS sby "
           f"FROM mart WHERE harvest_year <> {HOLDOUT}").replace("REGULAR", f"(1 + {REG} / stddev_pop(RENDEMENT))")
    return (f"WITH mart AS MATERIALIZED (SELECT * FROM ({_training_sql()}) t), mom AS ({mom}) "
            f"SELECT DEPT_ID, harvest_year, CASE WHEN harvest_year = {HOLDOUT} AND DEPT_ID < '{UNKNOWN}' THEN NULL ELSE RENDEMENT END AS RENDEMENT, "
            f"my + ((say * sbb - sby * sab) * ({a} - ma) + (sby * saa - say * sab) * ({b} - mb)) / (saa * sbb - sab * sab) AS yield_pred "
            f"FROM mart, mom")


def _q_holdout(spark, sf):
    return round_doubles(_scores(spark, sf).read().filter(F.col("harvest_year") == HOLDOUT).select(*COLS))


def _q_lookup(spark, sf):
    return round_doubles(_scores(spark, sf).rows_of("05", 1998).select(*COLS))


def _q_metrics(spark, sf):
    return round_doubles(_scores(spark, sf).metrics(HOLDOUT), 4)


def register(q: dict, sql: dict) -> None:
    q.update({"score_holdout_fitted": _q_holdout, "score_lookup_fitted": _q_lookup, "score_metrics_fitted": _q_metrics})
    held = f"SELECT * FROM ({_sql()}) s WHERE harvest_year = {HOLDOUT}"
    sql["score_holdout_fitted"] = rounded(held, COLS[2:], COLS, 6)
    sql["score_lookup_fitted"] = rounded(f"SELECT * FROM ({_sql()}) s WHERE DEPT_ID = '05' AND harvest_year = 1998", COLS[2:], COLS, 6)
    e = "(RENDEMENT - yield_pred)"
    sql["score_metrics_fitted"] = rounded(
        f"SELECT count(*) AS n, avg(abs({e})) AS mae, avg({e} * {e}) AS mse, sqrt(avg({e} * {e})) AS rmse, "
        f"1 - avg({e} * {e}) / var_pop(RENDEMENT) AS r2 FROM ({held}) h WHERE RENDEMENT IS NOT NULL", METRICS, ["n", *METRICS], 4)
