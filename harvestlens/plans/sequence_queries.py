"""Registered queries of the step-wise sequence dataset and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlens.functions.columns import round_doubles
from harvestlens.plans import catalog_queries as cq
from harvestlens.plans import testbed as tb
from harvestlens.plans.sequence_steps import StepDataset, write_step_dataset
from harvestlens.plans.sql_oracle import hourly_panel_sql, rounded
from harvestlens.session import scratch

Q: dict = {}
SQL: dict = {}

LENGTH = 8760
SHIFT = 2023 - 1996  # the hourly panel's years stand for the target's
FEATURES = ["t", "r", "g", "heure_sin", "heure_cos", "jour_sin", "jour_cos", "mois_sin", "mois_cos",
            "saison_sin", "saison_cos"]
STATIC = ["ndvi_poly_mean", "silt_0-5cm_mean", *cq._HOURLY_NAMES]
KEYS = ["DEPT_ID", "harvest_year"]


def _dataset(spark, sf) -> StepDataset:
    mart = cq.hourly_training_mart(spark, sf).withColumn("harvest_year", F.col("ANNEE") + F.lit(SHIFT))
    return write_step_dataset(tb.hourly_panel_labeled(spark, sf), mart, STATIC, scratch(spark, "sequences"),
                              length=LENGTH, excluded=["03", "04"], min_year_exclusive=2022, max_year=2025,
                              pairs_dropped=[("05", 2024)], train_max=2023, val_years=(2024,), test_min=2025)


def _q_sequence_steps(spark, sf):
    return round_doubles(_dataset(spark, sf).steps())


def _q_sequence_statics(spark, sf):
    return round_doubles(_dataset(spark, sf).statics())


def _name(c: str) -> str:
    return f'"{c}"'


def _pairs_sql() -> str:
    cols = ", ".join(_name(c) for c in STATIC)
    return (f"SELECT DEPT_ID, ANNEE + {SHIFT} AS harvest_year, RENDEMENT, {cols}, CASE WHEN ANNEE + {SHIFT} <= 2023 THEN 'train' "
            f"WHEN ANNEE + {SHIFT} = 2024 THEN 'val' ELSE 'test' END AS split FROM ({cq._hourly_training_sql()}) m")


def _hours_sql() -> str:
    kept = (f"SELECT *, hour(datetime) AS h FROM ({hourly_panel_sql()}) p WHERE DEPT_ID NOT IN ('03', '04') "
            f"AND harvest_year > 2022 AND harvest_year <= 2025 AND NOT (DEPT_ID = '05' AND harvest_year = 2024)")
    one = f"SELECT *, coalesce(t, median(t) OVER (PARTITION BY DEPT_ID, h)) AS t1 FROM ({kept}) a"
    two = f"SELECT *, coalesce(t1, median(t1) OVER (PARTITION BY DEPT_ID)) AS t2 FROM ({one}) b"
    stage = ("CASE " + " ".join(f"WHEN saison = '{s}' THEN {i}" for i, s in enumerate(
        ["semis", "vernalisation", "tallage", "montaison", "floraison", "remplissage"])) + " END")
    parts = (("heure", "h", 24), ("jour", "day(datetime)", 31), ("mois", "month(datetime)", 12), ("saison", stage, 6))
    cyc = ", ".join(f"{f}(2 * pi() * ({e}) / {p}.0) AS {n}_{f}" for n, e, p in parts for f in ("sin", "cos"))
    return (f"SELECT DEPT_ID, harvest_year, row_number() OVER (PARTITION BY DEPT_ID, harvest_year ORDER BY datetime) AS step, "
            f"coalesce(t2, (SELECT median(t2) FROM ({two}) m)) AS t, r, g, {cyc} FROM ({two}) c")


def _steps_sql() -> str:
    ctes = (f"WITH hours AS MATERIALIZED (SELECT * FROM ({_hours_sql()}) h WHERE step <= {LENGTH}), "
            f"pairs AS MATERIALIZED (SELECT p.DEPT_ID, p.harvest_year, p.split FROM ({_pairs_sql()}) p "
            f"SEMI JOIN hours USING (DEPT_ID, harvest_year)), ")
    total = f"((SELECT count(*) FROM pairs WHERE split = 'train') * {LENGTH}.0)"
    moments = ", ".join(f"sum({c}) / {total} AS {c}_mu, sqrt(greatest(sum({c} * {c}) / {total} - (sum({c}) / {total}) * (sum({c}) / {total}), 0)) AS {c}_sd"
                        for c in FEATURES)
    scaled = ", ".join(f"(coalesce(h.{c}, 0.0) - {c}_mu) / (CASE WHEN {c}_sd = 0 THEN 1.0 ELSE {c}_sd END) AS {c}" for c in FEATURES)
    return (ctes + f"mom AS (SELECT {moments} FROM hours JOIN pairs USING (DEPT_ID, harvest_year) WHERE split = 'train') "
            f"SELECT p.DEPT_ID, p.harvest_year, p.split, s.step, h.DEPT_ID IS NOT NULL AS observed, {scaled} "
            f"FROM pairs p CROSS JOIN range(1, {LENGTH + 1}) s(step) CROSS JOIN mom "
            f"LEFT JOIN hours h ON h.DEPT_ID = p.DEPT_ID AND h.harvest_year = p.harvest_year AND h.step = s.step")


def _statics_sql() -> str:
    pairs = (f"SELECT p.*, least(n, {LENGTH}) AS n_steps FROM ({_pairs_sql()}) p JOIN (SELECT DEPT_ID, harvest_year, count(*) AS n "
             f"FROM ({_hours_sql()}) h GROUP BY 1, 2) w USING (DEPT_ID, harvest_year)")
    mom = ", ".join(f"CASE WHEN count_if({_name(c)} IS NULL) > 0 THEN NULL ELSE avg({_name(c)}) END AS mu{i}, "
                    f"CASE WHEN count_if({_name(c)} IS NULL) > 0 THEN NULL WHEN stddev_pop({_name(c)}) = 0 THEN 1.0 "
                    f"ELSE stddev_pop({_name(c)}) END AS sd{i}" for i, c in enumerate(STATIC))
    scaled = ", ".join(f"({_name(c)} - mu{i}) / sd{i} AS {_name(c)}" for i, c in enumerate(STATIC))
    return (f"SELECT DEPT_ID, harvest_year, split, RENDEMENT, {scaled}, CAST(n_steps AS INTEGER) AS n_steps FROM ({pairs}) p, "
            f"(SELECT {mom} FROM ({pairs}) q WHERE split = 'train') m")


Q["sequence_steps"], Q["sequence_statics"] = _q_sequence_steps, _q_sequence_statics
SQL["sequence_steps"] = rounded(_steps_sql(), FEATURES, [*KEYS, "split", "step", "observed", *FEATURES], 6)
SQL["sequence_statics"] = rounded(_statics_sql(), ["RENDEMENT", *STATIC], [*KEYS, "split", "RENDEMENT", *STATIC, "n_steps"], 6)


def register(q: dict, sql: dict) -> None:
    q.update(Q)
    sql.update(SQL)
