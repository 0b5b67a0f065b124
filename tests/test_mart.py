"""One-pass mart vs a plain pandas restatement, and golden edge cases."""

import re

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from harvestlens.operators.features import (COMBOS, DAILY_FEATURES, HOURLY_FEATURES, Feature,
                                            Quantile, Term, combo, override)
from harvestlens.operators.mart import build_mart, build_mart_outer, feature_frame, label_stages

ROUNDED = {f.name: {"ndigits": 6} for f in DAILY_FEATURES
           if f.kind in ("roll_max", "roll_exceed", "mean_exceed")}


def _spark_panel(spark, pdf, time_col="day"):
    sdf = spark.createDataFrame(pdf.drop(columns=["saison"], errors="ignore"))
    if time_col == "day":
        sdf = sdf.withColumn("day", F.to_date("day"))
    return label_stages(sdf, time_col)


def _compare(got: pd.DataFrame, exp: pd.DataFrame):
    got = got.sort_values(["DEPT_ID", "harvest_year"]).reset_index(drop=True)
    exp = exp.sort_values(["DEPT_ID", "harvest_year"]).reset_index(drop=True)
    assert list(got[["DEPT_ID", "harvest_year"]].itertuples(index=False)) == \
        list(exp[["DEPT_ID", "harvest_year"]].itertuples(index=False))
    for c in exp.columns:
        if c in ("DEPT_ID", "harvest_year"):
            continue
        a = got[c].astype(float).to_numpy()
        b = exp[c].astype(float).to_numpy()
        assert np.allclose(a, b, equal_nan=True, rtol=1e-9, atol=1e-9), c


@pytest.mark.parametrize("seed", [1, 7])
def test_daily_mart_matches_pandas(spark, seed):
    pdf = bf.random_daily_panel(seed)
    feats = override(DAILY_FEATURES, ROUNDED)
    got = build_mart(_spark_panel(spark, pdf), feats).toPandas()
    exp = bf.mart(bf.with_season(pdf), feats)
    _compare(got, exp)


def test_outer_form_equals_one_pass(spark):
    pdf = bf.random_daily_panel(3)
    feats = override(DAILY_FEATURES, ROUNDED)
    panel = _spark_panel(spark, pdf)
    a = build_mart(panel, feats).toPandas()
    b = build_mart_outer(panel, feats).toPandas()[a.columns]
    _compare(a, b)


@pytest.mark.parametrize("combo_id", sorted(COMBOS))
def test_combos_match_pandas(spark, combo_id):
    pdf = bf.random_daily_panel(11, n_dept=2)
    feats = combo(override(DAILY_FEATURES, ROUNDED), combo_id)
    got = build_mart(_spark_panel(spark, pdf), feats).toPandas()
    exp = bf.mart(bf.with_season(pdf), feats)
    _compare(got, exp)


def test_unknown_combo_raises():
    with pytest.raises(ValueError):
        combo(DAILY_FEATURES, "nope")


def test_hourly_mart_matches_pandas(spark):
    rng = np.random.default_rng(5)
    hours = pd.date_range("2020-05-16", "2020-06-15 23:00", freq="h")
    rows = []
    for d in ("01", "2A"):
        keep = rng.random(len(hours)) > 0.1
        for h in hours[keep]:
            t = float(np.round(26 + 6 * np.sin(h.hour / 24 * 2 * np.pi) + rng.normal(0, 3)))
            rows.append({"DEPT_ID": d, "datetime": h.to_pydatetime(), "temp_air_c": t,
                         "precipitations_1h_mm": float(max(0, np.round(rng.normal(0, 1), 1)))})
    pdf = pd.DataFrame(rows)
    pdf["harvest_year"] = 2020
    feats = [f for f in HOURLY_FEATURES if f.stage == "floraison"]
    feats = override(feats, {"floraison_cumul_pluie_10j_max": {"ndigits": 6}})
    got = build_mart(_spark_panel(spark, pdf, "datetime"), feats, time_col="datetime").toPandas()
    exp = bf.mart(bf.with_season(pdf, "datetime"), feats, time_col="datetime")
    _compare(got, exp)


# ---------------------------------------------------------------- golden cases

def _panel(spark, rows, cols=("DEPT_ID", "day", "temp_max_c", "precipitations_1h_mm")):
    pdf = pd.DataFrame(rows, columns=list(cols)).astype({c: float for c in cols[2:]})
    return _spark_panel(spark, pdf)


def _days(start, n):
    d0 = dt.date.fromisoformat(start)
    return [d0 + dt.timedelta(days=i) for i in range(n)]


def test_null_breaks_run_missing_day_does_not(spark):
    days = _days("2001-05-20", 8)
    # 31, 31, (missing day), 31, NULL, 31, 31, 31
    rows = [("01", days[0], 31.0, 1.0), ("01", days[1], 31.0, 1.0), ("01", days[3], 31.0, 1.0),
            ("01", days[4], None, 1.0), ("01", days[5], 31.0, 1.0), ("01", days[6], 31.0, 1.0),
            ("01", days[7], 31.0, 1.0)]
    f = Feature("run", "floraison", "run_max", (Term("tx", ">", 30.0),))
    out = build_mart(_panel(spark, rows), [f]).collect()[0]
    assert out["run"] == 3


def test_all_null_group_sums_zero(spark):
    days = _days("2001-05-20", 3)
    rows = [("01", d, None, None) for d in days]
    feats = [Feature("hot", "floraison", "count", (Term("tx", ">", 25.0),)),
             Feature("dd", "floraison", "excess", value="tx", base=25.0),
             Feature("runs", "floraison", "run_max", (Term("tx", ">", 25.0),))]
    out = build_mart(_panel(spark, rows), feats).collect()[0]
    assert out["hot"] == 0 and out["dd"] == 0.0 and out["runs"] == 0


def test_short_season_rolling_null_run_zero(spark):
    days = _days("2001-05-20", 5)
    rows = [("01", d, 20.0, 2.0) for d in days]
    feats = [Feature("roll", "floraison", "roll_max", value="rr", window=10),
             Feature("ep", "floraison", "run_rows", (Term("tx", ">", 30.0),), min_len=3)]
    out = build_mart(_panel(spark, rows), feats).collect()[0]
    assert out["roll"] is None and out["ep"] == 0
    assert feature_frame(_panel(spark, rows), feats[0]).count() == 0


def test_absent_season_gives_nulls(spark):
    rows = [("01", d, 31.0, 1.0) for d in _days("2001-05-20", 5)]       # floraison
    rows += [("01", d, 31.0, 1.0) for d in _days("2001-07-01", 5)]      # remplissage
    rows += [("02", d, 31.0, 1.0) for d in _days("2001-07-01", 5)]      # remplissage only
    feats = [Feature("flor_hot", "floraison", "count", (Term("tx", ">", 25.0),)),
             Feature("fill_hot", "remplissage", "count", (Term("tx", ">", 25.0),))]
    out = {r["DEPT_ID"]: r for r in build_mart(_panel(spark, rows), feats).collect()}
    assert out["02"]["flor_hot"] is None and out["02"]["fill_hot"] == 5
    assert out["01"]["flor_hot"] == 5


def test_rolling_exceed_crosses_harvest_years(spark):
    # tallage rows of two harvest years; 3-row windows per region straddle them
    rows = [("01", d, 10.0, v) for d, v in zip(_days("2000-03-29", 3), [1.0, 1.0, 9.0])]
    rows += [("01", d, 10.0, v) for d, v in zip(_days("2001-03-01", 3), [9.0, 9.0, 1.0])]
    f = Feature("wet", "tallage", "roll_exceed", value="rr", window=3, q=0.5)
    out = {r["harvest_year"]: r["wet"] for r in feature_frame(_panel(spark, rows), f).collect()}
    # sums: 2000: [11]; 2001: [19, 27, 19] -> median 19 -> strictly above: 27 only
    assert out == {2000: 0, 2001: 1}


def test_run_at_min_length_and_two_runs(spark):
    vals = [31, 31, 31, 20, 31, 31, 31, 31, 20, 31, 31]
    rows = [("01", d, float(v), 0.0) for d, v in zip(_days("2001-05-16", len(vals)), vals)]
    f_rows = Feature("days", "floraison", "run_rows", (Term("tx", ">", 30.0),), min_len=3)
    f_max = Feature("longest", "floraison", "run_max", (Term("tx", ">", 30.0),))
    out = build_mart(_panel(spark, rows), [f_rows, f_max]).collect()[0]
    assert out["days"] == 7          # rows inside runs >= 3 (3 + 4), not 2 episodes
    assert out["longest"] == 4


def test_threshold_is_strict(spark):
    rows = [("01", d, v, 0.0) for d, v in zip(_days("2001-05-20", 3), [25.0, 25.0, 25.5])]
    f = Feature("hot", "floraison", "count", (Term("tx", ">", 25.0),))
    assert build_mart(_panel(spark, rows), [f]).collect()[0]["hot"] == 1


def test_quantile_threshold_is_strict(spark):
    rows = [("01", d, 20.0, v) for d, v in zip(_days("2001-05-20", 5), [0.0, 0.0, 0.0, 0.0, 5.0])]
    # P10 of rain is 0 -> rain < 0 never holds (reproduced, not "fixed")
    f = Feature("drought", "floraison", "joint_count",
                (Term("tx", ">", 15.0), Term("rr", "<", Quantile(0.1, "region_year"))))
    assert build_mart(_panel(spark, rows), [f]).collect()[0]["drought"] == 0


def test_plan_exchanges(spark):
    pdf = bf.random_daily_panel(2, n_dept=2)
    df = build_mart(_spark_panel(spark, pdf), DAILY_FEATURES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the panel by (region, stage); then one partial row per (region, stage, year), and
    # the region's rows for the quantile of stage means
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    names = [re.findall(r"(\w+)#", k) for k in keys]
    assert sorted(names) == [["DEPT_ID"], ["DEPT_ID", "harvest_year"], ["DEPT_ID", "saison"]]


def test_approx_quantile_option(spark):
    pdf = bf.random_daily_panel(4, n_dept=2)
    exact = override(DAILY_FEATURES, ROUNDED)
    approx = [f.with_(approx=True) if f.kind in ("roll_exceed", "mean_exceed") else f
              for f in exact]
    approx = [f.with_(terms=tuple(Term(t.role, t.op, Quantile(t.threshold.q, t.threshold.scope, True))
                                  if isinstance(t.threshold, Quantile) else t for t in f.terms))
              for f in approx]
    panel = _spark_panel(spark, pdf)
    a = build_mart(panel, approx).toPandas().sort_values(["DEPT_ID", "harvest_year"])
    e = build_mart(panel, exact).toPandas().sort_values(["DEPT_ID", "harvest_year"])
    assert list(a.columns) == list(e.columns) and len(a) == len(e)
    same = [f.name for f in exact if f.kind not in ("roll_exceed", "mean_exceed")
            and not any(isinstance(t.threshold, Quantile) for t in f.terms)]
    _compare(a[["DEPT_ID", "harvest_year"] + same], e[["DEPT_ID", "harvest_year"] + same])


def test_hourly_reference_defaults_all_stages(spark):
    rng = np.random.default_rng(9)
    hours = pd.date_range("2019-12-01", "2020-08-31 23:00", freq="h")
    rows = []
    for d in ("01", "59"):
        keep = rng.random(len(hours)) > 0.03
        base = 14 + 12 * np.sin((hours.dayofyear.to_numpy() - 110) / 365 * 2 * np.pi)
        temp = np.round(base + 5 * np.sin(hours.hour.to_numpy() / 24 * 2 * np.pi)
                        + rng.normal(0, 2, len(hours)))
        rain = np.round(np.maximum(0, rng.normal(-0.5, 1.5, len(hours))), 1)
        hum = np.round(rng.uniform(70, 100, len(hours)))
        rad = np.round(rng.uniform(0, 300, len(hours)), -1)
        gust = np.round(rng.uniform(0, 25, len(hours)))
        for i in np.flatnonzero(keep):
            rows.append({"DEPT_ID": d, "datetime": hours[i].to_pydatetime(),
                         "temp_air_c": float(temp[i]), "precipitations_1h_mm": float(rain[i]),
                         "humidite_relative_pct": float(hum[i]),
                         "rayonnement_global_jcm2": float(rad[i]), "rafale_max_ms": float(gust[i])})
    pdf = pd.DataFrame(rows)
    pdf.loc[rng.random(len(pdf)) < 0.01, "temp_air_c"] = np.nan
    ts = pd.to_datetime(pdf["datetime"])
    pdf["harvest_year"] = (ts.dt.year + (ts.dt.month >= 9).astype(int)).astype("int32")
    feats = override(HOURLY_FEATURES, {f.name: {"ndigits": 6} for f in HOURLY_FEATURES
                                       if f.kind in ("roll_max", "roll_exceed", "mean_exceed")})
    got = build_mart(_spark_panel(spark, pdf, "datetime"), feats, time_col="datetime").toPandas()
    exp = bf.mart(bf.with_season(pdf, "datetime"), feats, time_col="datetime")
    _compare(got, exp)
    assert got["floraison_cumul_pluie_10j_max"].notna().all()
