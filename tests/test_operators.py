"""Sources, cleaning, imputation, reshaping, splits and scaling."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harvestlens.functions.calendar import crop_stage, harvest_year, pad_code
from harvestlens.operators import dataset as ds
from harvestlens.operators.cleaning import clean_target, exclude_pairs, region_codes_from_label
from harvestlens.operators.impute import impute_levels, impute_three_level, null_profile
from harvestlens.operators.reshape import (attach_sequences, melt_measure, null_safe_join,
                                           sequences)
from harvestlens.sources.catalog import Catalog, Dataset, id_from_path, promote_header
from harvestlens.sources.stations import (consolidate, daily_from_hourly, read_consolidated,
                                          station_to_region_hourly)


def test_crop_stage_cutoffs(spark):
    cases = {"2001-09-01": "semis", "2001-11-30": "semis", "2001-12-01": "vernalisation",
             "2002-02-28": "vernalisation", "2002-03-01": "tallage", "2002-04-15": "tallage",
             "2002-04-16": "montaison", "2002-05-15": "montaison", "2002-05-16": "floraison",
             "2002-06-15": "floraison", "2002-06-16": "remplissage", "2002-08-31": "remplissage"}
    df = spark.createDataFrame([(k,) for k in cases], "d string").withColumn("d", F.to_date("d"))
    got = {str(r["d"]): r["s"] for r in df.select("d", crop_stage("d").alias("s")).collect()}
    assert got == cases
    hy = df.select(harvest_year("d").alias("hy"), "d").collect()
    assert {str(r["d"]): r["hy"] for r in hy}["2001-09-01"] == 2002
    assert {str(r["d"]): r["hy"] for r in hy}["2002-08-31"] == 2002


def test_region_codes_and_target(spark):
    rows = [("001 - Ain", "2001", 7.0, "a"), ("02A - Corse-du-Sud", "2001", 6.0, "a"),
            ("971 - Guadeloupe", "2001", 5.0, "a"), ("059 - Nord", "2001", None, "a")]
    df = spark.createDataFrame(rows, "LIB_DEP string, ANNEE string, RENDEMENT double, x string")
    coded = region_codes_from_label(df, "LIB_DEP")
    got = {r["DEPT_ID"]: r["DEPT"] for r in coded.collect()}
    # name = text from the 5th character on (the reference's rule, kept as is)
    assert got == {"01": " Ain", "2A": " Corse-du-Sud", "59": " Nord"}
    t = coded.withColumns({"TYPE BLE": F.lit("x"), "SURFACE": F.lit(1.0), "PRODUCTION": F.lit(1.0)})
    assert sorted(r["DEPT_ID"] for r in clean_target(t).collect()) == ["01"]
    with pytest.raises(KeyError):
        clean_target(coded)


def test_pad_code_and_exclusions(spark):
    df = spark.createDataFrame([(1, 2012), (13, 2012), (13, 2013), (75, 2010)], "c int, hy int")
    df = df.withColumn("DEPT_ID", pad_code("c")).withColumnRenamed("hy", "harvest_year")
    out = exclude_pairs(df, min_year_exclusive=2010, max_year=2024, pairs=[("13", 2012)])
    assert sorted((r["DEPT_ID"], r["harvest_year"]) for r in out.collect()) == [
        ("01", 2012), ("13", 2013)]


def test_second_level_median_after_first_fill(spark):
    # region A: year 1 all null, year 2 values [1, 2, 9]
    rows = [("A", 1, None), ("A", 1, None), ("A", 2, 1.0), ("A", 2, 2.0), ("A", 2, 9.0)]
    df = spark.createDataFrame(rows, "DEPT_ID string, harvest_year int, v double")
    out = impute_levels(df, ["v"], [["DEPT_ID", "harvest_year"], ["DEPT_ID"]])
    got = sorted(r["v"] for r in out.collect())
    # level 1 fills nothing in year 1; level 2 median over [1, 2, 9] = 2
    assert got == [1.0, 2.0, 2.0, 2.0, 9.0]
    prof = null_profile(out, ["v"]).first()
    assert prof["v"] == 0


def test_three_level_uses_filled_column(spark):
    rows = [("A", 0, None), ("A", 1, 4.0), ("B", 0, None), ("B", 1, None), ("C", 0, 10.0)]
    df = spark.createDataFrame(rows, "DEPT_ID string, heure int, v double")
    out = {(r["DEPT_ID"], r["heure"]): r["v"] for r in impute_three_level(df, ["v"]).collect()}
    assert out[("A", 0)] == 4.0                 # region median
    assert out[("B", 0)] == out[("B", 1)] == 4.0  # global median of [4, 4, 10] after level 2


def test_melt_keeps_nulls_and_null_keys_match(spark):
    rows = [("01", None, 1.0, None, 3.0, 4.0), ("02", "x", None, 2.0, 5.0, None)]
    df = spark.createDataFrame(rows, "DEPT_ID string, S string, REND_2020 double, "
                                     "REND_2021 double, SURF_2020 double, SURF_2021 double")
    r = melt_measure(df, ["DEPT_ID", "S"], "REND_", "RENDEMENT")
    s = melt_measure(df, ["DEPT_ID", "S"], "SURF_", "SURFACE")
    assert r.count() == 4 and r.filter(F.col("RENDEMENT").isNull()).count() == 2
    j = null_safe_join(r, s, ["DEPT_ID", "S", "ANNEE"])
    assert j.count() == 4                        # the NULL key of region 01 matches itself
    assert {row["ANNEE"] for row in j.collect()} == {"2020", "2021"}


def test_sequences_pad_and_truncate(spark):
    rows = [("A", 1, i, float(i)) for i in range(5)] + [("B", 1, i, 1.0) for i in range(2)]
    df = spark.createDataFrame(rows, "DEPT_ID string, harvest_year int, t int, x double")
    seqs = sequences(df, ["DEPT_ID", "harvest_year"], "t", ["x"], 3)
    got = {r["DEPT_ID"]: r["seq"] for r in seqs.collect()}
    assert got["A"] == [[0.0], [1.0], [2.0]]
    assert got["B"] == [[1.0], [1.0], [0.0]]
    pairs = spark.createDataFrame([("A", 1), ("C", 1)], "DEPT_ID string, harvest_year int")
    att = {r["DEPT_ID"]: r for r in attach_sequences(pairs, seqs, ["DEPT_ID", "harvest_year"],
                                                      3, 1).collect()}
    assert att["C"]["seq"] == [[0.0]] * 3 and att["C"]["n_steps"] == 0


def test_random_split_share(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    out = ds.random_split(df, ["k"], 0.2, 42)
    assert out.filter(F.col("split") == "test").count() == math.ceil(0.2 * 1001)
    hashed = out.select(ds.hash_key(["k"], 42).alias("h"), "split").toPandas().sort_values("h")
    assert (hashed.split.tolist() == ["test"] * 201 + ["train"] * 800)
    for share, n in ((0.0, 0), (1.0, 1001)):
        assert ds.random_split(df, ["k"], share, 42).filter("split = 'test'").count() == n
    assert ds.random_split(df.limit(0), ["k"], 0.2, 42).count() == 0


def test_scalers_and_metrics(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(1, 11)], "x double, z double")
    mm = ds.apply_minmax(df, ds.fit_minmax(df, ["x"]), ["x"]).toPandas()
    assert mm["x"].min() == 0.0 and mm["x"].max() == 1.0
    rb = ds.apply_robust(df, ds.fit_robust(df, ["x"]), ["x"]).toPandas()
    x = np.arange(1, 11, dtype=float)
    iqr = np.percentile(x, 75) - np.percentile(x, 25)
    assert np.allclose(rb["x"], (x - np.median(x)) / iqr)
    zs = ds.apply_zscore(df, ds.fit_zscore(df, ["x"]), ["x"]).toPandas()
    assert np.allclose(zs["x"], (x - x.mean()) / x.std())
    m = ds.regression_metrics(df.withColumn("p", F.col("x") + 1), "x", "p").first()
    assert m["mae"] == 1.0 and m["rmse"] == 1.0 and m["n"] == 10
    assert m["r2"] == pytest.approx(1 - 10 / ((x - x.mean()) ** 2).sum())


def test_padded_moments_count_padding(spark):
    rows = spark.createDataFrame([(2.0,), (4.0,)], "x double")
    mom = ds.padded_moments(rows, ["x"], 1, 4).first()
    arr = np.array([2.0, 4.0, 0.0, 0.0])
    assert mom["x_mean"] == pytest.approx(arr.mean())
    assert mom["x_std"] == pytest.approx(arr.std())


def test_catalog_errors_and_region_paths(spark, tmp_path):
    p = tmp_path / "dept_01.parquet"
    spark.createDataFrame([(1, 2.0)], "a int, b double").write.parquet(str(p))
    cat = Catalog(spark, {"meteo_dept": Dataset(str(tmp_path / "dept_{region}.parquet"),
                                                per_region=True)})
    assert cat.read("meteo_dept", region="01").count() == 1
    with pytest.raises(ValueError):
        cat.read("meteo_dept")
    with pytest.raises(ValueError):
        cat.read("unknown")


def test_station_files_to_region_tables(spark, tmp_path):
    src = tmp_path / "stations"
    src.mkdir()
    for dept, vals in (("01", [10.0, 20.0]), ("2A", [5.0, None])):
        pd.DataFrame({"NUM_POSTE": [1, 2], "LAT": [1.0, 1.0], "LON": [2.0, 2.0],
                      "ALTI": ["100", "200"], "AAAAMMJJHH": [2024010100, 2024010100],
                      "T": vals, "RR1": [1.0, 2.0], "UNUSED": [9, 9]}).to_csv(
            src / f"dept_{dept}.csv", index=False)
    raw = spark.read.option("header", True).option("inferSchema", True).csv(str(src))
    hourly = station_to_region_hourly(raw, id_from_path())
    got = {r["dept_id"]: r for r in hourly.collect()}
    assert got["01"]["temp_air_c"] == 15.0 and got["2A"]["temp_air_c"] == 5.0
    assert "UNUSED" not in hourly.columns and "id_station" not in hourly.columns
    daily = daily_from_hourly(hourly)
    assert {r["dept_id"]: r["precipitations_1h_mm"] for r in daily.collect()} == {"01": 1.5, "2A": 1.5}
    out = str(tmp_path / "consolidated")
    consolidate(hourly, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("dept=")) == ["dept=01", "dept=2A"]
    back = read_consolidated(spark, out)
    assert sorted(r["dept_id"] for r in back.collect()) == ["01", "2A"]


def test_promote_header(spark):
    rows = [("junk", "", ""), ("junk2", "", ""), ("A", "B", "C"), ("1", "2", "3"), ("4", "5", "6")]
    df = spark.createDataFrame(rows, "_c0 string, _c1 string, _c2 string")
    out = promote_header(df, 2)
    assert out.columns == ["A", "B", "C"]
    assert sorted(tuple(r) for r in out.collect()) == [("1", "2", "3"), ("4", "5", "6")]


def test_global_quantiles_with_a_hot_value(spark):
    from harvestlens.operators.quantile import global_quantiles
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 10, 20000), 3)
    x[:7000] = 1.5                                   # a value holding a third of the rows
    pdf = pd.DataFrame({"x": x, "y": rng.integers(0, 5, 20000).astype(float)})
    pdf.loc[::97, "x"] = np.nan
    qs = [0.1, 0.25, 0.5, 0.9, 0.999]
    got = global_quantiles(spark.createDataFrame(pdf), ["x", "y"], qs)
    for c in ("x", "y"):
        assert [got[c, q] for q in qs] == pytest.approx(np.quantile(pdf[c].dropna(), qs), abs=1e-9)


def test_sequence_dataset_end_to_end(spark):
    from harvestlens.functions.calendar import crop_stage, harvest_year as hy
    from harvestlens.plans.sequences import sequence_dataset
    rows = []
    for d in ("01", "02"):
        for h in range(6):
            rows.append((d, pd.Timestamp(2020, 1, 1, h).to_pydatetime(), float(h) if h != 2 else None))
            rows.append((d, pd.Timestamp(2021, 1, 1, h).to_pydatetime(), float(h + 1)))
    panel = spark.createDataFrame(rows, "DEPT_ID string, datetime timestamp, t double")
    panel = panel.withColumns({"harvest_year": hy("datetime"), "saison": crop_stage("datetime")})
    static = spark.createDataFrame([("01", 2020, 1.0), ("02", 2020, 3.0), ("01", 2021, 5.0),
                                    ("02", 2021, 7.0), ("01", 2019, 2.0)],
                                   "DEPT_ID string, harvest_year int, s double")
    data, feats = sequence_dataset(panel, static, ["s"], length=8, min_year_exclusive=2018,
                                   max_year=2022, train_max=2020, val_years=(2021,),
                                   test_min=2022)
    out = {(r["DEPT_ID"], r["harvest_year"]): r for r in data.collect()}
    assert len(out) == 5 and "t" in feats and "heure_sin" in feats
    assert out[("01", 2019)]["n_steps"] == 0 and out[("01", 2020)]["n_steps"] == 6
    assert out[("01", 2021)]["split"] == "val"
    # train moments: pairs (01,2019), (01,2020), (02,2020) x 8 steps, padding counted
    ti = feats.index("t")
    imputed = [0.0, 1.0, 3.0, 3.0, 4.0, 5.0]          # hour-2 null -> (region, hour) median 3
    arr = np.array(imputed * 2 + [0.0] * (3 * 8 - 12))
    got = out[("01", 2020)]["seq"][1][ti]
    assert got == pytest.approx((1.0 - arr.mean()) / arr.std())
    s = np.array([2.0, 1.0, 3.0])
    assert out[("02", 2021)]["s"] == pytest.approx((7.0 - s.mean()) / s.std())


def test_daily_from_consolidated(spark, tmp_path):
    from harvestlens.sources.stations import daily_from_consolidated
    p = tmp_path / "full.csv"
    pd.DataFrame({"dept_id": ["01", "altitude_m", "01", "01"],
                  "datetime": ["2024-01-01 00:00:00", "datetime", "2024-01-01 01:00:00",
                               "2024-01-02 00:00:00"],
                  "altitude_m": ["100", "altitude_m", "100", "100"],
                  "temp_air_c": ["1.0", "temp_air_c", "3.0", ""],
                  "precipitations_1h_mm": ["1.0", "x", "", ""]}).to_csv(p, index=False)
    raw = spark.read.option("header", True).csv(str(p))
    got = {str(r["day"]): r for r in daily_from_consolidated(raw).collect()}
    assert got["2024-01-01"]["temp_air_c"] == 2.0 and got["2024-01-01"]["precipitations_1h_mm"] == 1.0
    assert got["2024-01-02"]["temp_air_c"] is None and got["2024-01-02"]["precipitations_1h_mm"] == 0.0


def test_checkpoint_dir_is_kept_when_set(spark):
    from harvestlens.session import ensure_checkpoint_dir
    before = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == before
    assert spark.sparkContext.getCheckpointDir() is not None


# ---- missing values, codes and keys as pandas treats them

def test_codes_are_padded_never_cut(spark):
    df = spark.createDataFrame([("1",), ("974",), ("2A",), (None,)], "c string")
    assert [r[0] for r in df.select(pad_code("c")).collect()] == ["01", "974", "2A", None]


def test_filter_numeric_keeps_plain_numbers_only(spark):
    from harvestlens.sources.catalog import filter_numeric
    texts = ["1", " 2.5 ", "-3e2", ".5", "NaN", "12d", "3f", "Infinity", "altitude_m", "", None, "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r.x for r in filter_numeric(df, "x").collect()] == ["1", " 2.5 ", "-3e2", ".5"]


def test_casts_raise_unless_lenient(spark):
    from harvestlens.functions.columns import cast_columns
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    with pytest.raises(Exception, match="not a double"):
        cast_columns(df, {"a": "double"}).collect()
    assert [r.a for r in cast_columns(df, {"a": "double"}, strict=False).collect()] == [1.0, None, None]


def test_null_keys_and_nan_in_aggregates(spark):
    from harvestlens.sources.stations import daily_from_hourly
    ts = "2020-01-01 0{}:00:00"
    rows = [("A", ts.format(1), 1.0), ("A", ts.format(2), float("nan")), (None, ts.format(1), 5.0), ("B", None, 5.0)]
    df = spark.createDataFrame(rows, "dept_id string, t string, temp_air_c double").withColumn(
        "datetime", F.to_timestamp("t"))
    out = daily_from_hourly(df, ["temp_air_c"], []).collect()
    assert [(r.dept_id, r.temp_air_c) for r in out] == [("A", 1.0)]


def test_imputation_treats_nan_as_missing(spark):
    from harvestlens.operators.impute import impute_levels, null_profile
    nan = float("nan")
    rows = [("A", 1, 1.0), ("A", 1, 3.0), ("A", 1, nan), ("A", 2, None), ("B", 1, None), (None, 1, nan)]
    df = spark.createDataFrame(rows, "r string, y int, x double")
    assert null_profile(df, ["x"]).first()["x"] == 4
    two = impute_levels(df, ["x"], [["r", "y"], ["r"]])
    assert two.columns == df.columns
    assert sorted((str(r.r), r.y, r.x) for r in two.collect() if r.x is not None) == [
        ("A", 1, 1.0), ("A", 1, 2.0), ("A", 1, 3.0), ("A", 2, 2.0)]
    assert {r.x for r in impute_levels(df, ["x"], [["r", "y"], ["r"], []]).collect()} == {1.0, 2.0, 3.0}


def test_lag_needs_the_year_before(spark):
    df = spark.createDataFrame([("A", 2018, 5.0), ("A", 2020, 6.0), ("A", 2021, 7.0)], "DEPT_ID string, ANNEE int, RENDEMENT double")
    assert {r.ANNEE: r.yield_pred for r in ds.lag_baseline(df).collect()} == {2018: None, 2020: None, 2021: 6.0}


def test_padded_moments_keep_digits(spark):
    import numpy as np
    x = 1e8 + np.arange(50) / 50
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = ds.padded_moments(df, ["x"], 1, 50).first()
    assert got["x_std"] == pytest.approx(x.std(), rel=1e-6) and got["x_mean"] == pytest.approx(x.mean())
    padded = np.concatenate([x, np.zeros(30)])
    got = ds.padded_moments(df, ["x"], 2, 40).first()
    assert got["x_std"] == pytest.approx(padded.std()) and got["x_mean"] == pytest.approx(padded.mean())


def test_file_names_without_id_raise(spark, tmp_path):
    from harvestlens.sources.catalog import id_from_path
    spark.range(3).write.csv(str(tmp_path / "plain"))
    with pytest.raises(Exception, match="no id in file name"):
        spark.read.csv(str(tmp_path / "plain")).select(id_from_path()).collect()


def test_imputation_changes_an_indicator(spark):
    """A heat day that is missing and imputed counts in the mart."""
    import datetime
    from harvestlens.operators.features import DAILY_FEATURES
    from harvestlens.operators.impute import impute_two_level
    from harvestlens.operators.mart import build_mart, label_stages
    rows = [("01", datetime.date(2020, 5, 20 + i), None if i == 3 else 31.0) for i in range(6)]
    panel = label_stages(spark.createDataFrame(rows, "DEPT_ID string, day date, t double"), "day")
    hot = [f for f in DAILY_FEATURES if f.name == "floraison_nb_jours_tx_gt_30"]
    roles = {"tx": "t", "ta": "t"}
    raw = build_mart(panel, hot, roles=roles).first()[hot[0].name]
    filled = build_mart(impute_two_level(panel, ["t"]), hot, roles=roles).first()[hot[0].name]
    assert (raw, filled) == (5, 6)
