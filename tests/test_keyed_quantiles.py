"""Quantiles per key and imputation from value counts, against NumPy and pandas."""

import numpy as np
import pandas as pd
import pytest

from harvestlens.operators import impute
from harvestlens.operators import quantile as qt

QS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def _panel(seed, n=600, regions=("A", "B", "C", None), hot=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        r = "A" if rng.random() < hot else regions[rng.integers(len(regions))]
        y = None if rng.random() < 0.03 else int(rng.integers(2000, 2004))
        # ties, missing values, an empty column, a whole key without values
        x = None if rng.random() < 0.3 or (r == "C" and y == 2001) else float(rng.integers(-6, 6)) / 4
        z = float("nan") if rng.random() < 0.2 else float(rng.normal())
        rows.append((r, y, x, z, None))
    return rows


SCHEMA = "r string, y int, x double, z double, e double"


@pytest.mark.parametrize("hot,rows_per_bucket", [(0.0, 200_000), (0.9, 5), (0.9, 200_000)])
def test_keyed_quantiles(spark, monkeypatch, hot, rows_per_bucket):
    monkeypatch.setattr(qt, "ROWS_PER_BUCKET", rows_per_bucket)
    rows = _panel(3, hot=hot)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    counts = qt.value_counts(df, ["r", "y"], ["x", "z", "e"])
    bounds, missing = qt.value_ranges(counts)
    pdf = pd.DataFrame(rows, columns=["r", "y", "x", "z", "e"]).astype({"e": float})
    assert missing == {i: int(pdf[c].isna().sum()) for i, c in enumerate("xze")}
    assert (len(bounds[1]) > 30) == (rows_per_bucket == 5)
    for keys in (["r", "y"], ["r"], []):
        got = {tuple(r[:-len(QS)]): r[-len(QS):] for r in qt.keyed_quantiles(counts, keys, QS, bounds).collect()}
        want = {}
        groups = pdf.dropna(subset=keys).groupby(keys) if keys else [((), pdf)]
        for key, g in groups:
            for k, c in enumerate("xze"):
                v = g[c].dropna().to_numpy()
                if len(v):
                    want[(*(key if isinstance(key, tuple) else (key,)), k)] = np.quantile(v, QS)
        assert set(got) == set(want)
        for key, q in want.items():
            assert got[key] == pytest.approx(q, abs=1e-12), key


def test_a_hot_key_is_cut(spark, monkeypatch):
    """With 90 % of the rows under one key no value range of it holds more than a few percent."""
    monkeypatch.setattr(qt, "ROWS_PER_BUCKET", 100)
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("A" if rng.random() < 0.9 else "B", float(v)) for v in rng.normal(size=8000)], "r string, x double")
    counts = qt.value_counts(df, ["r"], ["x"])
    bounds, _ = qt.value_ranges(counts)
    sizes = [r["count"] for r in counts.select("r", qt._range_of(bounds).alias("b")).groupBy("r", "b").count().collect()]
    assert max(sizes) < 0.05 * 8000


def _by_hand(rows, cols, levels):
    out = pd.DataFrame(rows, columns=["r", "y", "x", "z", "e"]).astype({"e": float})
    for lv in levels:
        for c in cols:
            if lv:
                med = out.dropna(subset=lv).groupby(lv)[c].transform("median")
                out[c] = out[c].fillna(med)
            else:
                out[c] = out[c].fillna(out[c].median())
    return out


@pytest.mark.parametrize("levels", [[["r", "y"], ["r"]], [["r", "y"], ["r"], []], [["y"], ["r"]], [[]]])
def test_imputation_by_levels(spark, levels):
    rows = _panel(5)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + SCHEMA).repartition(3)
    got = impute.impute_levels(df, ["x", "z", "e"], levels)
    assert got.columns == df.columns
    got = got.toPandas().sort_values("i").reset_index(drop=True)
    want = _by_hand(rows, ["x", "z", "e"], levels)
    for c in "xze":
        assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True), c


def test_imputation_reads_its_input_once_more(spark, tmp_path):
    path = str(tmp_path / "panel")
    spark.createDataFrame(_panel(7), SCHEMA).write.parquet(path)
    for levels in ([["r", "y"], ["r"]], [["r", "y"], ["r"], []]):
        out = impute.impute_levels(spark.read.parquet(path), ["x", "z"], levels)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("/panel]") == 1, plan  # counted in one job before, filled here
