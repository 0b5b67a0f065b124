"""The hourly sequence dataset, value by value, against NumPy."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestlens.operators.mart import label_stages
from harvestlens.plans.sequences import sequence_dataset

LENGTH = 6


def test_sequence_dataset_values(spark):
    start = {y: datetime.datetime(y, 5, 20) for y in (2009, 2011, 2012, 2013)}
    rows, rng = [], np.random.default_rng(1)
    for region in ("01", "02", "99"):
        for y, t in start.items():
            for h in range(4 if y == 2012 else 8):  # shorter and longer than the sequence
                rows.append((region, t + datetime.timedelta(hours=h),
                             None if (region, y, h) == ("01", 2011, 2) else float(rng.normal(10, 3))))
    panel = label_stages(spark.createDataFrame(rows, "DEPT_ID string, datetime timestamp, t double"), "datetime")
    static = spark.createDataFrame(
        [(r, y, 5.0 + k + y % 10, float(k * y % 7)) for k, r in enumerate(("01", "02", "99"))
         for y in (2009, 2010, 2011, 2012, 2013, 2020)],
        "DEPT_ID string, harvest_year int, RENDEMENT double, s double")
    data, feats = sequence_dataset(panel, static, ["s"], length=LENGTH, excluded=["99"], min_year_exclusive=2010,
                                   max_year=2015, train_max=2011, val_years=(2012,), test_min=2013, target="RENDEMENT")
    got = {(r.DEPT_ID, r.harvest_year): r for r in data.collect()}
    # the lower bound holds for the pairs; weather may be absent (2020)
    assert set(got) == {(r, y) for r in ("01", "02") for y in (2011, 2012, 2013, 2020)}
    assert got["02", 2011].RENDEMENT == 5.0 + 1 + 1
    assert {k[1]: r.split for k, r in got.items()} == {2011: "train", 2012: "val", 2013: "test", 2020: "test"}

    i = feats.index("t")
    series = {}
    for region, t, v in rows:
        series.setdefault((region, t.year), []).append(v)
    # the missing value: median of its (region, hour)
    others = [series["01", y][2] for y in (2012, 2013)]
    series["01", 2011][2] = float(np.median(others))
    padded = {k: (series.get(k, []) + [0.0] * LENGTH)[:LENGTH] for k in got}
    train = np.array([padded["01", 2011], padded["02", 2011]])
    for k, r in got.items():
        want = (np.array(padded[k]) - train.mean()) / train.std()
        assert [step[i] for step in r.seq] == pytest.approx(list(want))
        assert r.n_steps == min(len(series.get(k, [])), LENGTH)
    s = np.array([static.filter(F.col("harvest_year") == 2011).orderBy("DEPT_ID").collect()[k].s for k in (0, 1)])
    assert got["01", 2013].s == pytest.approx((0.0 - s.mean()) / s.std())
