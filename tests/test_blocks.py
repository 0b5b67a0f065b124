"""Windows cut in time against the window forms, for blocks of a day, a week and all."""

import itertools
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from harvestlens.operators import blocks, runs
from harvestlens.operators.features import DAILY_FEATURES, Feature, Quantile, Term, override
from harvestlens.operators.mart import build_mart, label_stages
from harvestlens.operators.mart_blocks import build_mart_blocks
from test_mart import ROUNDED, _compare, _spark_panel

WHOLE = 10 ** 11
SIZES = [blocks.DAY, 7 * blocks.DAY, WHOLE]


def _series(spark, seed, n=160):
    rng = np.random.default_rng(seed)
    rows = []
    for key in ("A", "B", None, "C"):
        days = pd.date_range("2001-11-03", periods=n)
        keep = days[rng.random(n) > 0.2] if key != "C" else days[:3]
        f = (np.cumsum(rng.random(len(keep)) < 0.2) % 2).astype(int)
        rows += [(key, d.date(), int(x), None if rng.random() < 0.05 else float(rng.integers(0, 9)))
                 for d, x in zip(keep, f)]
    return spark.createDataFrame(rows, "k string, day date, f int, v double").repartition(4)


@pytest.mark.parametrize("seconds", SIZES)
def test_run_ids(spark, seconds):
    df = _series(spark, 1)
    want = runs.run_ids(df, ["k"], "day", "f")
    got = blocks.run_ids(df, ["k"], "day", "f", seconds)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("seconds,stretch", [(SIZES[0], 1), (SIZES[1], 11), (SIZES[2], 10 ** 6)])
@pytest.mark.parametrize("n", [1, 2, 10])
def test_rolling_sums(spark, seconds, stretch, n):
    df = _series(spark, 2)
    want = runs.rolling_sum(df, ["k"], "day", "v", n, "s", ndigits=3)
    got = blocks.rolling_sum(df, ["k"], "day", "v", n, "s", ndigits=3, seconds=seconds, stretch=stretch)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def _runs_by_hand(flags, least):
    lengths = [len(list(g)) for x, g in itertools.groupby(flags) if x]
    return max(lengths, default=0), sum(n for n in lengths if n >= least)


@pytest.mark.parametrize("seconds", SIZES)
def test_run_summaries(spark, seconds):
    df = _series(spark, 3).filter("k is not null")
    flags = {"a": (F.col("f") == 1, 3), "none": (F.lit(False), 1), "all": (F.col("f") >= 0, 4), "b": (F.col("v") > 4, 1)}
    got = {r["k"]: r for r in blocks.run_summaries(df, ["k"], "day", flags, seconds).collect()}
    pdf = df.toPandas().sort_values("day")
    for k, g in pdf.groupby("k"):
        for name, x, least in (("a", g.f == 1, 3), ("none", g.f < 0, 1), ("all", g.f >= 0, 4), ("b", g.v > 4, 1)):
            assert (got[k][f"{name}_best"], got[k][f"{name}_long"]) == _runs_by_hand(x.tolist(), least), (k, name)


def test_summaries_combine_in_any_grouping(spark):
    """(a + b) + c equals a + (b + c) for all short flag rows."""
    rows = []
    for bits in itertools.product([0, 1], repeat=6):
        for i, j in itertools.combinations(range(1, 6), 2):
            rows.append(("".join(map(str, bits)), *[_summary(x) for x in (bits[:i], bits[i:j], bits[j:])]))
    df = spark.createDataFrame(rows, "bits string, " + ", ".join(f"{c} {blocks.SUMMARY}" for c in "abc"))
    a, b, c = (F.col(x) for x in "abc")
    left = blocks.combine(blocks.combine(a, b, 2), c, 2)
    right = blocks.combine(a, blocks.combine(b, c, 2), 2)
    for r in df.select("bits", left.alias("left"), right.alias("right")).distinct().collect():
        assert tuple(r.left) == tuple(r.right) == _summary(tuple(map(int, r.bits)))


def _summary(bits, least=2):
    n, groups = len(bits), [(x, len(list(g))) for x, g in itertools.groupby(bits)]
    head = groups[0][1] if groups[0][0] else 0
    tail = groups[-1][1] if groups[-1][0] else 0
    inner = sum(k for x, k in groups[1:-1] if x and k >= least)
    return n, head, tail, max((k for x, k in groups if x), default=0), inner


@pytest.mark.parametrize("seconds,stretch", [(SIZES[0], 1), (SIZES[1], 16), (SIZES[2], 10 ** 6)])
def test_mart_from_blocks(spark, seconds, stretch):
    pdf = bf.random_daily_panel(4, n_dept=2)
    feats = override(DAILY_FEATURES, ROUNDED)
    panel = _spark_panel(spark, pdf)
    got = build_mart_blocks(panel, feats, seconds=seconds, stretch=stretch).toPandas()
    assert list(got.columns) == list(build_mart(panel, feats).columns)
    _compare(got, build_mart(panel, feats).toPandas())
    if seconds == SIZES[1]:
        _compare(got, bf.mart(bf.with_season(pdf), feats))


def test_mart_from_blocks_with_few_features(spark):
    panel = _spark_panel(spark, bf.random_daily_panel(6, n_dept=2))
    for f in (Feature("x", "floraison", "run_max", terms=(Term("tx", ">", Quantile(0.8, "region_year")),)),
              Feature("x", "floraison", "run_rows", terms=(Term("tx", ">", 20.0),), min_len=2),
              Feature("x", "floraison", "roll_exceed", value="rr", window=4, q=0.5, ndigits=6)):
        _compare(build_mart_blocks(panel, [f], seconds=7 * blocks.DAY).toPandas(), build_mart(panel, [f]).toPandas())
    with pytest.raises(ValueError):
        build_mart_blocks(panel, [])


def test_no_window_holds_a_region(spark):
    """Every window over the panel's rows is cut by a block or a stretch as well; the others
    order one row per block, value range or season."""
    panel = _spark_panel(spark, bf.random_daily_panel(6, n_dept=2))
    feats = [f for f in override(DAILY_FEATURES, ROUNDED) if f.kind not in ("mean_exceed",)]
    plan = build_mart_blocks(panel, feats)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    for spec in re.findall(r"Window \[(.*?)\], \[(.*?)\], \[(.*?)\]", plan):
        if "row_number" in spec[0] or "lead" in spec[0]:
            assert "__block" in spec[1], spec
