"""Searches: what is prepared once, what is drawn, and that learning from trials helps."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression

from harvestlens.operators import models, search
from harvestlens.operators.search import Choice, DensityRatioSampler, Range

SPACE = {"rate": Range(1e-4, 1.0, log=True), "share": Range(0.0, 1.0), "trees": Range(10, 500, integer=True, log=True),
         "kind": Choice(("a", "b", "c", "d"))}


def _loss(p):
    return ((math.log10(p["rate"]) + 2) ** 2 + 4 * (p["share"] - 0.3) ** 2
            + (math.log(p["trees"] / 120)) ** 2 + (p["kind"] != "c"))


def test_learning_from_trials_beats_chance():
    learned, drawn = [], []
    for seed in range(12):
        learned.append(search.minimise(DensityRatioSampler(SPACE, seed), _loss, 60)[1])
        rng = random.Random(seed)
        drawn.append(min(_loss({n: search._draw(s, rng) for n, s in SPACE.items()}) for _ in range(60)))
    assert sum(a < b for a, b in zip(learned, drawn)) >= 10
    assert sum(learned) < 0.5 * sum(drawn)


def test_draws_stay_in_their_ranges():
    sampler = DensityRatioSampler(SPACE, 3)
    search.minimise(sampler, lambda p: math.nan if p["kind"] == "a" else _loss(p), 40)
    for p, _ in sampler.trials:
        assert 1e-4 <= p["rate"] <= 1 and 0 <= p["share"] <= 1 and 10 <= p["trees"] <= 500
        assert isinstance(p["trees"], int) and p["kind"] in "abcd"
    again = DensityRatioSampler(SPACE, 3)
    search.minimise(again, lambda p: math.nan if p["kind"] == "a" else _loss(p), 40)
    assert [p for p, _ in again.trials] == [p for p, _ in sampler.trials]
    # the ends of an integer range come up too, and a log range is even in its logarithm
    rng = random.Random(1)
    drawn = [search._draw(Range(1, 3, integer=True), rng) for _ in range(300)]
    assert {x: drawn.count(x) > 60 for x in (1, 2, 3)} == {1: True, 2: True, 3: True}
    assert 0.4 < sum(search._draw(SPACE["rate"], rng) < 1e-2 for _ in range(500)) / 500 < 0.6


def test_densities_are_densities():
    for values in ([], [0.2, 0.2, 0.9], [0.0, 1.0]):
        d = search._Parzen(Range(0.0, 1.0), values)
        assert sum(math.exp(d.log_density((i + 0.5) / 1000)) for i in range(1000)) / 1000 == pytest.approx(1, abs=1e-3)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = []
    for i in range(120):
        a, b = rng.gauss(0, 1), rng.gauss(5, 2)
        data.append((f"r{i}", 3 * a - b + rng.gauss(0, 0.1), a if i % 10 else None, b))
    return spark.createDataFrame(data, "id string, y double, a double, b double")


def test_folds_are_prepared_once(rows, monkeypatch):
    fits = []
    fit = Pipeline.fit

    def counted(self, *args, **kw):
        fits.append(self)
        return fit(self, *args, **kw)

    monkeypatch.setattr(Pipeline, "fit", counted)
    lr = LinearRegression(featuresCol="features", labelCol="y", predictionCol="yield_pred")
    for maps in (2, 6):
        fits.clear()
        found = models.random_search(Pipeline(stages=models.prep_stages(["a", "b"]) + [lr]), lr,
                                     {"regParam": [0.0, 10.0, 1.0], "elasticNetParam": [0.0, 1.0]}, maps, rows, ["a", "b"], "y", ["id"],
                                     k=3, metric="mae")
        assert len(fits) == 3 + 1 and found.preparations == 3  # the folds' and the refit's
        assert len(found.trials) == maps
    assert found.best["regParam"] == 0.0 and min(s for _, s in found.trials) == dict(
        (tuple(sorted(p.items())), s) for p, s in found.trials)[tuple(sorted(found.best.items()))]
    scored = models.predict(found.model, rows, ["a", "b"], ["id", "y"])
    assert scored.count() == 120


def test_prepared_folds_equal_a_pipeline_per_map(rows):
    """The mean score is that of fitting the whole pipeline anew on each fold."""
    lr = LinearRegression(featuresCol="features", labelCol="y", predictionCol="yield_pred")
    mae = RegressionEvaluator(labelCol="y", predictionCol="yield_pred", metricName="mae")
    data = models.fold_table(rows, ["a", "b"], "y", ["id"], 3)
    folds = search.prepare_folds(models.prep_stages(["a", "b"]), data, "y", "fold", 3)
    want = 0.0
    for k in range(3):
        whole = Pipeline(stages=models.prep_stages(["a", "b"]) + [lr.copy({lr.regParam: 0.5})])
        want += mae.evaluate(whole.fit(data.filter(data.fold != k)).transform(data.filter(data.fold == k))) / 3
    assert search.score_map(folds, lr, {"regParam": 0.5}, mae) == pytest.approx(want, abs=1e-9)


def test_density_ratio_search(rows):
    lr = LinearRegression(featuresCol="features", labelCol="y", predictionCol="yield_pred")
    mae = RegressionEvaluator(labelCol="y", predictionCol="yield_pred", metricName="mae")
    found = search.density_ratio_search(models.prep_stages(["a", "b"]), lr, {"regParam": Range(1e-3, 10.0, log=True)}, 8,
                                        models.fold_table(rows, ["a", "b"], "y", ["id"], 3), "y", "fold", 3, mae, startup=3)
    assert len(found.trials) == 8 and found.best in [p for p, _ in found.trials]
    assert dict((p["regParam"], s) for p, s in found.trials)[found.best["regParam"]] == min(s for _, s in found.trials)
