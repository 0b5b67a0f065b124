"""The run log over several models, promotions and regions, with a gap in the years."""

import pytest
from pyspark.sql import functions as F

from harvestlens.operators.dataset import TemporalSplit
from harvestlens.plans.runlog import RunLog

SPLIT = TemporalSplit(train_max_year=2010, test_min_year=2012)


@pytest.fixture()
def fields(spark):
    """Four regions; region D has no 2013; the target is linear in both inputs."""
    rows = []
    for k, region in enumerate("ABCD"):
        for year in range(2001, 2017):
            if (region, year) != ("D", 2013):
                rain, heat = float((7 * year + 3 * k) % 11), float((5 * year + k) % 7)
                rows.append((region, year, 2.0 + 0.5 * rain - 0.25 * heat, rain, heat))
    return spark.createDataFrame(rows, "DEPT_ID string, ANNEE int, RENDEMENT double, rain double, heat double")


@pytest.fixture()
def log(spark, tmp_path):
    return RunLog(spark, str(tmp_path / "log"))


def test_an_empty_log_knows_nothing(log):
    assert log.runs().count() == 0 and log.latest().count() == 0
    with pytest.raises(LookupError, match="no production run"):
        log.production_run("ridge_default")
    with pytest.raises(LookupError, match="unknown run"):
        log.run_info("nothing")


def test_an_unreadable_log_is_an_error(spark, tmp_path):
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        RunLog(spark, str(tmp_path)).runs().collect()


def test_second_promotion_replaces_the_first(fields, log):
    first = log.train_and_register(fields, "ridge_default", ["rain"], SPLIT)
    second = log.train_and_register(fields, "ridge_default", ["rain", "heat"], SPLIT, extra_params={"note": 2})
    other = log.train_and_register(fields, "lag1", [], SPLIT)
    log.promote("ridge_default", first)
    log.promote("lag1", other)
    log.promote("ridge_default", second)
    assert {r.model_id: r.run_id for r in log.production().collect()} == {"ridge_default": second, "lag1": other}
    assert {r.run_id for r in log.runs("ridge_default").collect()} == {first, second}
    assert {r.model_id: r.run_id for r in log.latest().collect()} == {"ridge_default": second, "lag1": other}
    a, b = log.run_info(first), log.run_info(second)
    assert b["params"]["note"] == "2" and "note" not in a["params"]
    assert a["metrics"]["n_test"] == b["metrics"]["n_test"] == 4 * 5 - 1
    assert b["metrics"]["mae"] < a["metrics"]["mae"]       # heat explains the rest

    keys = ["DEPT_ID", "ANNEE"]
    scored = log.predict_production(fields, "ridge_default")
    assert {r.model_run_id for r in scored.select("model_run_id").distinct().collect()} == {second}
    both = scored.select(*keys, "yield_pred").join(
        log.predict_run(fields, first).select(*keys, F.col("yield_pred").alias("old")), keys)
    assert both.count() == fields.count() and both.filter("yield_pred != old").count() > 0


def test_the_lag_rule_skips_the_gap(fields, log):
    run = log.train_and_register(fields, "lag1", [], SPLIT)
    info = log.run_info(run)
    assert info["model_path"] is None and info["metrics"]["n_test"] == 4 * 5 - 2
    pred = {(r.DEPT_ID, r.ANNEE): r.yield_pred for r in log.predict_run(fields, run).collect()}
    truth = {(r.DEPT_ID, r.ANNEE): r.RENDEMENT for r in fields.collect()}
    for (region, year), p in pred.items():
        assert p == truth.get((region, year - 1))
    assert pred["D", 2014] is None and sum(p is None for p in pred.values()) == 5


def test_overlapping_years_are_no_split():
    for train, test in ((2012, 2012), (2013, 2012)):
        with pytest.raises(ValueError, match="test_min_year"):
            TemporalSplit(train, test)


def test_two_promotions_at_once(spark, fields, log, monkeypatch):
    """A promotion that another one overtakes is made again: both are on record, the later
    version wins, whatever the clocks say."""
    first = log.train_and_register(fields, "ridge_default", ["rain"], SPLIT, run_id="a")
    second = log.train_and_register(fields, "ridge_default", ["heat"], SPLIT, run_id="b")
    from harvestlens.sources.versions import Manifest
    create, overtaken = Manifest._create, []

    def slow_create(self, version, content):
        if not overtaken:
            overtaken.append(True)
            RunLog(spark, log.root).promote("ridge_default", second)
        return create(self, version, content)

    monkeypatch.setattr(Manifest, "_create", slow_create)
    log.promote("ridge_default", first)
    monkeypatch.undo()
    assert log.production_run("ridge_default") == first
    assert [(h["pointer"], h["run_id"]) for h in log.history()] == [
        ("latest", first), ("latest", second), ("production", second), ("production", first)]
    assert [h["version"] for h in log.history()] == [1, 2, 3, 4]
    assert log.latest().collect()[0].run_id == second


def test_score_table(spark, tmp_path):
    from harvestlens.plans.scoring import ScoreTable
    rows = [(f"{d:02d}", y, None if y == 2003 and d < 3 else d + y / 1000, d + y / 1000 + 0.5, "run") for d in range(40) for y in range(2000, 2004)]
    df = spark.createDataFrame(rows, "DEPT_ID string, harvest_year int, RENDEMENT double, yield_pred double, model_run_id string").repartition(6)
    table = ScoreTable(spark, str(tmp_path / "s")).write(df)
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(rows, key=str)
    assert table.lookup("05", 2001) == {"prediction": 5 + 2.001 + 0.5, "actual": 5 + 2.001, "model_run_id": "run"}
    assert table.lookup("01", 2003)["actual"] is None
    for region, year in (("5", 2001), ("99", 2001), ("05", 1999)):
        with pytest.raises(LookupError, match="no row"):
            table.lookup(region, year)
    m = table.metrics(2003).first()
    assert m.n == 37 and m.mae == pytest.approx(0.5) and table.metrics().first().n == 157
    plan = table.rows_of("05", 2001)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(DEPT_ID,05)" in pushed and "EqualTo(harvest_year,2001)" in pushed
    # the files carry a Bloom filter on the region and keep the key order
    import glob
    import pyarrow.parquet as pq
    for f in glob.glob(str(tmp_path / "s" / "*.parquet")):
        keys = list(zip(*pq.read_table(f, columns=["DEPT_ID", "harvest_year"]).to_pydict().values()))
        assert keys == sorted(keys)
