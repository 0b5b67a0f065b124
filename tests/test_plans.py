"""Regression guard on physical plans of registered queries."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
BAD = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"]


def _plan(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["mart_daily", "mart_hourly", "split_random", "metrics",
                                 "scale_robust", "zscore_static", "impute_three_level",
                                 "production_long", "sequence_pad", "feature_engineering"])
def test_no_non_scaling_operators(spark, key):
    plan = _plan(spark, key)
    assert not [b for b in BAD if b in plan], plan


def test_mart_shuffles(spark):
    plan = _plan(spark, "mart_daily")
    # the panel is aggregated, then dealt by (region, stage) once; what follows are
    # partial rows per (region, stage, year)
    assert plan.count("REPARTITION_BY_COL") == 1, plan
    assert plan.count("Exchange hashpartitioning") <= 4, plan


def test_training_mart_is_lazy(spark):
    """Filters and column lists reach the scans: no checkpoint stands between."""
    plan = _plan(spark, "split_temporal")
    assert "FileScan parquet" in plan and "Scan ExistingRDD" not in plan, plan
    assert "l_partkey" not in plan, plan  # soil columns are pruned away
