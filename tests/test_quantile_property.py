"""Property test: exact global quantiles vs NumPy."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from harvestlens.operators.quantile import global_quantiles

VALUES = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda i: i / 4)),
                  min_size=1, max_size=300)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(VALUES, st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_quantile_matches_numpy(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = global_quantiles(df, ["x"], [q])[("x", q)]
    known = np.array([v for v in values if v is not None])
    if known.size == 0:
        assert got is None
    else:
        assert got == pytest.approx(np.quantile(known, q), abs=1e-9)


def test_many_columns_at_once_with_a_hot_value(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), 7.0 if i % 3 else float(b), None) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    qs = [0.25, 0.5, 0.75]
    got = global_quantiles(df, ["a", "b", "c"], qs)
    for k, c in enumerate("ab"):
        assert [got[c, q] for q in qs] == pytest.approx(np.quantile([r[k] for r in rows], qs), abs=1e-12)
    assert [got["c", q] for q in qs] == [None] * 3
