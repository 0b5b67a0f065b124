"""Property test: run kernels of the one-pass mart vs a plain Python loop."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from harvestlens.operators.features import Feature, Term
from harvestlens.operators.mart import build_mart, label_stages

CELL = st.one_of(st.none(), st.sampled_from([20.0, 30.0, 31.0, 35.0]))
SEQS = st.lists(st.lists(st.tuples(st.booleans(), CELL), min_size=1, max_size=25),
                min_size=1, max_size=12)


def loop_runs(values, thr, min_len):
    """Longest run and rows inside runs >= min_len; NULL breaks a run."""
    best = cur = rows = 0
    for v in values + [None]:
        if v is not None and v > thr:
            cur += 1
            best = max(best, cur)
        else:
            if cur >= min_len:
                rows += cur
            cur = 0
    return best, rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SEQS)
def test_runs_match_loop(spark, seqs):
    d0 = dt.date(2001, 5, 16)                       # floraison starts
    rows, expected = [], {}
    for k, seq in enumerate(seqs):
        region = f"{k:02d}"
        vals = []
        day = 0
        for missing_before, v in seq:
            day += 2 if missing_before else 1        # a missing day does not break a run
            if day > 30:
                break
            rows.append((region, d0 + dt.timedelta(days=day - 1), v))
            vals.append(v)
        expected[region] = loop_runs(vals, 30.0, 3)
    df = spark.createDataFrame(rows, "DEPT_ID string, day date, temp_max_c double")
    feats = [Feature("longest", "floraison", "run_max", (Term("tx", ">", 30.0),)),
             Feature("days", "floraison", "run_rows", (Term("tx", ">", 30.0),), min_len=3)]
    got = {r["DEPT_ID"]: (r["longest"], r["days"])
           for r in build_mart(label_stages(df, "day"), feats).collect()}
    assert got == expected
