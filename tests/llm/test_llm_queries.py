"""The registered queries: SQL agreement, contracts on whole tables, and the pipeline."""

import collections
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

from check_oracles import compare, duck  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from harvestlens.llm import queries as llm  # noqa: E402
from harvestlens.llm.common import materialize  # noqa: E402

SF = "/root/testdata/sf0.001"
Q, SQL = {}, {}
llm.register(Q, SQL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_sql(spark, key):
    cur = duck(SF).execute(SQL[key])
    want = cur.fetchall()
    df = Q[key](spark, SF)
    assert compare([tuple(r) for r in df.collect()], df.columns, want, [d[0] for d in cur.description]) is None


def test_native_queries_run_no_python(spark):
    for key in ("op1_line_dedup", "op7_decontamination", "op10_hilbert_sharding"):
        plan = Q[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_one_query_per_operator():
    numbers = collections.Counter(int(k[2:].split("_")[0]) for k in Q)
    assert numbers == dict.fromkeys(range(1, 14), 1)


def test_pipeline_stages(spark):
    from test_llm_small import hits_by_hand, jaccard_classes, lines_by_hand
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc", F.lit(1)).withColumn("_d", F.lit(2))
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        columns = docs.columns
        docs = materialize(stage(spark, docs, SF))
        if name == "packing":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {d for d, _ in before}
            break
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns
        if name == "language_id":
            assert len(after) >= 0.98 * len(before)
        elif name == "line_dedup":
            want = {d: t for d, n, k, t in lines_by_hand(before) if not (k and k == n)}
            assert after == want
        elif name == "near_dedup":
            classes = jaccard_classes(before)
            assert set(after) == {d for d, c, n in classes if d == c or not n}
        else:
            assert set(after) == {r[0] for r in hits_by_hand(before, bench) if not r[5]}


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0
