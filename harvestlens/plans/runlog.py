"""Model run log: parameters, metrics and production pointers.

A run is one Parquet row (run id, model id, time, parameters and metrics as maps, feature
list, model path). What is newest and what is in production is said by a versioned manifest
(``sources.versions``): each recorded run and each promotion commits the next version, so
their order is that of the versions, never of clocks, and of two writers at once both are
kept, the later version winning. Fitted pipelines are saved with ``PipelineModel.save`` next
to the log. The root is a shared folder (by default below ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestlens.operators.dataset import TemporalSplit, lag_baseline, regression_metrics
from harvestlens.operators.models import fit, predict, ridge_pipeline
from harvestlens.sources.versions import Manifest

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("model_id", T.StringType()),
    T.StructField("created", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("model_path", T.StringType()),
])
# Models that are rules, not fitted pipelines.
RULE_MODELS = {"lag1"}


def default_root(spark: SparkSession) -> str:
    return spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/runlog"


@dataclass
class RunLog:
    spark: SparkSession
    root: str

    @property
    def runs_path(self) -> str:
        return f"{self.root}/runs"

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self.root}/manifest")

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # nothing recorded yet

    def runs(self, model_id: str | None = None) -> DataFrame:
        df = self._read(self.runs_path, RUN_SCHEMA)
        return df.filter(F.col("model_id") == model_id) if model_id else df

    def record(self, model_id: str, params: dict, metrics: dict, features: list[str],
               model_path: str | None, run_id: str | None = None) -> str:
        run_id = run_id or f"{model_id}-{_dt.datetime.now(_dt.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
        row = (run_id, model_id, _dt.datetime.now(_dt.UTC).replace(tzinfo=None),
               {k: str(v) for k, v in params.items()},
               {k: float(v) for k, v in metrics.items()}, list(features), model_path)
        self.spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(self.runs_path)
        self._commit("latest", model_id, run_id)
        return run_id

    def _commit(self, pointer: str, model_id: str, run_id: str) -> None:
        """Set a pointer in the next version; the version itself records what it did."""
        self.manifest.update(lambda old: {
            **old, pointer: {**old.get(pointer, {}), model_id: run_id},
            "event": {"pointer": pointer, "model_id": model_id, "run_id": run_id}})

    def history(self) -> list[dict]:
        """Every recorded run and promotion in the order of the versions."""
        found = ((v, self.manifest.read(v)) for v in self.manifest.versions())
        return [{"version": v, **content["event"]} for v, content in found if content]

    def _pointers(self, pointer: str) -> DataFrame:
        rows = sorted(self.manifest.current()[1].get(pointer, {}).items())
        return self.spark.createDataFrame(rows, "model_id string, run_id string")

    def latest(self, model_id: str | None = None) -> DataFrame:
        """Newest run (per model), the last to be recorded, with its creation time."""
        newest = self._pointers("latest")
        if model_id:
            newest = newest.filter(F.col("model_id") == model_id)
        return newest.join(self.runs().select("run_id", "created"), "run_id").select("model_id", "run_id", "created")

    def promote(self, model_id: str, run_id: str) -> None:
        self._commit("production", model_id, run_id)

    def production(self) -> DataFrame:
        return self._pointers("production")

    def production_run(self, model_id: str) -> str:
        rows = self.production().filter(F.col("model_id") == model_id).collect()
        if not rows:
            raise LookupError(f"no production run for {model_id!r}")
        return rows[0]["run_id"]

    def run_info(self, run_id: str):
        rows = self.runs().filter(F.col("run_id") == run_id).collect()
        if not rows:
            raise LookupError(f"unknown run {run_id!r}")
        return rows[0]

    # ---------------------------------------------------------- train / score

    def train_and_register(self, mart: DataFrame, model_id: str, feature_cols: list[str],
                           split: TemporalSplit, target: str = "RENDEMENT",
                           year_col: str = "ANNEE", region: str = "DEPT_ID",
                           extra_params: dict | None = None, run_id: str | None = None) -> str:
        params = {"train_max_year": split.train_max_year, "test_min_year": split.test_min_year,
                  **(extra_params or {})}
        run_id = run_id or f"{model_id}-{uuid.uuid4().hex[:12]}"
        if model_id in RULE_MODELS:
            scored = lag_baseline(mart, region, year_col, target)
            model_path = None
        else:
            train, _ = split.split(mart, year_col)
            model = fit(ridge_pipeline(feature_cols, target), train, feature_cols, target)
            model_path = f"{self.root}/models/{run_id}"
            model.write().overwrite().save(model_path)
            scored = predict(model, mart, feature_cols, [region, year_col, target])
        test = scored.filter(F.col(year_col) >= F.lit(split.test_min_year))
        m = regression_metrics(test, target, "yield_pred").first()
        metrics = {"n_test": m["n"], "mae": m["mae"] if m["mae"] is not None else float("nan"),
                   "rmse": m["rmse"] if m["rmse"] is not None else float("nan")}
        return self.record(model_id, params, metrics, feature_cols, model_path, run_id)

    def predict_run(self, df: DataFrame, run_id: str, target: str = "RENDEMENT",
                    year_col: str = "ANNEE", region: str = "DEPT_ID") -> DataFrame:
        info = self.run_info(run_id)
        keep = [c for c in df.columns]
        if info["model_path"] is None:
            scored = lag_baseline(df, region, year_col, target)
        else:
            model = PipelineModel.load(info["model_path"])
            scored = predict(model, df, list(info["features"]), keep)
        return scored.withColumn("model_run_id", F.lit(run_id))

    def predict_production(self, df: DataFrame, model_id: str, **kw) -> DataFrame:
        return self.predict_run(df, self.production_run(model_id), **kw)
