"""Sequence dataset with indicators: one row per (region, harvest year, step).

The agro variant of the hourly path: yield, soil, vegetation index and hourly indicators per
pair (an inner join, so pairs without weather go), and the pair's first ``length`` hours. The
hours are a table of steps instead of an array per pair: padding rows and z-scores are put in
as it is written, key ranges by file and time order within, so that a reader gets the pairs
of a range whole and in order and no row ever holds a year.

Positions come from blocks of time (``operators.blocks``), so no window holds a pair either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.operators.blocks import positions
from harvestlens.operators.dataset import apply_zscore, fit_zscore, padded_moments, temporal_labels
from harvestlens.plans.sequences import KEYS, NOT_FEATURES, hourly_features
from harvestlens.session import stored


@dataclass(frozen=True)
class StepDataset:
    """Two Parquet tables: ``steps`` (DEPT_ID, harvest_year, split, step from 1, observed, one
    column per weather feature) and ``statics`` (DEPT_ID, harvest_year, split, target and the
    static features, n_steps)."""
    spark: SparkSession
    path: str
    features: tuple[str, ...]
    static_features: tuple[str, ...]

    def steps(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/steps")

    def statics(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/statics")


def write_step_dataset(panel: DataFrame, mart: DataFrame, static_features: list[str], path: str,
                       target: str = "RENDEMENT", length: int = 8760, excluded: list[str] = (),
                       min_year_exclusive: int = 2010, max_year: int = 2024,
                       pairs_dropped: list[tuple[str, int]] = (), train_max: int = 2020,
                       val_years: tuple[int, ...] = (2021, 2022), test_min: int = 2023,
                       time_col: str = "datetime") -> StepDataset:
    """Write the dataset below ``path``. ``mart``: the static and agro features per (DEPT_ID,
    harvest_year), as of ``training.training_static_hourly``; ``panel``: DEPT_ID, ``time_col``,
    harvest_year, saison and numeric measures.

    Features are scaled with the train pairs' moments: those of the weather count the padding
    zeros, those of the statics are null for a column with a missing value (as in
    ``sequences.sequence_dataset``)."""
    spark = panel.sparkSession
    hours = stored(hourly_features(panel, excluded, min_year_exclusive, max_year, pairs_dropped, time_col), "hours")
    feats = [c for c in hours.columns if c not in NOT_FEATURES]
    placed = positions(hours, KEYS, time_col, out_col="step").filter(F.col("step") <= length)

    pairs = mart.select(*KEYS, F.col(target), *[F.col(f"`{c}`") for c in static_features]).withColumn(
        "split", temporal_labels("harvest_year", train_max, val_years, test_min))
    seen = hours.groupBy(*KEYS).agg(F.least(F.count(F.lit(1)), F.lit(length)).cast("int").alias("n_steps"))
    pairs = stored(pairs.join(seen, KEYS), "pairs")  # a pair has weather
    rows = stored(placed.select(*KEYS, "step", *feats).join(pairs.select(*KEYS, "split"), KEYS), "steps")

    train = rows.filter(F.col("split") == "train")
    moments = padded_moments(train, feats, pairs.filter(F.col("split") == "train").count(), length).first()
    padding = (pairs.filter(F.col("n_steps") < length)
               .select(*KEYS, "split", F.explode(F.sequence(F.col("n_steps").cast("long") + 1, F.lit(length).cast("long"))).alias("step"),
                       *[F.lit(0.0).alias(c) for c in feats], F.lit(False).alias("observed")))
    whole = rows.withColumn("observed", F.lit(True)).withColumn("step", F.col("step").cast("long")).unionByName(padding)
    scaled = whole.select(*KEYS, "split", "step", "observed", *[
        ((F.col(c) - F.lit(float(moments[f"{c}_mean"]))) / F.lit(float(moments[f"{c}_std"]))).alias(c) for c in feats])
    # a pair's steps lie in one file, in order: rows of a range of keys, sorted
    (scaled.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS, "step")
     .write.mode("overwrite").parquet(f"{path}/steps"))

    stats = fit_zscore(pairs.filter(F.col("split") == "train"), static_features)
    statics = apply_zscore(pairs, stats, static_features)
    statics.select(*KEYS, "split", target, *static_features, "n_steps").orderBy(*KEYS).write.mode("overwrite").parquet(f"{path}/statics")
    return StepDataset(spark, path, tuple(feats), tuple(static_features))
