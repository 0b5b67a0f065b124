"""Scored tables made for lookups.

Predictions of a fitted model, joined to keys and actuals, are written in order of (region,
year) by key range: row-group statistics then bound both keys, and a Bloom filter on the
region skips the groups of other regions. The table is read with the region as text, so that
"01" stays "01". A lookup of one (region, year) pushes both comparisons to the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestlens.operators.dataset import regression_metrics
from harvestlens.operators.models import predict

REGION, YEAR = "DEPT_ID", "harvest_year"
TARGET, PREDICTION = "RENDEMENT", "yield_pred"
SCHEMA = T.StructType([T.StructField(REGION, T.StringType()), T.StructField(YEAR, T.IntegerType()),
                       T.StructField(TARGET, T.DoubleType()), T.StructField(PREDICTION, T.DoubleType()),
                       T.StructField("model_run_id", T.StringType())])


@dataclass(frozen=True)
class ScoreTable:
    spark: SparkSession
    path: str

    def write(self, scored: DataFrame, regions: int = 1000, mode: str = "overwrite") -> "ScoreTable":
        """Store predictions; ``regions``: about how many regions there are (size of the
        Bloom filter). Every row is kept, predicted or not."""
        rows = scored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
        (rows.repartitionByRange(REGION, YEAR).sortWithinPartitions(REGION, YEAR).write.mode(mode)
         .option(f"parquet.bloom.filter.enabled#{REGION}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{REGION}", str(regions))
         .parquet(self.path))
        return self

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def rows_of(self, region: str, year: int) -> DataFrame:
        """The rows of one region and year (lazy); the region is compared as text."""
        return self.read().filter((F.col(REGION) == F.lit(str(region))) & (F.col(YEAR) == F.lit(int(year))))

    def lookup(self, region: str, year: int) -> dict:
        """Prediction and actual (None where unknown) of one region and year; LookupError
        where there is no such row."""
        found = self.rows_of(region, year).limit(1).collect()
        if not found:
            raise LookupError(f"no row for {REGION}={region!r}, {YEAR}={year}")
        return {"prediction": found[0][PREDICTION], "actual": found[0][TARGET], "model_run_id": found[0]["model_run_id"]}

    def metrics(self, year: int | None = None) -> DataFrame:
        """n, MAE, MSE, RMSE, R2 over the rows whose actual and prediction are known."""
        rows = self.read() if year is None else self.read().filter(F.col(YEAR) == F.lit(int(year)))
        return regression_metrics(rows, TARGET, PREDICTION)


def score_table(model, df: DataFrame, features: list[str], path: str, run_id: str,
                year_col: str = YEAR, target: str = TARGET) -> ScoreTable:
    """Apply a fitted pipeline to every row of ``df`` and store what it says."""
    scored = predict(model, df, features, [REGION, year_col, target])
    named = scored.withColumnsRenamed({year_col: YEAR, target: TARGET}).withColumn("model_run_id", F.lit(run_id))
    return ScoreTable(df.sparkSession, path).write(named)
