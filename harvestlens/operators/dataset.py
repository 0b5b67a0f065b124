"""Splits, scaling, moments and regression metrics on DataFrames.

Everything is expressed as aggregates (fit) and projections (apply). A fit is
one distributed aggregate whose result is a single parameter row (a few values
per column, like a Spark ML model); apply adds those values as literals, so
no join and no second pass over the fitted data is needed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _with_params(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach the values of a one-row statistics frame to every row of ``df``
    as literals (the row is fetched once: it holds a few numbers per column)."""
    row = stats.first()
    return df.withColumns({c: F.lit(row[c]).cast(stats.schema[c].dataType)
                           for c in stats.columns})


# ---------------------------------------------------------------- splits

def hash_key(cols: list[str], seed: int) -> Column:
    """md5 of the key columns and the seed, as hex text (same in SQL engines)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def random_split(df: DataFrame, key_cols: list[str], test_size: float = 0.2, seed: int = 42,
                 label_col: str = "split") -> DataFrame:
    """Deterministic split: order rows by md5(key, seed); the first
    ceil(test_size * n) rows are 'test', the rest 'train'. Rows that repeat a key fall on
    one side together."""
    h = df.withColumn("__h", hash_key(key_cols, seed))
    # 16^4 buckets at most: their counts say which one holds the cut
    bucket = F.substring("__h", 1, 4)
    counts = sorted(tuple(r) for r in h.groupBy(bucket).agg(F.count(F.lit(1))).collect())
    left = math.ceil(test_size * sum(c for _, c in counts))
    cut = None
    for name, count in counts:
        if left <= count:
            cut = name
            break
        left -= count
    if cut is None or left == 0:
        test = F.lit(False) if cut is not None else F.lit(True)
        return h.withColumn(label_col, F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("__h")
    # inside it, the hash of the last test row; all other rows need no ordering
    last = (h.filter(bucket == cut).select("__h").orderBy("__h").limit(left)
            .agg(F.max("__h").alias("m")).first()["m"])
    return (h.withColumn(label_col, F.when(F.col("__h") <= last, F.lit("test")).otherwise(F.lit("train")))
            .drop("__h"))


@dataclass(frozen=True)
class TemporalSplit:
    """Years <= train_max_year train; years >= test_min_year test."""
    train_max_year: int
    test_min_year: int

    def __post_init__(self):
        if self.test_min_year <= self.train_max_year:
            raise ValueError(
                f"test_min_year ({self.test_min_year}) must be greater than "
                f"train_max_year ({self.train_max_year})")

    def label(self, year_col: str = "ANNEE") -> Column:
        y = F.col(year_col)
        return (F.when(y <= F.lit(self.train_max_year), F.lit("train"))
                .when(y >= F.lit(self.test_min_year), F.lit("test")))

    def split(self, df: DataFrame, year_col: str = "ANNEE") -> tuple[DataFrame, DataFrame]:
        return (df.filter(F.col(year_col) <= F.lit(self.train_max_year)),
                df.filter(F.col(year_col) >= F.lit(self.test_min_year)))


def temporal_labels(year_col: str = "harvest_year", train_max: int = 2020,
                    val_years: tuple[int, ...] = (2021, 2022), test_min: int = 2023) -> Column:
    """Train / val / test label of the sequence path."""
    y = F.col(year_col)
    return (F.when(y <= F.lit(train_max), F.lit("train"))
            .when(y.isin(*val_years), F.lit("val"))
            .when(y >= F.lit(test_min), F.lit("test")))


# ---------------------------------------------------------------- scaling

def fit_minmax(train: DataFrame, cols: list[str]) -> DataFrame:
    return train.agg(*[F.min(c).alias(f"__min_{c}") for c in cols],
                     *[F.max(c).alias(f"__max_{c}") for c in cols])


def apply_minmax(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column scales to 0 (sklearn)."""
    out = _with_params(df, stats)
    exprs = {}
    for c in cols:
        rng = F.col(f"__max_{c}") - F.col(f"__min_{c}")
        exprs[c] = (F.col(c) - F.col(f"__min_{c}")) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
    return out.withColumns(exprs).drop(*[f"__min_{c}" for c in cols],
                                       *[f"__max_{c}" for c in cols])


def fit_robust(train: DataFrame, cols: list[str]) -> DataFrame:
    """Exact median and quartiles per column (linear interpolation), as a
    one-row parameter frame (``global_quantiles``: no unbounded merge)."""
    from pyspark.sql import types as T

    from harvestlens.operators.quantile import global_quantiles
    qv = global_quantiles(train, cols, [0.5, 0.25, 0.75])
    names, values = [], []
    for c in cols:
        for tag, q in (("med", 0.5), ("q1", 0.25), ("q3", 0.75)):
            names.append(f"__{tag}_{c}")
            values.append(None if qv[(c, q)] is None else float(qv[(c, q)]))
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return train.sparkSession.createDataFrame([tuple(values)], schema)


def apply_robust(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    """(x - median) / IQR; an IQR of 0 divides by 1 (sklearn)."""
    out = _with_params(df, stats)
    exprs = {}
    for c in cols:
        iqr = F.col(f"__q3_{c}") - F.col(f"__q1_{c}")
        exprs[c] = (F.col(c) - F.col(f"__med_{c}")) / F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)
    tmp = [f"__{p}_{c}" for c in cols for p in ("med", "q1", "q3")]
    return out.withColumns(exprs).drop(*tmp)


def fit_zscore(train: DataFrame, cols: list[str], nan_propagates: bool = True) -> DataFrame:
    """Mean and population std per column; std 0 -> 1. With
    ``nan_propagates`` one missing value makes the column's moments NULL
    (NumPy semantics)."""
    aggs = []
    for c in cols:
        mean, std = F.avg(c), F.stddev_pop(c)
        std = F.when(std == 0, F.lit(1.0)).otherwise(std)
        if nan_propagates:
            has_null = F.count_if(F.col(c).isNull()) > 0
            mean = F.when(~has_null, mean)
            std = F.when(~has_null, std)
        aggs += [mean.alias(f"__mu_{c}"), std.alias(f"__sd_{c}")]
    return train.agg(*aggs)


def apply_zscore(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    out = _with_params(df, stats)
    return out.withColumns({c: (F.col(c) - F.col(f"__mu_{c}")) / F.col(f"__sd_{c}")
                            for c in cols}).drop(*[f"__mu_{c}" for c in cols],
                                                 *[f"__sd_{c}" for c in cols])


def padded_moments(rows: DataFrame, cols: list[str], n_pairs: DataFrame | int,
                   length: int) -> DataFrame:
    """Mean / population std of sequence features over pairs x ``length``
    steps where missing steps are zero padding: sums over the real rows,
    divided by the fixed count n_pairs * length. std 0 -> 1."""
    sums = rows.agg(*[x for c in cols for x in (
        F.count(c).alias(f"__n_{c}"), F.avg(c).alias(f"__m_{c}"), F.var_pop(c).alias(f"__v_{c}"))])
    if not isinstance(n_pairs, int):
        n_pairs = n_pairs.count()
    total = F.lit(float(n_pairs) * float(length))
    exprs = []
    for c in cols:
        # the real rows' moments joined with those of the zeros (no difference of squares)
        n, m, v = F.col(f"__n_{c}"), F.coalesce(f"__m_{c}", F.lit(0.0)), F.coalesce(f"__v_{c}", F.lit(0.0))
        var = (n * v + m * m * n * (total - n) / total) / total
        sd = F.sqrt(F.greatest(var, F.lit(0.0)))
        exprs += [(n * m / total).alias(f"{c}_mean"),
                  F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"{c}_std")]
    return sums.select(*exprs)


# ---------------------------------------------------------------- metrics

def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """n, MAE, MSE, RMSE, R2 over rows where both values are known (one aggregate)."""
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    known = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    sums = known.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                     F.var_pop(y).alias("__var"))
    return sums.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"),
                       F.when(F.col("__var") > 0, 1.0 - F.col("mse") / F.col("__var")).alias("r2"))


def lag_baseline(df: DataFrame, region: str = "DEPT_ID", year: str = "ANNEE",
                 target: str = "RENDEMENT", out_col: str = "yield_pred") -> DataFrame:
    """Rule model: the value of the same region one year before; null where that year is
    absent (a window per region, bounded by the number of years)."""
    w = Window.partitionBy(region).orderBy(year)
    consecutive = F.col(year) - F.lag(year).over(w) == 1
    return df.withColumn(out_col, F.when(consecutive, F.lag(F.col(target)).over(w)))


def score_lookup(scored: DataFrame, region: str, year: int, region_col: str = "DEPT_ID",
                 year_col: str = "ANNEE") -> DataFrame:
    """Point lookup of one (region, year) in a scored frame; the region is
    compared as text. Raises LookupError when no row matches."""
    hit = scored.filter((F.col(region_col).cast("string") == F.lit(str(region)))
                        & (F.col(year_col) == F.lit(year))).orderBy(region_col, year_col).limit(1)
    if hit.isEmpty():
        raise LookupError(f"no row for {region_col}={region!r}, {year_col}={year}")
    return hit
