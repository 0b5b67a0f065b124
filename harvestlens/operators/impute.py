"""Sequential median imputation and null profiles.

Each level fills the nulls left by the previous one with the median of the
*already partly filled* column over the level's keys (the order matters:
the second median is taken after the first fill).

All levels work on one table of value counts (keys, column, value, count), taken from the
input in one pass. A level's medians come from it by rank; what the level fills then goes
back into the counts as so many more occurrences of the median, so that the next level sees
the filled column without the input being read again. The input is read once to count and
once to fill, at any number of levels. NaN counts as missing everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.functions.nulls import nan_to_null
from harvestlens.operators.quantile import keyed_quantiles, value_counts, value_ranges
from harvestlens.session import stored


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: number of missing values (NULL or NaN) per column (``<col>`` -> count)."""
    df = nan_to_null(df)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols or df.columns])


def columns_with_nulls(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns that hold at least one null (one aggregate job)."""
    prof = null_profile(df, cols).first()
    return [c for c in cols if prof[c] > 0]


def _filled_counts(counts: DataFrame, medians: DataFrame, keys: list[str]) -> DataFrame:
    """Counts after a level: its missing values become the key's median, where it has one."""
    known = counts.filter("v is not null")
    # one row per key and column
    missing = counts.filter("v is null").drop("v").join(medians, [*keys, "k"], "left").withColumnRenamed("q0", "v")
    return known.unionByName(missing)


def impute_levels(df: DataFrame, cols: list[str], levels: list[list[str]]) -> DataFrame:
    """Fill ``cols`` level by level; ``levels`` like
    ``[["DEPT_ID", "harvest_year"], ["DEPT_ID"]]`` or with a final ``[]``
    for the global median. Rows with a null key stay unfilled (pandas).

    Counts and all but the last level's medians are tables in the shared folder."""
    if not cols or not levels:
        return df
    finest = list(dict.fromkeys(c for lv in levels for c in lv))
    out = nan_to_null(df, cols)
    counts = stored(value_counts(df, finest, cols), "counts")
    bounds, missing = value_ranges(counts)
    todo = [i for i in range(len(cols)) if missing.get(i)]
    if not todo:
        return out
    counts = counts.filter(F.col("k").isin(todo))
    fills: dict[int, list] = {i: [F.col(cols[i])] for i in todo}
    for n, lv in enumerate(levels):
        medians = keyed_quantiles(counts, lv, [0.5], bounds)
        if n + 1 < len(levels):
            medians = stored(medians, "medians")
            counts = _filled_counts(counts, medians, lv)
        if lv:
            names = {i: f"__med_{n}_{i}" for i in todo}
            wide = medians.groupBy(*lv).agg(*[F.max(F.when(F.col("k") == i, F.col("q0"))).alias(m) for i, m in names.items()])
            out = out.join(wide, lv, "left")
            for i, m in names.items():
                fills[i].append(F.col(m))
        else:
            for r in medians.collect():  # one row per column
                fills[r["k"]].append(F.lit(r["q0"]))
    filled = {cols[i]: F.coalesce(*f).alias(cols[i]) for i, f in fills.items()}
    return out.select(*[filled.get(c, F.col(c)) for c in df.columns])


def impute_two_level(df: DataFrame, cols: list[str], region: str = "DEPT_ID",
                     year: str = "harvest_year") -> DataFrame:
    """Daily path: median per (region, harvest year), then per region."""
    return impute_levels(df, cols, [[region, year], [region]])


def impute_three_level(df: DataFrame, cols: list[str] | None, region: str = "DEPT_ID",
                       hour: str = "heure", exclude: tuple[str, ...] = ()) -> DataFrame:
    """Hourly path: median per (region, hour), per region, then global;
    only columns that hold nulls are imputed (``cols=None``: every numeric
    column not in ``exclude``)."""
    if cols is None:
        from harvestlens.functions.columns import numeric_columns
        cols = numeric_columns(df, exclude=tuple(exclude) + (region, hour))
    return impute_levels(df, cols, [[region, hour], [region], []])
