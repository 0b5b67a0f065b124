"""Row filters and table cleaning steps (targets, exclusions, labels)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlens.functions.calendar import crop_stage, date_parts, harvest_year, pad_code
from harvestlens.functions.columns import drop_columns, rename_columns

# Overseas / Corsica codes removed from the yield target.
EXCLUDED_TARGET_CODES = ["2A", "2B"]
# Urban départements without field crops (hourly path).
URBAN_CODES = ["75", "92", "93", "94"]


def not_in(col: str | Column, values: list) -> Column:
    """pandas ``~isin``: a NULL value is kept (it is not in the list)."""
    c = F.col(col) if isinstance(col, str) else col
    return ~F.coalesce(c.isin(*values), F.lit(False))


def drop_null_target(df: DataFrame, target: str = "RENDEMENT") -> DataFrame:
    return df.dropna(subset=[target])


def clean_target(df: DataFrame, target: str = "RENDEMENT",
                 drop: tuple[str, ...] = ("TYPE BLE", "SURFACE", "PRODUCTION"),
                 excluded: list[str] = EXCLUDED_TARGET_CODES) -> DataFrame:
    """Yield target: drop rows without target, drop measure columns (strict),
    rename REGION -> DEPT when present, remove the excluded codes."""
    out = drop_columns(drop_null_target(df, target), list(drop), strict=True)
    out = rename_columns(out, {"REGION": "DEPT"})
    return out.filter(not_in("DEPT_ID", excluded))


def exclude_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Remove rows whose ``col`` is in ``values``. Values are compared with
    the column's own type: the daily weather path of the reference compares
    string codes with integers and so removes nothing; pass ``[]`` (the
    default of ``weather_daily_clean``) to reproduce it."""
    if not values:
        return df
    return df.filter(not_in(col, values))


def exclude_pairs(df: DataFrame, region: str = "DEPT_ID", year: str = "harvest_year",
                  min_year_exclusive: int | None = None, max_year: int | None = None,
                  pairs: list[tuple[str, int]] = ()) -> DataFrame:
    """Keep min_year < year <= max_year and drop single (region, year) pairs."""
    conds: list[Column] = []
    if min_year_exclusive is not None:
        conds.append(F.col(year) > F.lit(min_year_exclusive))
    if max_year is not None:
        conds.append(F.col(year) <= F.lit(max_year))
    for r, y in pairs:
        conds.append(~F.coalesce((F.col(region) == F.lit(r)) & (F.col(year) == F.lit(y)),
                                 F.lit(False)))
    if not conds:
        return df
    return df.filter(reduce(lambda a, b: a & b, conds))


def holdout_split(df: DataFrame, year_col: str = "harvest_year",
                  holdout_year: int = 2025) -> tuple[DataFrame, DataFrame]:
    """(rows of other years, rows of the holdout year)."""
    is_holdout = F.coalesce(F.col(year_col) == F.lit(holdout_year), F.lit(False))
    return df.filter(~is_holdout), df.filter(is_holdout)


def label_weather(df: DataFrame, time_col: str, region_col: str = "dept_id",
                  with_hour: bool = True) -> DataFrame:
    """Harvest year, date parts, crop stage and 2-digit DEPT_ID (drops the
    raw region column)."""
    parts = date_parts(time_col)
    if not with_hour:
        parts.pop("heure")
    cols = {"harvest_year": harvest_year(time_col), **parts,
            "saison": crop_stage(time_col), "__dept": pad_code(region_col)}
    # drop first: column names are case-insensitive, dept_id == DEPT_ID
    return df.withColumns(cols).drop(region_col).withColumnRenamed("__dept", "DEPT_ID")


def filter_label_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    """Lower-case the label column and keep rows that contain ``needle``."""
    out = df.withColumn(col, F.lower(F.col(col)))
    return out.filter(F.col(col).contains(needle.lower()))


def region_codes_from_label(df: DataFrame, label: str = "LIB_DEP", keep_prefix: str = "0",
                            code_col: str = "DEPT_ID", name_col: str = "DEPT") -> DataFrame:
    """Labels like "0NN - name": keep those starting with ``keep_prefix``,
    strip one leading "0", code = first two characters, name = text from
    the fifth character on."""
    out = df.filter(F.col(label).startswith(keep_prefix))
    stripped = F.regexp_replace(F.col(label), "^0", "")
    out = out.withColumn(label, stripped)
    return (out.withColumn(code_col, F.substring(F.col(label), 1, 2))
            .withColumn(label, F.expr(f"substr(`{label}`, 5)"))
            .withColumnRenamed(label, name_col))
