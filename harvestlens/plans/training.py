"""Training marts: yield target x soil x vegetation index x weather features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.functions.calendar import pad_code
from harvestlens.functions.columns import rename_columns
from harvestlens.functions.nulls import nan_to_null
from harvestlens.operators.cleaning import clean_target, exclude_pairs, exclude_values, label_weather
from harvestlens.operators.impute import impute_two_level
from harvestlens.sources.stations import DAILY_MEAN_COLS, DAILY_SUM_COLS

KEYS_YEAR = ["DEPT_ID", "ANNEE"]
KEYS_HARVEST = ["DEPT_ID", "harvest_year"]

# Fixed values (reference): daily weather columns dropped before imputation
# and the columns imputed on the daily path.
DAILY_DROP = ["duree_humectation_foliaire_min", "temp_sol_100cm_c", "temp_sol_50cm_c",
              "temp_sol_20cm_c", "etat_sol", "pression_mer_hpa", "temp_surface_sol_c"]
DAILY_IMPUTE = ["temp_air_c", "temp_min_c", "temp_max_c", "temp_rosee_c",
                "humidite_relative_pct", "humidite_min_pct", "humidite_max_pct",
                "vent_moyen_10m_ms", "rafale_max_ms", "tension_vapeur_hpa",
                "temp_sol_10cm_c", "temp_min_sol_10cm_c", "heure_humidite_min",
                "heure_humidite_max", "direction_vent_deg", "hauteur_neige_sol_cm",
                "precipitations_1h_mm", "duree_precipitations_min", "duree_gel_min",
                "insolation_min", "rayonnement_global_jcm2", "duree_humidite_inf40_min",
                "duree_humidite_sup80_min"]


def join_static(target: DataFrame, soil: DataFrame, drop: str = "dept_nom") -> DataFrame:
    """Inner join on the region; the soil name column is dropped (strict)."""
    if drop not in soil.columns:
        raise KeyError(f"column {drop!r} not found")
    return target.join(soil, "DEPT_ID", "inner").drop(drop)


def join_suffixed(left: DataFrame, right: DataFrame, keys: list[str],
                  suffixes: tuple[str, str] = ("_x", "_y"), how: str = "inner") -> DataFrame:
    """Join on ``keys``; non-key columns present on both sides get suffixes
    (pandas ``merge``)."""
    dup = [c for c in left.columns if c in right.columns and c not in keys]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in dup})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in dup})
    return left.join(right, keys, how)


def join_renamed_key(left: DataFrame, right: DataFrame, left_keys: list[str],
                     right_keys: list[str], how: str = "inner") -> DataFrame:
    """Join where the right side names its keys differently; the right keys
    are dropped after the join."""
    r = right.withColumnsRenamed(dict(zip(right_keys, left_keys)))
    return left.join(r, left_keys, how)


def ndvi_annual(monthly: DataFrame) -> DataFrame:
    """Mean of the monthly index per (DEPT_ID, DEPT, ANNEE)."""
    df = rename_columns(monthly, {"department_name": "DEPT", "year": "ANNEE"})
    return (df.filter(F.col("DEPT_ID").isNotNull() & F.col("DEPT").isNotNull()
                      & F.col("ANNEE").isNotNull())
            .groupBy("DEPT_ID", "DEPT", "ANNEE").agg(F.avg("ndvi_poly_mean").alias("ndvi_poly_mean")))


def annual_weather(daily: DataFrame, mean_cols: list[str] = DAILY_MEAN_COLS,
                   sum_cols: list[str] = DAILY_SUM_COLS, region: str = "dept_id",
                   day: str = "day") -> DataFrame:
    """Calendar-year weather per region: means and sums by rule; every rule
    column must exist (KeyError otherwise). All-missing sums are 0."""
    missing = [c for c in list(mean_cols) + list(sum_cols) if c not in daily.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    df = nan_to_null(daily).filter(F.col(region).isNotNull() & F.col(day).isNotNull())
    df = df.withColumns({"DEPT_ID": pad_code(region), "ANNEE": F.year(day)})
    aggs = [F.avg(c).alias(c) for c in mean_cols]
    aggs += [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sum_cols]
    return df.groupBy("DEPT_ID", "ANNEE").agg(*aggs)


def weather_daily_clean(daily: DataFrame, region: str = "dept_id", day: str = "day",
                        excluded: list = (), drop: list[str] = DAILY_DROP,
                        impute: list[str] = DAILY_IMPUTE) -> DataFrame:
    """Harvest year, date parts, stage, 2-digit code, exclusion (none by
    default, as in the reference's daily path), strict drop, two-level
    median imputation of the listed columns that exist."""
    df = label_weather(daily, day, region, with_hour=True)
    df = exclude_values(df, "DEPT_ID", list(excluded))
    missing = [c for c in drop if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    df = df.drop(*drop)
    return impute_two_level(df, [c for c in impute if c in df.columns])


def _materialize(df: DataFrame, materialize: bool) -> DataFrame:
    """Lazy by default, so that callers' filters and column lists reach the scans. On
    request (iterative fits) the table is written once to the shared checkpoint folder,
    which also cuts the lineage."""
    return df.checkpoint(eager=True) if materialize else df


def training_mart(target_long: DataFrame, soil: DataFrame, ndvi_monthly: DataFrame,
                  weather_mart: DataFrame, materialize: bool = False) -> DataFrame:
    """target (cleaned) x soil x yearly NDVI x weather features."""
    target = clean_target(target_long)
    m = join_static(target, soil)
    m = join_suffixed(m, ndvi_annual(ndvi_monthly), KEYS_YEAR)
    m = m.withColumnRenamed("ANNEE", "harvest_year")
    return _materialize(m.join(weather_mart, KEYS_HARVEST, "inner"), materialize)


def training_mart_annual(target_long: DataFrame, soil: DataFrame, ndvi_monthly: DataFrame,
                         weather_annual: DataFrame, materialize: bool = False) -> DataFrame:
    """Calendar-year variant: weather aggregated per (DEPT_ID, ANNEE)."""
    target = clean_target(target_long)
    m = join_static(target, soil)
    m = join_suffixed(m, ndvi_annual(ndvi_monthly), KEYS_YEAR)
    return _materialize(m.join(weather_annual, KEYS_YEAR, "inner"), materialize)


def agro_mart_hourly(panel: DataFrame, features, excluded: list[str], min_year_exclusive: int,
                     max_year: int, time_col: str = "datetime", roles: dict | None = None
                     ) -> DataFrame:
    """Hourly indicator mart on the panel filtered to the kept regions and
    years (the single excluded pair is *not* removed here: the reference
    computes its thresholds with that pair still present)."""
    from harvestlens.operators.mart import build_mart
    kept = exclude_values(panel, "DEPT_ID", excluded)
    kept = exclude_pairs(kept, min_year_exclusive=min_year_exclusive, max_year=max_year)
    return build_mart(kept, features, time_col=time_col, roles=roles)


def training_static_hourly(target_long: DataFrame, soil: DataFrame, ndvi_monthly: DataFrame,
                           agro_mart: DataFrame, excluded: list[str], min_year_exclusive: int,
                           max_year: int, pairs: list[tuple[str, int]],
                           materialize: bool = False) -> DataFrame:
    """Hourly path: static sources x hourly-feature mart with the year range,
    exclusions and the single dropped pair, joined on (DEPT_ID, ANNEE) =
    (DEPT_ID, harvest_year). The mart is computed *before* the pair is
    dropped (its quantiles include that pair)."""
    target = clean_target(target_long)
    m = join_static(target, soil)
    m = join_suffixed(m, ndvi_annual(ndvi_monthly), KEYS_YEAR)
    m = exclude_values(m, "DEPT_ID", excluded).filter(F.col("ANNEE") > F.lit(min_year_exclusive))
    agro = exclude_values(agro_mart, "DEPT_ID", excluded)
    agro = exclude_pairs(agro, min_year_exclusive=min_year_exclusive, max_year=max_year,
                         pairs=pairs)
    return _materialize(join_renamed_key(m, agro, KEYS_YEAR, KEYS_HARVEST), materialize)
