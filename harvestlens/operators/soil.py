"""Soil-layer and soil x weather features (row-wise, one ``select``).

All features are column expressions over one row, so the whole chain is a
projection fused into the surrounding stage (no shuffle). Columns that are
absent are skipped, as in the reference; divisions carry a small epsilon and
use ``try_divide`` so an exact zero denominator gives NULL instead of an
ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlens.functions.columns import columns_with_suffix
from harvestlens.functions.nulls import rowwise_mean

# Fixed values (reference): soil variables, depth layers and their zones.
SOIL_VARS = ["silt", "sand", "clay", "wv0033", "wv0010", "wv1500",
             "cfvo", "ocd", "soc", "nitrogen", "cec", "phh2o", "bdod"]
DEPTHS = ["0-5cm", "5-15cm", "15-30cm", "30-60cm", "60-100cm", "100-200cm"]
ZONES = {"surface": ["0-5cm", "5-15cm"], "medium": ["15-30cm", "30-60cm"],
         "deep": ["60-100cm", "100-200cm"]}
DEPTH_SUFFIXES = [f"{d}_mean" for d in DEPTHS]
EPS = 1e-6

# Fixed values (reference): columns dropped before feature engineering.
LOW_IMPORTANCE_FEATURES = [
    "STATUT_QUALITE", "phh2o_100-200cm_mean", "vernalisation_nb_jours_0_10C",
    "nb_risques_rayonnement_faible", "floraison_nb_jours_tx_gt_25",
    "floraison_nb_jours_tx_gt_30", "floraison_max_consecutive_tx_gt_25",
    "floraison_max_consecutive_tx_gt_30", "floraison_heat_degree_days_25",
    "floraison_heat_degree_days_30", "floraison_episodes_tx_gt_30_ge3",
    "floraison_days_heat_drought", "remplissage_storm_event_count",
]

# Fixed values (reference): soil x weather products (name, soil column, feature).
INTERACTIONS = [
    ("wv0033_deep_x_heat_filling", "wv0033_100-200cm_mean", "remplissage_nb_jours_tx_gt_25"),
    ("wv0033_mid_x_dry_filling", "wv0033_30-60cm_mean", "remplissage_max_consecutive_dry_days"),
    ("silt_deep_x_rain_flowering", "silt_100-200cm_mean", "floraison_cumul_pluie_10j_max"),
    ("wv0033_deep_x_warm_winter", "wv0033_100-200cm_mean", "hiver_anormalement_chaud"),
]


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den + F.lit(EPS))


def drop_listed(df: DataFrame, cols: list[str] = LOW_IMPORTANCE_FEATURES) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def soil_weather_products(df: DataFrame) -> DataFrame:
    """Four soil x weather products; all inputs must exist."""
    missing = [c for _, a, b in INTERACTIONS for c in (a, b) if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {sorted(set(missing))}")
    return df.withColumns({n: F.col(f"`{a}`") * F.col(f"`{b}`") for n, a, b in INTERACTIONS})


def _zone_cols(df: DataFrame, var: str, zone: str) -> list[str]:
    return [f"{var}_{d}_mean" for d in ZONES[zone] if f"{var}_{d}_mean" in df.columns]


def _zmean(df: DataFrame, var: str, zone: str) -> Column:
    return rowwise_mean([F.col(f"`{c}`") for c in _zone_cols(df, var, zone)])


def soil_layer_means(df: DataFrame) -> DataFrame:
    """Per variable: surface / medium / deep means and surface - deep gradient
    (only from the layers present)."""
    new: dict[str, Column] = {}
    for var in SOIL_VARS:
        has = {z: bool(_zone_cols(df, var, z)) for z in ZONES}
        for z in ZONES:
            if has[z]:
                new[f"{var}_{z}_mean"] = _zmean(df, var, z)
        if has["surface"] and has["deep"]:
            new[f"{var}_gradient"] = _zmean(df, var, "surface") - _zmean(df, var, "deep")
    return df.withColumns(new) if new else df


def soil_ratios(df: DataFrame) -> DataFrame:
    """Silt / sand texture ratio at the surface and in depth."""
    if "silt_surface_mean" in df.columns and "sand_surface_mean" in df.columns:
        return df.withColumns({
            "ratio_silt_sand_surface": _ratio(F.col("silt_surface_mean"), F.col("sand_surface_mean")),
            "ratio_silt_sand_deep": _ratio(F.col("silt_deep_mean"), F.col("sand_deep_mean")),
        })
    return df


def soil_water(df: DataFrame) -> DataFrame:
    """Available water capacity and retention ratio per zone."""
    new: dict[str, Column] = {}
    cols = set(df.columns)
    for z in ZONES:
        a, b, c = f"wv0033_{z}_mean", f"wv1500_{z}_mean", f"wv0010_{z}_mean"
        if a in cols and b in cols:
            new[f"AWC_{z}"] = F.col(a) - F.col(b)
        if a in cols and c in cols:
            new[f"retention_ratio_{z}"] = _ratio(F.col(a), F.col(c))
    return df.withColumns(new) if new else df


def stress_indices(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    new: dict[str, Column] = {}
    if {"floraison_cumul_pluie_10j_max", "remplissage_nb_jours_tx_gt_25"} <= cols:
        new["stress_floraison_chaleur_secheresse"] = (
            F.col("remplissage_nb_jours_tx_gt_25")
            * F.try_divide(F.lit(1.0), F.col("floraison_cumul_pluie_10j_max") + F.lit(EPS)))
    if {"remplissage_heatwave_length_max", "remplissage_max_consecutive_dry_days"} <= cols:
        new["stress_remplissage_combine"] = (F.col("remplissage_heatwave_length_max")
                                             * F.col("remplissage_max_consecutive_dry_days"))
    df = df.withColumns(new) if new else df
    if "hiver_anormalement_chaud" in df.columns and "AWC_deep" in df.columns:
        df = df.withColumn("stress_vernal_x_AWC",
                           F.col("hiver_anormalement_chaud") * F.col("AWC_deep"))
    return df


def soil_final(df: DataFrame) -> DataFrame:
    """Missing gradients, medium - deep gradient, then drop every raw layer."""
    new: dict[str, Column] = {}
    for var in SOIL_VARS:
        s, m, d = (_zone_cols(df, var, z) for z in ("surface", "medium", "deep"))
        if f"{var}_gradient" not in df.columns and s and d:
            new[f"{var}_gradient"] = _zmean(df, var, "surface") - _zmean(df, var, "deep")
        if m and d:
            new[f"{var}_gradient_mid_deep"] = _zmean(df, var, "medium") - _zmean(df, var, "deep")
    out = df.withColumns(new) if new else df
    return out.drop(*columns_with_suffix(out, DEPTH_SUFFIXES))


def feature_engineering(df: DataFrame) -> DataFrame:
    """drop_listed -> products -> layer means, ratios, water, stress -> final."""
    return (df.transform(drop_listed).transform(soil_weather_products)
            .transform(soil_layer_means).transform(soil_ratios).transform(soil_water)
            .transform(stress_indices).transform(soil_final))
