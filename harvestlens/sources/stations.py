"""Station files -> region hourly and daily weather panels.

The reference reads one CSV per département in 50 000-row chunks and
averages per chunk; here one directory scan feeds one aggregate, and Spark's
partial (map-side) aggregation plays the role of the chunks. A region that
holds a large share of all readings is combined map-side before the
shuffle, so no task sees its raw rows at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.functions.calendar import parse_hour_stamp
from harvestlens.functions.columns import keep_columns, rename_columns
from harvestlens.functions.nulls import nan_to_null, sum_or_zero

# The 35 raw station columns kept by the reference (of 206),
# in its order.
STATION_KEEP = [
    "NUM_POSTE", "LAT", "LON", "ALTI", "AAAAMMJJHH",
    "T", "TN", "TX", "TD", "TNSOL", "TCHAUSSEE", "T10", "T20", "T50", "T100", "DG",
    "U", "UN", "HUN", "UX", "HUX", "DHUMI80", "DHUMI40", "DHUMEC", "TSV",
    "RR1", "DRR1",
    "FF", "FXI", "DD",
    "GLO", "INS",
    "NEIGETOT", "SOL",
    "PMER",
]

# Raw station column -> readable name, in the reference's order.
STATION_RENAME = {
    "NUM_POSTE": "id_station",
    "LAT": "latitude",
    "LON": "longitude",
    "ALTI": "altitude_m",
    "DATE": "datetime",
    "T": "temp_air_c",
    "TN": "temp_min_c",
    "TX": "temp_max_c",
    "TD": "temp_rosee_c",
    "TNSOL": "temp_min_sol_10cm_c",
    "TCHAUSSEE": "temp_surface_sol_c",
    "T10": "temp_sol_10cm_c",
    "T20": "temp_sol_20cm_c",
    "T50": "temp_sol_50cm_c",
    "T100": "temp_sol_100cm_c",
    "DG": "duree_gel_min",
    "U": "humidite_relative_pct",
    "UN": "humidite_min_pct",
    "HUN": "heure_humidite_min",
    "UX": "humidite_max_pct",
    "HUX": "heure_humidite_max",
    "DHUMI80": "duree_humidite_sup80_min",
    "DHUMI40": "duree_humidite_inf40_min",
    "DHUMEC": "duree_humectation_foliaire_min",
    "TSV": "tension_vapeur_hpa",
    "RR1": "precipitations_1h_mm",
    "DRR1": "duree_precipitations_min",
    "FF": "vent_moyen_10m_ms",
    "FXI": "rafale_max_ms",
    "DD": "direction_vent_deg",
    "GLO": "rayonnement_global_jcm2",
    "INS": "insolation_min",
    "NEIGETOT": "hauteur_neige_sol_cm",
    "SOL": "etat_sol",
    "PMER": "pression_mer_hpa",
}

# Daily aggregation rules of the reference (means, then sums),
# in its order.
DAILY_MEAN_COLS = [
    "temp_air_c", "temp_min_c", "temp_max_c", "temp_rosee_c",
    "humidite_relative_pct", "humidite_min_pct", "humidite_max_pct",
    "vent_moyen_10m_ms", "rafale_max_ms", "tension_vapeur_hpa",
    "pression_mer_hpa", "temp_sol_10cm_c", "temp_sol_20cm_c",
    "temp_sol_50cm_c", "temp_sol_100cm_c", "temp_surface_sol_c",
    "temp_min_sol_10cm_c", "heure_humidite_min", "heure_humidite_max",
    "direction_vent_deg", "hauteur_neige_sol_cm", "etat_sol",
    "duree_humectation_foliaire_min",
]
DAILY_SUM_COLS = [
    "precipitations_1h_mm", "duree_precipitations_min",
    "duree_gel_min", "insolation_min", "rayonnement_global_jcm2",
    "duree_humidite_inf40_min", "duree_humidite_sup80_min",
]

STATION_ID_COLS = ("id_station", "latitude", "longitude", "datetime")


def station_to_region_hourly(raw: DataFrame, region: str | object, keep: list[str] = STATION_KEEP,
                             rename: dict[str, str] = STATION_RENAME,
                             stamp_col: str = "AAAAMMJJHH") -> DataFrame:
    """Keep-list, parse the hour stamp, rename, mean of every measure over the
    stations of a region per hour. ``region`` is a column name or Column
    (e.g. ``id_from_path()``)."""
    region_c = F.col(region) if isinstance(region, str) else region
    df = raw.withColumn("__region", region_c)
    df = keep_columns(df, list(keep) + ["__region"])
    df = df.withColumn("DATE", parse_hour_stamp(stamp_col)).drop(stamp_col)
    df = rename_columns(df, rename)
    measures = [c for c in df.columns if c not in STATION_ID_COLS and c != "__region"]
    df = nan_to_null(df).filter(F.col("__region").isNotNull() & F.col("datetime").isNotNull())
    return (df.groupBy(F.col("__region").alias("dept_id"), "datetime")
            .agg(*[F.avg(c).alias(c) for c in measures]))


def daily_from_hourly(hourly: DataFrame, mean_cols: list[str] | None = DAILY_MEAN_COLS,
                      sum_cols: list[str] | None = DAILY_SUM_COLS, region: str = "dept_id",
                      time_col: str = "datetime") -> DataFrame:
    """Region daily panel: mean and sum columns by rule (absent ones skipped).
    With no rules, every numeric column is averaged. A day whose values of a
    summed column are all missing sums to 0 (pandas semantics)."""
    day = F.to_date(F.col(time_col)).alias("day")
    # pandas groups skip null keys and NaN values
    hourly = nan_to_null(hourly).filter(F.col(region).isNotNull() & F.col(time_col).isNotNull())
    if mean_cols is None and sum_cols is None:
        from harvestlens.functions.columns import numeric_columns
        num = numeric_columns(hourly, exclude=(region,))
        return hourly.groupBy(region, day).agg(*[F.avg(c).alias(c) for c in num])
    present = set(hourly.columns)
    aggs = [F.avg(c).alias(c) for c in (mean_cols or []) if c in present]
    aggs += [sum_or_zero(c).alias(c) for c in (sum_cols or []) if c in present]
    return hourly.groupBy(region, day).agg(*aggs)


def daily_from_consolidated(raw: DataFrame, region: str = "dept_id",
                            time_col: str = "datetime") -> DataFrame:
    """Consolidated region-hourly CSV -> daily panel: drop rows whose
    altitude is not numeric (repeated header lines), cast every rule column
    that exists to double, parse the time, aggregate by the daily rules."""
    from harvestlens.functions.columns import cast_columns
    from harvestlens.sources.catalog import filter_numeric
    df = filter_numeric(raw, "altitude_m") if "altitude_m" in raw.columns else raw
    df = cast_columns(df, {c: "double" for c in DAILY_MEAN_COLS + DAILY_SUM_COLS + ["altitude_m"]})
    df = df.withColumn(time_col, F.to_timestamp(F.col(time_col)))
    return daily_from_hourly(df, region=region, time_col=time_col)


def consolidate(df: DataFrame, out_path: str, region_col: str = "dept_id",
                mode: str = "overwrite", files_per_region: int = 8) -> None:
    """Write the region hourly table once, partitioned by region (one
    directory scan replaces the per-file append loop). The region stays a data
    column; the directory level is a copy named ``dept`` because partition
    discovery would turn codes like "01" into the integer 1."""
    # a few files per region: rows of a region meet in up to ``files_per_region`` tasks,
    # so a region with most of the rows is not one task's work
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_region))
    (df.withColumn("dept", F.col(region_col)).repartition(F.col("dept"), salt)
     .write.mode(mode).partitionBy("dept").parquet(out_path))


def read_consolidated(spark, path: str) -> DataFrame:
    """Read a table written by ``consolidate``."""
    return spark.read.parquet(path).drop("dept")
