"""Sequence dataset of the hourly path (data preparation for sequence models).

hourly panel -> region / year filters and the dropped pair -> three-level
median imputation of the columns that hold nulls -> cyclic time encoding ->
per (region, harvest year) the first ``length`` hours as an array of feature
vectors, zero-padded, left-joined to the static pairs (pairs without weather
get an all-zero sequence) -> train / val / test label by harvest year ->
z-scores with train moments (sequence moments count the padding; static
moments use NumPy's all-or-nothing missing values).

Normalising the arrays uses ``transform`` with the moments as literal arrays,
so it stays inside the JVM; no row leaves Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.functions.calendar import cyclic_encode, date_parts
from harvestlens.operators.cleaning import exclude_pairs, exclude_values
from harvestlens.operators.dataset import (apply_zscore, fit_zscore, padded_moments,
                                           temporal_labels)
from harvestlens.operators.impute import impute_three_level
from harvestlens.operators.reshape import attach_sequences, sequences

KEYS = ["DEPT_ID", "harvest_year"]
# Fixed values (reference): columns dropped before imputation, and columns
# that are not weather features.
DROP_BEFORE_IMPUTE = ["duree_humectation_foliaire_min", "etat_sol"]
NOT_IMPUTED = ("datetime", "DEPT_ID", "saison", "annee", "harvest_year", "heure", "jour", "mois")
NOT_FEATURES = ("datetime", "DEPT_ID", "annee", "harvest_year")


def hourly_features(panel: DataFrame, excluded: list[str], min_year_exclusive: int, max_year: int,
                    pairs_dropped: list[tuple[str, int]], time_col: str = "datetime") -> DataFrame:
    """The hourly panel filtered, imputed on three levels and with cyclic time features."""
    df = exclude_values(panel, "DEPT_ID", list(excluded))
    df = exclude_pairs(df, min_year_exclusive=min_year_exclusive, max_year=max_year,
                       pairs=list(pairs_dropped))
    df = df.drop(*DROP_BEFORE_IMPUTE).withColumns(date_parts(time_col))
    measures = [f.name for f in df.schema.fields
                if f.name not in NOT_IMPUTED and f.dataType.typeName() in ("double", "float",
                                                                           "integer", "long")]
    return cyclic_encode(impute_three_level(df, measures), time_col)


def sequence_dataset(panel: DataFrame, static: DataFrame, static_features: list[str],
                     length: int = 8760, excluded: list[str] = (), min_year_exclusive: int = 2010,
                     max_year: int = 2024, pairs_dropped: list[tuple[str, int]] = (),
                     train_max: int = 2020, val_years: tuple[int, ...] = (2021, 2022),
                     test_min: int = 2023, time_col: str = "datetime",
                     target: str | None = None):
    """Returns (dataset, feature names). ``panel``: DEPT_ID, ``time_col``,
    harvest_year, saison and numeric measures; ``static``: one row per
    (DEPT_ID, harvest_year) with the static features and the ``target``, which is carried
    along as it is. Pairs at or below ``min_year_exclusive`` are dropped; ``max_year``
    bounds the weather only."""
    # read three times below (sequences, moments): written once to the shared
    # checkpoint folder instead of re-running the imputation windows
    df = hourly_features(panel, excluded, min_year_exclusive, max_year, pairs_dropped,
                         time_col).checkpoint(eager=True)
    feats = [c for c in df.columns if c not in NOT_FEATURES]

    pairs = (exclude_values(static, "DEPT_ID", list(excluded))
             .filter(F.col("harvest_year") > min_year_exclusive)
             .select(*KEYS, *([target] if target else []), *static_features))
    seqs = sequences(df, KEYS, time_col, feats, length)
    data = attach_sequences(pairs, seqs, KEYS, length, len(feats))
    data = data.withColumn("split", temporal_labels("harvest_year", train_max, val_years,
                                                    test_min)).checkpoint(eager=True)

    # sequence moments over train pairs x length steps, padding included
    train_pairs = data.filter(F.col("split") == "train").select(*KEYS)
    w = Window.partitionBy(*KEYS).orderBy(time_col)
    rows = (df.withColumn("__pos", F.row_number().over(w)).filter(F.col("__pos") <= length)
            .join(train_pairs, KEYS, "left_semi"))
    mom = padded_moments(rows, feats, train_pairs, length).first()
    mu = F.array(*[F.lit(float(mom[f"{c}_mean"])) for c in feats])
    sd = F.array(*[F.lit(float(mom[f"{c}_std"])) for c in feats])
    norm = F.transform(F.col("seq"), lambda step: F.transform(
        step, lambda x, i: (x - F.element_at(mu, i + 1)) / F.element_at(sd, i + 1)))
    data = data.withColumn("seq", norm)

    # static moments on train pairs (one missing value -> NULL moments)
    stats = fit_zscore(data.filter(F.col("split") == "train"), static_features)
    data = apply_zscore(data, stats, static_features)
    return data, feats
