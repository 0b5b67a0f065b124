"""Wide/long reshaping and per-key sequences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.functions.columns import columns_with_prefix
from harvestlens.operators.cleaning import filter_label_contains, region_codes_from_label

# Production sheet layout of the reference.
YIELD_ID_COLS = ["DEPT_ID", "DEPT", "TYPE BLE", "STATUT_QUALITE"]
MEASURE_PREFIXES = {"SURF_": "SURFACE", "PROD_": "PRODUCTION", "REND_": "RENDEMENT"}
CROP_LABEL = "blé tendre d'hiver"


def melt_measure(df: DataFrame, ids: list[str], prefix: str, value_name: str,
                 var_name: str = "ANNEE") -> DataFrame:
    """Wide ``<prefix><year>`` columns to one row per id and year; nulls kept;
    the year is the column suffix (string, as in the reference)."""
    cols = columns_with_prefix(df, prefix)
    long = df.unpivot(ids, cols, var_name, value_name)
    return long.withColumn(var_name, F.regexp_replace(F.col(var_name), f"^{prefix}", ""))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join where NULL matches NULL on every key (pandas ``merge``)."""
    r = right.select(*[F.col(f"`{k}`").alias(f"__r_{i}") for i, k in enumerate(keys)],
                     *[F.col(f"`{c}`") for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [left[f"`{k}`"].eqNullSafe(r[f"__r_{i}"]) for i, k in enumerate(keys)])
    out = left.join(r, cond, how)
    return out.drop(*[f"__r_{i}" for i in range(len(keys))])


def production_long(wide: DataFrame, crop: str = CROP_LABEL, label_col: str = "LIB_SAA",
                    region_label: str = "LIB_DEP", drop_cols: tuple[str, ...] = ("LIB_REG2",),
                    year_type: str = "string") -> DataFrame:
    """Wide production sheet -> long table (DEPT_ID, DEPT, TYPE BLE,
    STATUT_QUALITE, ANNEE, SURFACE, PRODUCTION, RENDEMENT).

    The three measure families are melted separately and re-joined on the
    five keys with NULL = NULL (the reference's pandas merge). When the id
    columns are unique per row a single ``stack`` would do; the join form is
    kept because the sheet gives no such guarantee.
    """
    df = filter_label_contains(wide, label_col, crop)
    df = region_codes_from_label(df, region_label)
    df = df.drop(*drop_cols).withColumnRenamed(label_col, "TYPE BLE")
    parts = [melt_measure(df, YIELD_ID_COLS, p, v) for p, v in MEASURE_PREFIXES.items()]
    keys = YIELD_ID_COLS + ["ANNEE"]
    out = null_safe_join(parts[0], parts[1], keys)
    out = null_safe_join(out, parts[2], keys)
    if year_type != "string":
        out = out.withColumn("ANNEE", F.col("ANNEE").cast(year_type))
    return out


def sequences(df: DataFrame, keys: list[str], order_col: str, feature_cols: list[str],
              length: int, pad_value: float = 0.0) -> DataFrame:
    """Per key: the first ``length`` rows in time order as an array of
    feature arrays, zero-padded at the end to ``length``.

    Rows beyond ``length`` are dropped *before* collecting (row number in a
    window per key), so the collected array per key is bounded by
    ``length`` x features. Input is a panel (one row per key and time step),
    so the window partition is bounded by the calendar as well.
    """
    w = Window.partitionBy(*keys).orderBy(order_col)
    ranked = (df.withColumn("__pos", F.row_number().over(w))
              .filter(F.col("__pos") <= F.lit(length)))
    feats = F.array(*[F.col(c).cast("double") for c in feature_cols])
    grouped = ranked.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("__pos"), feats.alias("x")))).alias("__rows"),
        F.count(F.lit(1)).alias("n_steps"))
    pad = F.array(*[F.lit(float(pad_value)) for _ in feature_cols])
    seq = F.concat(F.transform(F.col("__rows"), lambda r: r["x"]),
                   F.array_repeat(pad, F.lit(length) - F.col("n_steps").cast("int")))
    return grouped.select(*keys, seq.alias("seq"), F.col("n_steps").cast("int").alias("n_steps"))


def attach_sequences(pairs: DataFrame, seqs: DataFrame, keys: list[str], length: int,
                     n_features: int, pad_value: float = 0.0) -> DataFrame:
    """Left-join sequences to the (region, year) pairs; pairs without
    weather get an all-padding sequence."""
    pad = F.array(*[F.lit(float(pad_value)) for _ in range(n_features)])
    empty = F.array_repeat(pad, F.lit(length))
    out = pairs.join(seqs, keys, "left")
    return out.withColumns({"seq": F.coalesce(F.col("seq"), empty),
                            "n_steps": F.coalesce(F.col("n_steps"), F.lit(0))})


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
