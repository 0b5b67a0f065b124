"""Bindings of the weather-panel roles to the driver's TPC-H-like tables.

The reference ships no data, so its operators take column names, thresholds
and run lengths as parameters; these bindings build panels with the same
shape (one row per region and time step, measures with nulls) from the
given tables, so every query's work grows with them.

Daily panel: ``lineitem`` joined to ``supplier``; region = supplier nation,
day = ship date. Hourly panel: ``events``; region = user_id % 10, hour =
truncated timestamp, replicated into the four crop stages and three harvest
years by shifting the timestamps (the events span one January).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.functions.calendar import pad_code
from harvestlens.operators.features import (DAILY_FEATURES, HOURLY_FEATURES, Quantile, Term,
                                           override)
from harvestlens.operators.mart import label_stages

DAILY_ROLES = {"ta": "t", "tx": "t", "rr": "r", "gust": "g", "hum": "hum", "rad": "rad"}
MEASURES = ["t", "r", "g", "rad", "hum"]
HOURLY_ROLES = {"ta": "t", "tx": "t", "rr": "r", "gust": "g", "hum": "t", "rad": "g"}

# Parameter changes that make every indicator non-trivial on the driver data
# (value ranges differ from weather data). Rolling sums are rounded to 4 and
# means to 6 digits so that strict comparisons agree across engines.
def _daily_features():
    ch = {
        "vernalisation_nb_jours_0_10C": {"terms": (Term("ta", ">=", 0.0), Term("ta", "<=", 25.0))},
        "hiver_anormalement_chaud": {"ndigits": 6},
        "pluie_extreme_10j": {"ndigits": 4},
        "floraison_cumul_pluie_10j_max": {"ndigits": 4},
        "humidity_persistence_risk": {"min_len": 3, "terms": (Term("hum", ">", 60.0),)},
        "nb_risques_rayonnement_faible": {
            "min_len": 2, "terms": (Term("rad", "<", Quantile(0.3, "region")),)},
        "remplissage_max_consecutive_dry_days": {"terms": (Term("rr", "<=", 3.0),)},
    }
    return override(DAILY_FEATURES, ch)


def _hourly_features():
    ch = {
        "hiver_anormalement_chaud": {"ndigits": 6},
        "pluie_extreme_10j": {"ndigits": 4, "window": 24},
        "floraison_cumul_pluie_10j_max": {"ndigits": 4, "window": 24},
        "humidity_persistence_risk": {"min_len": 3},
        "nb_risques_rayonnement_faible": {
            "min_len": 5, "terms": (Term("rad", "<", Quantile(0.3, "region")),)},
        "floraison_episodes_tx_gt_30_ge3": {"min_len": 6},
        "remplissage_episodes_heatwave_ge3": {"min_len": 6},
    }
    return override(HOURLY_FEATURES, ch)


TESTBED_DAILY = _daily_features()
TESTBED_HOURLY = _hourly_features()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (DEPT_ID, day): t (with nulls), r, g, hum, rad."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_returnflag", "l_tax", "l_discount",
        "l_extendedprice", "l_shipdate")
    su = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    t_raw = F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double")).otherwise(
        F.col("l_quantity"))
    # aggregate on the integer key; the text code is derived on the small result
    panel = (li.join(su, li.l_suppkey == su.s_suppkey)
             .groupBy("s_nationkey", F.to_date("l_shipdate").alias("day"))
             .agg(F.round(F.avg(t_raw), 6).alias("t"),
                  F.round(F.sum("l_tax") * F.lit(100.0), 4).alias("r"),
                  F.round(F.max("l_discount") * F.lit(200.0), 4).alias("g"),
                  F.round(F.sum("l_extendedprice"), 2).alias("rad"))
             .select(pad_code("s_nationkey").alias("DEPT_ID"), "day", "t", "r", "g", "rad"))
    return panel.withColumn("hum", F.round(F.lit(2.0) * F.col("t"), 6))


def daily_panel_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_stages(daily_panel(spark, sf_dir), "day")


# (day shift, value factor): four stage copies x three harvest years.
STAGE_SHIFTS = [0, 75, 136, 170]
YEAR_SHIFTS = [(-365, 0.9), (0, 1.0), (366, 1.1)]


def hourly_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    t_raw = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(
        F.col("value"))
    return (ev.groupBy((F.col("user_id") % 10).alias("__region"),
                       F.date_trunc("hour", "ts").alias("datetime"))
            .agg(F.round(F.avg(t_raw), 3).alias("t"),
                 F.round(F.sum("value"), 4).alias("r"),
                 F.round(F.max("value"), 4).alias("g"))
            .select(pad_code("__region").alias("DEPT_ID"), "datetime", "t", "r", "g"))


def hourly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (DEPT_ID, datetime) over 4 stages x 3 harvest years.

    t keeps 4 decimals so that hourly sums divided by 24 are exact at 7
    digits (compared at 7 digits, no rounding ties between engines)."""
    shifts = F.array(*[F.struct(F.lit(s + y).alias("days"), F.lit(fct).alias("fct"))
                       for s in STAGE_SHIFTS for (y, fct) in YEAR_SHIFTS])
    base = hourly_base(spark, sf_dir)
    out = base.select("DEPT_ID", "datetime", "t", "r", "g", F.explode(shifts).alias("s"))
    return out.select(
        "DEPT_ID",
        (F.col("datetime") + F.make_interval(days=F.col("s.days"))).alias("datetime"),
        *[F.round(F.col(c) * F.col("s.fct"), 4 if c == "t" else 5).alias(c)
          for c in ("t", "r", "g")])


def hourly_panel_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_stages(hourly_panel(spark, sf_dir), "datetime")
