"""Driver-table bindings for the non-weather inputs.

| role                 | built from                                          |
| -------------------- | --------------------------------------------------- |
| raw station readings | lineitem x supplier (station = supplier)            |
| wide production      | lineitem x supplier x nation, one row per nation x  |
|                      | return flag, SURF_/PROD_/REND_<year> columns        |
| soil layers          | lineitem x supplier per nation, 13 variables; line  |
|                      | numbers go round the six depth layers               |
| NDVI monthly         | orders x customer x nation per year and month       |

Region labels follow the "0NN - name" layout; nations 20/21 carry the
codes 2A/2B and nations 22-24 an overseas "9.." label so that every
cleaning rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.functions.calendar import pad_code
from harvestlens.operators.soil import DEPTHS, SOIL_VARS
from harvestlens.plans.testbed import read

YEARS = list(range(1995, 2002))


def _t_raw() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double")).otherwise(
        F.col("l_quantity"))


def station_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station rows: reference column names, a yyyyMMddHH stamp, one
    column outside the keep-list, region = supplier nation (2 digits)."""
    li = read(spark, sf_dir, "lineitem")
    su = read(spark, sf_dir, "supplier")
    j = li.join(su, li.l_suppkey == su.s_suppkey)
    stamp = F.concat(F.date_format("l_shipdate", "yyyyMMdd"),
                     F.lpad((F.col("l_linenumber") * 3).cast("string"), 2, "0"))
    return j.select(
        pad_code("s_nationkey").alias("region"),
        F.col("s_suppkey").alias("NUM_POSTE"),
        F.round(F.col("s_acctbal") / 200.0, 4).alias("LAT"),
        F.round(F.col("s_acctbal") / 400.0, 4).alias("LON"),
        (F.col("s_nationkey") * 10.0).alias("ALTI"),
        stamp.alias("AAAAMMJJHH"),
        _t_raw().alias("T"),
        (F.col("l_tax") * 100.0).alias("RR1"),
        (F.col("l_discount") * 200.0).alias("FXI"),
        (F.col("l_quantity") * 2.0).alias("U"),
        F.round(F.col("l_extendedprice") / 1000.0, 1).alias("GLO"),
        F.col("l_orderkey").alias("Q_EXTRA"),
    )


def _label(nationkey: Column, name: Column) -> Column:
    code = (F.when(nationkey == 20, F.lit("2A")).when(nationkey == 21, F.lit("2B"))
            .otherwise(F.lpad(nationkey.cast("string"), 2, "0")))
    prefix = F.when(nationkey >= 22, F.lit("9")).otherwise(F.lit("0"))
    return F.concat(prefix, code, F.lit(" - "), name)


def _crop(flag: Column) -> Column:
    return (F.when(flag == "N", F.lit("Blé tendre d'hiver et épeautre"))
            .when(flag == "A", F.lit("Blé dur d'hiver"))
            .otherwise(F.lit("Orge d'hiver et escourgeon")))


def production_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (nation, return flag): SURF_y = row count, PROD_y = sum of
    quantities, REND_y = 10 x sum of discounts; a missing year stays NULL.

    Raw rows are aggregated per (nation, flag, year) on integer keys first;
    the pivot to year columns and the text labels are computed on that small
    result, and the nation table is joined after the aggregation."""
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount",
                                                "l_returnflag", "l_shipdate")
    su = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # a year outside the sheet's columns must not vanish
    known = F.when(F.year("l_shipdate").isin(YEARS), F.year("l_shipdate")).otherwise(
        F.raise_error(F.concat(F.lit("no column for year "), F.year("l_shipdate").cast("string"))).cast("int"))
    per_year = (li.join(su, li.l_suppkey == su.s_suppkey)
                .groupBy("s_nationkey", "l_returnflag", known.alias("year"))
                .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"),
                     F.sum(F.col("l_discount") * F.lit(10.0)).alias("d")))
    aggs = []
    for yr in YEARS:
        in_y = F.col("year") == F.lit(yr)
        aggs += [F.max(F.when(in_y, F.col("n").cast("double"))).alias(f"SURF_{yr}"),
                 F.max(F.when(in_y, F.col("q"))).alias(f"PROD_{yr}"),
                 F.round(F.max(F.when(in_y, F.col("d"))), 4).alias(f"REND_{yr}")]
    wide = per_year.groupBy("s_nationkey", "l_returnflag").agg(*aggs)
    wide = wide.join(na, F.col("s_nationkey") == F.col("n_nationkey"))
    statut = F.when(F.col("n_regionkey") == 4, F.lit(None).cast("string")).when(
        F.col("n_regionkey") % 2 == 0, F.lit("Définitif")).otherwise(F.lit("Provisoire"))
    return wide.select(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("LIB_REG2"),
                       _label(F.col("n_nationkey"), F.col("n_name")).alias("LIB_DEP"),
                       _crop(F.col("l_returnflag")).alias("LIB_SAA"),
                       statut.alias("STATUT_QUALITE"),
                       *[f"{m}_{yr}" for yr in YEARS for m in ("SURF", "PROD", "REND")])


# 13 soil variables from lineitem measures (sums of exact decimals, scaled).
SOIL_EXPR = {  # built lazily: Columns need an active session
    "silt": lambda: F.col("l_quantity") / 1000.0,
    "sand": lambda: F.col("l_discount") * 10.0,
    "clay": lambda: F.col("l_tax") * 10.0,
    "wv0033": lambda: F.col("l_quantity") / 100.0,
    "wv0010": lambda: F.col("l_quantity") / 50.0,
    "wv1500": lambda: F.col("l_tax") * 100.0,
    "cfvo": lambda: F.col("l_discount") * 100.0,
    "ocd": lambda: F.col("l_tax") + F.col("l_discount"),
    "soc": lambda: (F.col("l_partkey") % 100) / 100.0,
    "nitrogen": lambda: (F.col("l_suppkey") % 50) / 10.0,
    "cec": lambda: (F.col("l_orderkey") % 30) / 10.0,
    "phh2o": lambda: F.col("l_quantity") % 7,
    "bdod": lambda: F.col("l_quantity") % 11,
}


def soil_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation: DEPT_ID, dept_nom and 13 x 6 ``{var}_{depth}_mean``
    columns (line number k feeds layer (k - 1) mod 6 + 1). Sums per (nation, layer)
    first; the pivot to depth columns runs on that small result."""
    li = read(spark, sf_dir, "lineitem").withColumn(
        "layer", (F.col("l_linenumber") - 1) % len(DEPTHS) + 1)
    su = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    layers = (li.join(su, li.l_suppkey == su.s_suppkey)
              .groupBy("s_nationkey", "layer")
              .agg(*[F.sum(SOIL_EXPR[v]()).alias(v) for v in SOIL_VARS]))
    aggs = [F.round(F.max(F.when(F.col("layer") == k, F.col(var))), 4)
            .alias(f"{var}_{depth}_mean")
            for var in SOIL_VARS for k, depth in enumerate(DEPTHS, start=1)]
    wide = layers.groupBy("s_nationkey").agg(*aggs)
    wide = wide.join(na, F.col("s_nationkey") == F.col("n_nationkey"))
    return wide.select(pad_code("s_nationkey").alias("DEPT_ID"), F.col("n_name").alias("dept_nom"),
                       *[f"{v}_{d}_mean" for v in SOIL_VARS for d in DEPTHS])


def ndvi_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    monthly = (o.join(c, o.o_custkey == c.c_custkey)
               .groupBy("c_nationkey", F.year("o_orderdate").alias("year"),
                        F.month("o_orderdate").alias("month"))
               .agg(F.round(F.avg("o_totalprice") / 1000.0, 2).alias("ndvi_poly_mean")))
    monthly = monthly.join(na, F.col("c_nationkey") == F.col("n_nationkey"))
    return monthly.select(pad_code("c_nationkey").alias("DEPT_ID"),
                          F.col("n_name").alias("department_name"), "year", "month",
                          "ndvi_poly_mean")
