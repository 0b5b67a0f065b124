"""Registered queries beyond the indicator kernels, with their DuckDB oracles.

Each ``_q_<key>(spark, sf_dir)`` builds its input from the driver tables
(``testbed`` / ``testbed_tables``) and runs one library operator; the SQL of
the same key is written independently in ``catalog_sql`` style. Keys without
SQL (model fitting, run log) get the weaker rows-only check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlens.functions.calendar import crop_stage, date_parts, harvest_year, pad_code
from harvestlens.functions.calendar import cyclic_encode, parse_hour_stamp
from harvestlens.functions.columns import (cast_columns, drop_columns, keep_columns,
                                           rename_columns, round_doubles)
from harvestlens.functions.nulls import rowwise_mean
from harvestlens.operators import blocks
from harvestlens.operators import dataset as ds
from harvestlens.operators import soil as so
from harvestlens.operators.cleaning import (clean_target, drop_null_target, exclude_pairs,
                                            exclude_values, filter_label_contains, holdout_split,
                                            label_weather, region_codes_from_label)
from harvestlens.operators.impute import impute_three_level, impute_two_level, null_profile
from harvestlens.operators.mart import build_mart, build_mart_outer
from harvestlens.operators.quantile import quantile_columns
from harvestlens.operators.reshape import (attach_sequences, melt_measure, null_safe_join,
                                           production_long, sequences, union_sources)
from harvestlens.operators.runs import run_ids, rolling_sum, spine_fill
from harvestlens.plans import catalog_sql as cs
from harvestlens.plans import testbed as tb
from harvestlens.plans import testbed_tables as tt
from harvestlens.plans.sql_oracle import (SEASON_SQL, FeatureSQL, daily_panel_sql, harvest_year_sql,
                                          hourly_panel_sql, rounded)
from harvestlens.plans.training import (annual_weather, join_renamed_key, join_static,
                                        join_suffixed, ndvi_annual, training_mart,
                                        training_mart_annual, training_static_hourly,
                                        weather_daily_clean)
from harvestlens.session import stored
from harvestlens.sources.catalog import (Catalog, Dataset, filter_numeric, id_from_path,
                                         promote_header, typed_scan)
from harvestlens.sources.stations import daily_from_hourly, station_to_region_hourly

Q: dict = {}
SQL: dict = {}


def _reg(key: str, sql: str | None = None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn
    return deco


def _r(sql: str, doubles: list[str], cols: list[str], nd: int = 6) -> str:
    return rounded(sql, doubles, cols, nd)


def _q(c: str) -> str:
    return f'"{c}"'


# ------------------------------------------------------------------ shared inputs

def _daily(spark, sf):
    return tb.daily_panel_labeled(spark, sf)


def _hourly(spark, sf):
    return tb.hourly_panel_labeled(spark, sf)


def _stations_hourly(spark, sf):
    return station_to_region_hourly(tt.station_readings(spark, sf), "region")


def _stations_daily(spark, sf):
    return daily_from_hourly(_stations_hourly(spark, sf))


def _target(spark, sf, year_type="int"):
    return production_long(tt.production_wide(spark, sf), year_type=year_type)


def _static(spark, sf):
    t = clean_target(_target(spark, sf))
    m = join_static(t, tt.soil_layers(spark, sf))
    return join_suffixed(m, ndvi_annual(tt.ndvi_monthly(spark, sf)), ["DEPT_ID", "ANNEE"])


def _mart_daily(spark, sf):
    """Indicators on the imputed panel (two-level medians), as the training marts use them."""
    panel = impute_two_level(_daily(spark, sf), tb.MEASURES)
    panel = panel.withColumns({c: F.round(F.col(c), 6) for c in tb.MEASURES})
    return build_mart(panel, tb.TESTBED_DAILY, time_col="day", roles=tb.DAILY_ROLES)


def _training(spark, sf):
    return training_mart(_target(spark, sf), tt.soil_layers(spark, sf),
                         tt.ndvi_monthly(spark, sf), _mart_daily(spark, sf))


SOIL_COLS = [f"{v}_{d}_mean" for v in so.SOIL_VARS for d in so.DEPTHS]
FEATURE_NAMES = [f.name for f in tb.TESTBED_DAILY]
FEATURE_DOUBLES = [f.name for f in tb.TESTBED_DAILY if f.kind in ("excess", "roll_max")]
STATIC_COLS = ["DEPT_ID", "DEPT_x", "STATUT_QUALITE", "ANNEE", "RENDEMENT"] + SOIL_COLS + [
    "DEPT_y", "ndvi_poly_mean"]
STATIC_DOUBLES = ["RENDEMENT", "ndvi_poly_mean"] + SOIL_COLS


def _mart_sql() -> str:
    """The mart on the raw panel."""
    return FeatureSQL(daily_panel_sql(), tb.DAILY_ROLES, "day").mart(tb.TESTBED_DAILY)


def _imputed_mart_sql() -> str:
    panel = daily_panel_sql()
    for keys in ("DEPT_ID, harvest_year", "DEPT_ID"):
        fill = ", ".join(f"coalesce({c}, median({c}) OVER (PARTITION BY {keys})) AS {c}" for c in tb.MEASURES)
        panel = f"SELECT * REPLACE ({fill}) FROM ({panel}) p"
    panel = "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in tb.MEASURES) + f") FROM ({panel}) p"
    return FeatureSQL(panel, tb.DAILY_ROLES, "day").mart(tb.TESTBED_DAILY)


def _training_sql() -> str:
    feats = ", ".join(f"m.{n}" for n in FEATURE_NAMES)
    stat = ", ".join(f"s.{_q(c)}" if c != "ANNEE" else "s.ANNEE AS harvest_year"
                     for c in STATIC_COLS)
    return (f"SELECT {stat}, {feats} FROM ({cs.static_sql()}) s JOIN ({_imputed_mart_sql()}) m "
            f"ON s.DEPT_ID = m.DEPT_ID AND s.ANNEE = m.harvest_year")


TRAINING_COLS = [c if c != "ANNEE" else "harvest_year" for c in STATIC_COLS] + FEATURE_NAMES
TRAINING_DOUBLES = STATIC_DOUBLES + FEATURE_DOUBLES


def _sel(cols):
    return ", ".join(_q(c) for c in cols)


# ------------------------------------------------------------------ 2.1 sources

@_reg("scan_named", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) "
                    "AS o_orderdate FROM orders")
def _q_scan_named(spark, sf):
    cat = Catalog(spark, {
        "orders": Dataset(f"{sf}/orders.parquet", casts={"o_totalprice": "double"},
                          date_col="o_orderdate"),
        "table_by_name": Dataset(sf + "/{region}.parquet", per_region=True),
    })
    return cat.read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@_reg("scan_typed", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
                    "TRY_CAST(l_quantity AS INTEGER) AS l_quantity, CAST(l_shipdate AS DATE) "
                    "AS l_shipdate FROM lineitem")
def _q_scan_typed(spark, sf):
    df = typed_scan(spark, f"{sf}/lineitem.parquet",
                    casts={"l_linenumber": "bigint", "l_quantity": "int", "absent": "int"},
                    date_col="l_shipdate")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


_MALFORMED = ("CASE WHEN p_partkey % 17 = 0 THEN 'n/a' WHEN p_partkey % 19 = 0 THEN 'altitude_m' "
              "WHEN p_partkey % 23 = 0 THEN 'NaN' WHEN p_partkey % 29 = 0 THEN '12d' "
              "ELSE CAST(p_size AS VARCHAR) END")


@_reg("filter_malformed", f"SELECT p_partkey, CAST(altitude_m AS DOUBLE) AS altitude_m FROM "
                          f"(SELECT p_partkey, {_MALFORMED} AS altitude_m FROM part) p "
                          f"WHERE regexp_full_match(altitude_m, '[0-9]+([.][0-9]+)?')")
def _q_filter_malformed(spark, sf):
    p = tb.read(spark, sf, "part")
    alt = (F.when(F.col("p_partkey") % 17 == 0, F.lit("n/a"))
           .when(F.col("p_partkey") % 19 == 0, F.lit("altitude_m"))
           .when(F.col("p_partkey") % 23 == 0, F.lit("NaN"))
           .when(F.col("p_partkey") % 29 == 0, F.lit("12d"))
           .otherwise(F.col("p_size").cast("string")))
    df = p.select("p_partkey", alt.alias("altitude_m"))
    return filter_numeric(df, "altitude_m").withColumn("altitude_m",
                                                       F.col("altitude_m").cast("double"))


_STATION_H_COLS = ["dept_id", "datetime", "altitude_m", "temp_air_c", "precipitations_1h_mm",
                   "rafale_max_ms", "humidite_relative_pct", "rayonnement_global_jcm2"]


@_reg("station_to_dept_hourly", _r(cs.station_hourly_sql(), _STATION_H_COLS[2:], _STATION_H_COLS))
def _q_station_hourly(spark, sf):
    return round_doubles(_stations_hourly(spark, sf))


@_reg("consolidate", _r(cs.station_hourly_sql(), _STATION_H_COLS[2:], _STATION_H_COLS))
def _q_consolidate(spark, sf):
    from harvestlens.session import scratch
    from harvestlens.sources.stations import consolidate, read_consolidated
    path = scratch(spark, "consolidated")
    consolidate(_stations_hourly(spark, sf), path)
    return round_doubles(read_consolidated(spark, path))


_REGION_COLS = ["DEPT_ID", "day", "harvest_year", "saison", "temp_air_c", "precipitations_1h_mm"]


@_reg("scan_region_daily", _r(
    f"SELECT lpad(dept_id, 2, '0') AS DEPT_ID, day, {harvest_year_sql('day')} AS harvest_year, {SEASON_SQL.format(t='day')} AS saison, "
    f"temp_air_c, precipitations_1h_mm FROM ({cs.station_daily_sql()}) d "
    f"WHERE dept_id = (SELECT min(dept_id) FROM ({cs.station_daily_sql()}) x)",
    _REGION_COLS[4:], _REGION_COLS))
def _q_scan_region_daily(spark, sf):
    """One region's hourly table by name, as a daily panel by its rules, then labelled."""
    from harvestlens.session import scratch
    from harvestlens.sources.stations import consolidate
    path = scratch(spark, "consolidated")
    consolidate(_stations_hourly(spark, sf), path)
    cat = Catalog(spark, {"hourly": Dataset(path + "/dept={region}", per_region=True,
                                            daily=(["temp_air_c"], ["precipitations_1h_mm"]))})
    first = spark.read.parquet(path).agg(F.min("dept_id")).first()[0]
    return round_doubles(label_weather(cat.read("hourly", region=first), "day").select(*_REGION_COLS))


_STATION_D_COLS = ["dept_id", "day", "temp_air_c", "humidite_relative_pct", "rafale_max_ms",
                   "precipitations_1h_mm", "rayonnement_global_jcm2"]


@_reg("daily_from_hourly", _r(cs.station_daily_sql(), _STATION_D_COLS[2:], _STATION_D_COLS))
def _q_daily_from_hourly(spark, sf):
    return round_doubles(_stations_daily(spark, sf))


_NUM_MEAN_COLS = ["dept_id", "day"] + _STATION_H_COLS[2:]


@_reg("agg_numeric_mean", _r(
    "SELECT dept_id, CAST(datetime AS DATE) AS day, "
    + ", ".join(f"avg({c}) AS {c}" for c in _STATION_H_COLS[2:])
    + f" FROM ({cs.station_hourly_sql()}) h GROUP BY 1, 2", _NUM_MEAN_COLS[2:], _NUM_MEAN_COLS, 8))
def _q_agg_numeric_mean(spark, sf):
    # means of means of 4-decimal data have at most 7 exact decimals: compare
    # at 8 digits so no value sits on a rounding tie
    return round_doubles(daily_from_hourly(_stations_hourly(spark, sf), None, None), 8)


_SOURCES = ["lineitem", "orders", "customer"]


@_reg("id_from_path", " UNION ALL ".join(
    f"SELECT '{t}' AS source_id, count(*) AS n_rows FROM {t}" for t in _SOURCES))
def _q_id_from_path(spark, sf):
    frames = [spark.read.parquet(f"{sf}/{t}.parquet").select(
        id_from_path(r"([A-Za-z_]+)\.parquet$", 1).alias("source_id")) for t in _SOURCES]
    return union_sources(frames).groupBy("source_id").agg(F.count(F.lit(1)).alias("n_rows"))


@_reg("promote_header", "SELECT CAST(n_nationkey AS VARCHAR) AS CODE, n_name AS NOM, "
                        "CAST(n_regionkey AS VARCHAR) AS REGION FROM nation")
def _q_promote_header(spark, sf):
    reg = tb.read(spark, sf, "region").orderBy("r_regionkey")
    junk = reg.select(F.col("r_name").alias("_c0"), F.lit("").alias("_c1"), F.lit("").alias("_c2"))
    header = spark.range(1).select(F.lit("CODE").alias("_c0"), F.lit("NOM").alias("_c1"),
                                   F.lit("REGION").alias("_c2"))
    body = tb.read(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("_c0"),
                                               F.col("n_name").alias("_c1"),
                                               F.col("n_regionkey").cast("string").alias("_c2"))
    sheet = junk.coalesce(1).unionByName(header).unionByName(body)
    return promote_header(sheet, header_index=reg.count())


@_reg("union_sources", "SELECT DEPT_ID, day, t, r, NULL::DOUBLE AS g FROM ("
      + daily_panel_sql() + ") p WHERE year(day) < 1998 UNION ALL SELECT DEPT_ID, day, t, "
      "NULL::DOUBLE AS r, g FROM (" + daily_panel_sql() + ") p WHERE year(day) >= 1998")
def _q_union_sources(spark, sf):
    p = tb.daily_panel(spark, sf)
    a = p.filter(F.year("day") < 1998).select("DEPT_ID", "day", "t", "r")
    b = p.filter(F.year("day") >= 1998).select("DEPT_ID", "day", "t", "g")
    return union_sources([a, b])


# ------------------------------------------------------------------ 2.2 projections

@_reg("project_keep", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _q_project_keep(spark, sf):
    return keep_columns(tb.read(spark, sf, "lineitem"),
                        ["l_quantity", "l_orderkey", "not_a_column", "l_linenumber"])


@_reg("rename_map", "SELECT s_suppkey AS id_station, s_name, s_nationkey, s_acctbal AS altitude_m "
                    "FROM supplier")
def _q_rename_map(spark, sf):
    return rename_columns(tb.read(spark, sf, "supplier"),
                          {"s_suppkey": "id_station", "s_acctbal": "altitude_m", "s_missing": "x"})


@_reg("project_drop", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                      "l_extendedprice, l_shipdate FROM lineitem")
def _q_project_drop(spark, sf):
    return drop_columns(tb.read(spark, sf, "lineitem"),
                        ["l_comment", "l_tax", "l_discount", "l_returnflag", "l_linestatus"])


@_reg("cast_map", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, "
                  "CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part")
def _q_cast_map(spark, sf):
    return cast_columns(tb.read(spark, sf, "part"),
                        {"p_size": "double", "p_partkey": "string", "nope": "int"})


_STAMP_SQL = ("strftime(l_shipdate, '%Y%m%d') || lpad(CAST(l_linenumber * 3 AS VARCHAR), 2, '0')")


@_reg("parse_hour_stamp", f"SELECT l_orderkey, l_linenumber, strptime({_STAMP_SQL}, '%Y%m%d%H') "
                          f"AS ts FROM lineitem")
def _q_parse_hour_stamp(spark, sf):
    li = tb.read(spark, sf, "lineitem")
    stamp = F.concat(F.date_format("l_shipdate", "yyyyMMdd"),
                     F.lpad((F.col("l_linenumber") * 3).cast("string"), 2, "0"))
    return li.select("l_orderkey", "l_linenumber", parse_hour_stamp(stamp).alias("ts"))


@_reg("trunc_day", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _q_trunc_day(spark, sf):
    return tb.read(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))


@_reg("date_parts", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS heure, CAST(day(ts) AS INTEGER) "
                    "AS jour, CAST(month(ts) AS INTEGER) AS mois, CAST(year(ts) AS INTEGER) AS annee "
                    "FROM events")
def _q_date_parts(spark, sf):
    return tb.read(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in
                                                             date_parts("ts").items()])


@_reg("crop_season", f"SELECT {cs.season_case('l_shipdate')} AS saison, count(*) AS n_rows "
                     f"FROM lineitem GROUP BY 1")
def _q_crop_season(spark, sf):
    return (tb.read(spark, sf, "lineitem").groupBy(crop_stage("l_shipdate").alias("saison"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@_reg("harvest_year", f"SELECT {cs.harvest_year_sql('l_shipdate')} AS harvest_year, count(*) AS "
                      f"n_rows FROM lineitem GROUP BY 1")
def _q_harvest_year(spark, sf):
    return (tb.read(spark, sf, "lineitem").groupBy(harvest_year("l_shipdate").alias("harvest_year"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


_CYC = ["heure_sin", "heure_cos", "jour_sin", "jour_cos", "mois_sin", "mois_cos",
        "saison_sin", "saison_cos"]


def _cyc_sql():
    stage = ("CASE " + " ".join(f"WHEN saison = '{s}' THEN {i}" for i, s in enumerate(
        ["semis", "vernalisation", "tallage", "montaison", "floraison", "remplissage"])) + " END")
    parts = {"heure": ("hour(datetime)", 24), "jour": ("day(datetime)", 31),
             "mois": ("month(datetime)", 12), "saison": (stage, 6)}
    cols = []
    for n, (e, p) in parts.items():
        cols.append(f"round(sin(2 * pi() * ({e}) / {p}.0), 6) + 0.0 AS {n}_sin")
        cols.append(f"round(cos(2 * pi() * ({e}) / {p}.0), 6) + 0.0 AS {n}_cos")
    return f"SELECT DEPT_ID, datetime, {', '.join(cols)} FROM ({hourly_panel_sql()}) h"


@_reg("cyclic_encode", _cyc_sql())
def _q_cyclic_encode(spark, sf):
    df = _hourly(spark, sf).select("DEPT_ID", "datetime")
    out = cyclic_encode(df)
    return out.withColumns({c: F.round(F.col(c), 6) + F.lit(0.0) for c in _CYC})


@_reg("pad_code", "SELECT c_custkey, CASE WHEN c_custkey < 10 THEN '0' || CAST(c_custkey AS VARCHAR) "
                  "ELSE CAST(c_custkey AS VARCHAR) END AS DEPT_ID "
                  "FROM customer")
def _q_pad_code(spark, sf):
    return tb.read(spark, sf, "customer").select("c_custkey", pad_code("c_custkey").alias("DEPT_ID"))


@_reg("filter_contains", "SELECT p_partkey, lower(p_type) AS p_type FROM part "
                         "WHERE lower(p_type) LIKE '%medium%'")
def _q_filter_contains(spark, sf):
    return filter_label_contains(tb.read(spark, sf, "part").select("p_partkey", "p_type"),
                                 "p_type", "Medium")


@_reg("string_codes", f"SELECT LIB_SAA, STATUT_QUALITE, substr(regexp_replace(LIB_DEP, '^0', ''), 1, 2) "
                      f"AS DEPT_ID, substr(regexp_replace(LIB_DEP, '^0', ''), 5) AS DEPT FROM "
                      f"({cs.wide_sql()}) w WHERE LIB_DEP LIKE '0%'")
def _q_string_codes(spark, sf):
    w = tt.production_wide(spark, sf).select("LIB_SAA", "STATUT_QUALITE", "LIB_DEP")
    return region_codes_from_label(w, "LIB_DEP")


_LONG_COLS = ["DEPT_ID", "DEPT", "TYPE BLE", "STATUT_QUALITE", "ANNEE", "SURFACE", "PRODUCTION",
              "RENDEMENT"]


@_reg("drop_null_target", _r(f"SELECT * FROM ({cs.production_long_sql()}) p WHERE RENDEMENT "
                             f"IS NOT NULL", ["SURFACE", "PRODUCTION", "RENDEMENT"], _LONG_COLS))
def _q_drop_null_target(spark, sf):
    return round_doubles(drop_null_target(_target(spark, sf, "string")))


@_reg("clean_target", _r(cs.clean_target_sql(), ["RENDEMENT"],
                         ["DEPT_ID", "DEPT", "STATUT_QUALITE", "ANNEE", "RENDEMENT"]))
def _q_clean_target(spark, sf):
    return round_doubles(clean_target(_target(spark, sf)))


@_reg("exclude_set", f"SELECT DEPT_ID, count(*) AS n_rows FROM ({daily_panel_sql()}) p "
                     f"WHERE DEPT_ID NOT IN ('03', '04') GROUP BY 1")
def _q_exclude_set(spark, sf):
    return (exclude_values(_daily(spark, sf), "DEPT_ID", ["03", "04"])
            .groupBy("DEPT_ID").agg(F.count(F.lit(1)).alias("n_rows")))


@_reg("exclude_pairs", f"SELECT DEPT_ID, harvest_year, count(*) AS n_rows FROM ({daily_panel_sql()}) p "
                       f"WHERE harvest_year > 1995 AND harvest_year <= 2001 AND NOT (DEPT_ID = '13' "
                       f"AND harvest_year = 1998) GROUP BY 1, 2")
def _q_exclude_pairs(spark, sf):
    df = exclude_pairs(_daily(spark, sf), min_year_exclusive=1995, max_year=2001,
                       pairs=[("13", 1998)])
    return df.groupBy("DEPT_ID", "harvest_year").agg(F.count(F.lit(1)).alias("n_rows"))


@_reg("holdout_year", f"SELECT DEPT_ID, harvest_year, CASE WHEN harvest_year = 2001 THEN 'holdout' "
                      f"ELSE 'train' END AS split FROM ({_training_sql()}) t")
def _q_holdout_year(spark, sf):
    train, hold = holdout_split(_training(spark, sf), "harvest_year", 2001)
    return (train.select("DEPT_ID", "harvest_year", F.lit("train").alias("split"))
            .unionByName(hold.select("DEPT_ID", "harvest_year", F.lit("holdout").alias("split"))))


# ------------------------------------------------------------------ 2.3 joins

_JS_COLS = ["DEPT_ID", "DEPT", "STATUT_QUALITE", "ANNEE", "RENDEMENT"] + SOIL_COLS


@_reg("join_static", _r(f"SELECT t.*, s.* EXCLUDE (DEPT_ID, dept_nom) FROM ({cs.clean_target_sql()}) t "
                        f"JOIN ({cs.soil_sql()}) s ON t.DEPT_ID = s.DEPT_ID",
                        ["RENDEMENT"] + SOIL_COLS, _JS_COLS))
def _q_join_static(spark, sf):
    return round_doubles(join_static(clean_target(_target(spark, sf)), tt.soil_layers(spark, sf)))


@_reg("join_year", _r(cs.static_sql(), STATIC_DOUBLES, STATIC_COLS))
def _q_join_year(spark, sf):
    return round_doubles(_static(spark, sf))


@_reg("join_harvest", _r(_training_sql(), TRAINING_DOUBLES, TRAINING_COLS))
def _q_join_harvest(spark, sf):
    return round_doubles(_training(spark, sf))


Q["training_mart"] = _q_join_harvest
SQL["training_mart"] = SQL["join_harvest"]


@_reg("join_renamed_key", _r(
    f"SELECT s.*, m.* EXCLUDE (DEPT_ID, harvest_year) FROM ({cs.static_sql()}) s JOIN "
    f"({_imputed_mart_sql()}) m ON s.DEPT_ID = m.DEPT_ID AND s.ANNEE = m.harvest_year",
    TRAINING_DOUBLES, STATIC_COLS + FEATURE_NAMES))
def _q_join_renamed_key(spark, sf):
    return round_doubles(join_renamed_key(_static(spark, sf), _mart_daily(spark, sf),
                                          ["DEPT_ID", "ANNEE"], ["DEPT_ID", "harvest_year"]))


@_reg("mart_outer", _r(_mart_sql(), FEATURE_DOUBLES, ["DEPT_ID", "harvest_year"] + FEATURE_NAMES))
def _q_mart_outer(spark, sf):
    # 19 marts read the panel: it is cut once, before them
    panel = _daily(spark, sf).checkpoint(eager=True)
    return round_doubles(build_mart_outer(panel, tb.TESTBED_DAILY, time_col="day", roles=tb.DAILY_ROLES))


@_reg("spine_fill", f"SELECT k.DEPT_ID, k.harvest_year, CAST(coalesce(c.n_hot, 0) AS BIGINT) AS n_hot "
                    f"FROM (SELECT DISTINCT DEPT_ID, harvest_year FROM ({daily_panel_sql()}) p WHERE "
                    f"saison = 'floraison') k LEFT JOIN (SELECT DEPT_ID, harvest_year, count(*) AS "
                    f"n_hot FROM ({daily_panel_sql()}) p WHERE saison = 'floraison' AND t > 30 "
                    f"GROUP BY 1, 2) c ON k.DEPT_ID = c.DEPT_ID AND k.harvest_year = c.harvest_year")
def _q_spine_fill(spark, sf):
    flor = _daily(spark, sf).filter(F.col("saison") == "floraison")
    spine = flor.select("DEPT_ID", "harvest_year").distinct()
    counts = (flor.filter(F.col("t") > 30).groupBy("DEPT_ID", "harvest_year")
              .agg(F.count(F.lit(1)).alias("n_hot")))
    return spine_fill(spine, counts, ["DEPT_ID", "harvest_year"], ["n_hot"])


_MELT_COLS = ["DEPT_ID", "DEPT", "TYPE BLE", "STATUT_QUALITE", "ANNEE", "RENDEMENT"]


@_reg("melt_measure", _r(cs.melt_sql("REND_", "RENDEMENT"), ["RENDEMENT"], _MELT_COLS))
def _q_melt_measure(spark, sf):
    from harvestlens.operators.reshape import YIELD_ID_COLS
    w = filter_label_contains(tt.production_wide(spark, sf), "LIB_SAA", "blé tendre d'hiver")
    w = region_codes_from_label(w, "LIB_DEP").drop("LIB_REG2").withColumnRenamed("LIB_SAA", "TYPE BLE")
    return round_doubles(melt_measure(w, YIELD_ID_COLS, "REND_", "RENDEMENT"))


def _melt_join_sql():
    keys = ["DEPT_ID", "DEPT", '"TYPE BLE"', "STATUT_QUALITE", "ANNEE"]
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM p.{k}" for k in keys)
    return (f"SELECT s.*, p.PRODUCTION FROM ({cs.melt_sql('SURF_', 'SURFACE')}) s JOIN "
            f"({cs.melt_sql('PROD_', 'PRODUCTION')}) p ON {on}")


@_reg("melt_join", _r(_melt_join_sql(), ["SURFACE", "PRODUCTION"],
                      ["DEPT_ID", "DEPT", "TYPE BLE", "STATUT_QUALITE", "ANNEE", "SURFACE",
                       "PRODUCTION"]))
def _q_melt_join(spark, sf):
    from harvestlens.operators.reshape import YIELD_ID_COLS
    w = filter_label_contains(tt.production_wide(spark, sf), "LIB_SAA", "blé tendre d'hiver")
    w = region_codes_from_label(w, "LIB_DEP").drop("LIB_REG2").withColumnRenamed("LIB_SAA", "TYPE BLE")
    s = melt_measure(w, YIELD_ID_COLS, "SURF_", "SURFACE")
    p = melt_measure(w, YIELD_ID_COLS, "PROD_", "PRODUCTION")
    return round_doubles(null_safe_join(s, p, YIELD_ID_COLS + ["ANNEE"]))


@_reg("production_long", _r(cs.production_long_sql(), ["SURFACE", "PRODUCTION", "RENDEMENT"],
                            _LONG_COLS))
def _q_production_long(spark, sf):
    return round_doubles(_target(spark, sf, "string"))


# ------------------------------------------------------------------ 2.4 aggregations

_ANNUAL_MEAN = ["temp_air_c", "humidite_relative_pct", "rafale_max_ms"]
_ANNUAL_SUM = ["precipitations_1h_mm", "rayonnement_global_jcm2"]


def _annual_sql():
    aggs = [f"avg({c}) AS {c}" for c in _ANNUAL_MEAN]
    aggs += [f"coalesce(sum({c}), 0.0) AS {c}" for c in _ANNUAL_SUM]
    return (f"SELECT lpad(dept_id, 2, '0') AS DEPT_ID, CAST(year(day) AS INTEGER) AS ANNEE, "
            f"{', '.join(aggs)} FROM ({cs.station_daily_sql()}) d GROUP BY 1, 2")


@_reg("annual_weather", _r(_annual_sql(), _ANNUAL_MEAN + _ANNUAL_SUM,
                           ["DEPT_ID", "ANNEE"] + _ANNUAL_MEAN + _ANNUAL_SUM, 8))
def _q_annual_weather(spark, sf):
    # yearly means over 2^k days are exact at 7+ decimals: compared at 8 digits
    return round_doubles(annual_weather(_stations_daily(spark, sf), _ANNUAL_MEAN, _ANNUAL_SUM), 8)


@_reg("ndvi_annual", _r(cs.ndvi_annual_sql(), ["ndvi_poly_mean"],
                        ["DEPT_ID", "DEPT", "ANNEE", "ndvi_poly_mean"]))
def _q_ndvi_annual(spark, sf):
    return round_doubles(ndvi_annual(tt.ndvi_monthly(spark, sf)))


@_reg("group_quantile", _r(f"SELECT DEPT_ID, quantile_cont(r, 0.9) AS p90_r, quantile_cont(rad, 0.1) "
                           f"AS p10_rad, median(t) AS median_t FROM ({daily_panel_sql()}) p GROUP BY 1",
                           ["p90_r", "p10_rad", "median_t"], ["DEPT_ID", "p90_r", "p10_rad", "median_t"]))
def _q_group_quantile(spark, sf):
    return round_doubles(quantile_columns(_daily(spark, sf), ["DEPT_ID"], {
        "p90_r": ("r", 0.9), "p10_rad": ("rad", 0.1), "median_t": ("t", 0.5)}))


def _impute2_sql():
    p = daily_panel_sql()
    a = (f"SELECT *, coalesce(t, median(t) OVER (PARTITION BY DEPT_ID, harvest_year)) AS t1, "
         f"coalesce(hum, median(hum) OVER (PARTITION BY DEPT_ID, harvest_year)) AS h1 FROM ({p}) p")
    b = (f"SELECT DEPT_ID, day, coalesce(t1, median(t1) OVER (PARTITION BY DEPT_ID)) AS t, "
         f"coalesce(h1, median(h1) OVER (PARTITION BY DEPT_ID)) AS hum FROM ({a}) a")
    return b


@_reg("impute_two_level", _r(_impute2_sql(), ["t", "hum"], ["DEPT_ID", "day", "t", "hum"], 7))
def _q_impute_two_level(spark, sf):
    # medians of 6-decimal values have 7 exact decimals: compared at 7 digits
    df = _daily(spark, sf).select("DEPT_ID", "day", "harvest_year", "t", "hum")
    return round_doubles(impute_two_level(df, ["t", "hum"]).select("DEPT_ID", "day", "t", "hum"), 7)


def _impute3_sql():
    p = f"SELECT *, hour(datetime) AS heure FROM ({hourly_panel_sql()}) h"
    a = f"SELECT *, coalesce(t, median(t) OVER (PARTITION BY DEPT_ID, heure)) AS t1 FROM ({p}) p"
    b = f"SELECT *, coalesce(t1, median(t1) OVER (PARTITION BY DEPT_ID)) AS t2 FROM ({a}) a"
    c = (f"SELECT DEPT_ID, datetime, coalesce(t2, (SELECT median(t2) FROM ({b}) bb)) AS t "
         f"FROM ({b}) b")
    return c


@_reg("impute_three_level", _r(_impute3_sql(), ["t"], ["DEPT_ID", "datetime", "t"], 7))
def _q_impute_three_level(spark, sf):
    df = _hourly(spark, sf).select("DEPT_ID", "datetime", F.hour("datetime").alias("heure"), "t",
                                   "r", "g")
    out = impute_three_level(df, ["t", "r", "g"])
    return round_doubles(out.select("DEPT_ID", "datetime", "t"), 7)


_PANEL_COLS = ["DEPT_ID", "day", "t", "r", "g", "rad", "hum"]


@_reg("null_profile", "SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in _PANEL_COLS)
      + f" FROM ({daily_panel_sql()}) p")
def _q_null_profile(spark, sf):
    return null_profile(tb.daily_panel(spark, sf), _PANEL_COLS)


@_reg("key_coverage", f"SELECT count(*) AS n_groups FROM (SELECT DISTINCT DEPT_ID, harvest_year "
                      f"FROM ({hourly_panel_sql()}) h) k")
def _q_key_coverage(spark, sf):
    return (_hourly(spark, sf).select("DEPT_ID", "harvest_year").distinct()
            .agg(F.count(F.lit(1)).alias("n_groups")))


@_reg("rowwise_mean", _r(f"SELECT DEPT_ID, day, (coalesce(t, 0) + coalesce(r, 0) + coalesce(g, 0)) / "
                         f"NULLIF((CASE WHEN t IS NULL THEN 0 ELSE 1 END) + (CASE WHEN r IS NULL THEN 0 "
                         f"ELSE 1 END) + (CASE WHEN g IS NULL THEN 0 ELSE 1 END), 0) AS m "
                         f"FROM ({daily_panel_sql()}) p", ["m"], ["DEPT_ID", "day", "m"]))
def _q_rowwise_mean(spark, sf):
    p = tb.daily_panel(spark, sf)
    return round_doubles(p.select("DEPT_ID", "day", rowwise_mean(["t", "r", "g"]).alias("m")))


# ------------------------------------------------------------------ 2.5 windows

def _runs_sql():
    p = f"SELECT DEPT_ID, harvest_year, day, CASE WHEN t > 25 THEN 1 ELSE 0 END AS flag FROM ({daily_panel_sql()}) p WHERE saison = 'floraison'"
    a = (f"SELECT *, CASE WHEN flag IS DISTINCT FROM lag(flag) OVER (PARTITION BY DEPT_ID, harvest_year "
         f"ORDER BY day) THEN 1 ELSE 0 END AS chg FROM ({p}) p")
    b = (f"SELECT *, CAST(sum(chg) OVER (PARTITION BY DEPT_ID, harvest_year ORDER BY day ROWS BETWEEN "
         f"UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run_id FROM ({a}) a")
    return (f"SELECT DEPT_ID, harvest_year, day, flag, run_id, CAST(sum(flag) OVER (PARTITION BY DEPT_ID, "
            f"harvest_year, run_id) AS BIGINT) AS run_length FROM ({b}) b")


@_reg("run_id", _runs_sql())
def _q_run_id(spark, sf):
    flor = _daily(spark, sf).filter(F.col("saison") == "floraison").select(
        "DEPT_ID", "harvest_year", "day", (F.coalesce(F.col("t") > 25, F.lit(False))).cast("int")
        .alias("flag"))
    return run_ids(flor, ["DEPT_ID", "harvest_year"], "day", "flag")


@_reg("rolling_sum", _r(f"SELECT DEPT_ID, day, CASE WHEN count(r) OVER w = 10 THEN round(sum(r) OVER w, 4) "
                        f"END AS roll_r FROM ({daily_panel_sql()}) p WINDOW w AS (PARTITION BY DEPT_ID "
                        f"ORDER BY day ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)", ["roll_r"],
                        ["DEPT_ID", "day", "roll_r"]))
def _q_rolling_sum(spark, sf):
    p = tb.daily_panel(spark, sf).select("DEPT_ID", "day", "r")
    return round_doubles(rolling_sum(p, ["DEPT_ID"], "day", "r", 10, "roll_r", ndigits=4)
                         .select("DEPT_ID", "day", "roll_r"))


@_reg("run_id_blocks", SQL["run_id"])
def _q_run_id_blocks(spark, sf):
    """The same runs from blocks of a week."""
    flor = _daily(spark, sf).filter(F.col("saison") == "floraison").select(
        "DEPT_ID", "harvest_year", "day", (F.coalesce(F.col("t") > 25, F.lit(False))).cast("int").alias("flag"))
    return blocks.run_ids(flor, ["DEPT_ID", "harvest_year"], "day", "flag", 7 * blocks.DAY)


@_reg("rolling_sum_blocks", SQL["rolling_sum"])
def _q_rolling_sum_blocks(spark, sf):
    """The same sums from stretches of ranks, positions from blocks of 30 days."""
    p = tb.daily_panel(spark, sf).select("DEPT_ID", "day", "r")
    return round_doubles(blocks.rolling_sum(p, ["DEPT_ID"], "day", "r", 10, "roll_r", ndigits=4, stretch=256)
                         .select("DEPT_ID", "day", "roll_r"))


# ------------------------------------------------------------------ 2.6 sort / limit

@_reg("preview", _r(f"SELECT * FROM ({_training_sql()}) t ORDER BY DEPT_ID, harvest_year LIMIT 10",
                    TRAINING_DOUBLES, TRAINING_COLS))
def _q_preview(spark, sf):
    return round_doubles(_training(spark, sf).orderBy("DEPT_ID", "harvest_year").limit(10))


def _lag_sql():
    t = cs.clean_target_sql()
    return (f"SELECT a.DEPT_ID, a.ANNEE, a.RENDEMENT, b.RENDEMENT AS yield_pred FROM ({t}) a "
            f"LEFT JOIN ({t}) b ON a.DEPT_ID = b.DEPT_ID AND b.ANNEE = a.ANNEE - 1")


@_reg("baseline_lag1", _r(_lag_sql(), ["RENDEMENT", "yield_pred"],
                          ["DEPT_ID", "ANNEE", "RENDEMENT", "yield_pred"]))
def _q_baseline_lag1(spark, sf):
    t = clean_target(_target(spark, sf)).select("DEPT_ID", "ANNEE", "RENDEMENT")
    return round_doubles(ds.lag_baseline(t))


@_reg("score_lookup", _r(f"SELECT * FROM ({_lag_sql()}) s WHERE DEPT_ID = '05' AND ANNEE = 1998",
                         ["RENDEMENT", "yield_pred"], ["DEPT_ID", "ANNEE", "RENDEMENT", "yield_pred"]))
def _q_score_lookup(spark, sf):
    t = clean_target(_target(spark, sf)).select("DEPT_ID", "ANNEE", "RENDEMENT")
    return round_doubles(ds.score_lookup(ds.lag_baseline(t), "05", 1998))


# ------------------------------------------------------------------ 2.8 reshape

_SEQ_LEN = 31  # May 16 .. June 15: the whole stage


def _seq_sql():
    p = (f"SELECT DEPT_ID, harvest_year, day, r, g, row_number() OVER (PARTITION BY DEPT_ID, harvest_year "
         f"ORDER BY day) AS pos FROM ({daily_panel_sql()}) p WHERE saison = 'floraison'")
    return (f"SELECT DEPT_ID, harvest_year, list([r, g] ORDER BY pos) || "
            f"list_transform(range({_SEQ_LEN} - count(*)), lambda x: [0.0, 0.0]) AS seq, "
            f"CAST(count(*) AS INTEGER) AS n_steps FROM ({p}) p WHERE pos <= {_SEQ_LEN} GROUP BY 1, 2")


@_reg("sequence_pad", _seq_sql())
def _q_sequence_pad(spark, sf):
    flor = _daily(spark, sf).filter(F.col("saison") == "floraison")
    return sequences(flor, ["DEPT_ID", "harvest_year"], "day", ["r", "g"], _SEQ_LEN)


@_reg("seq_join", f"SELECT s.DEPT_ID, s.ANNEE, coalesce(q.n_steps, 0) AS n_steps, {_SEQ_LEN} AS seq_len "
                  f"FROM ({cs.static_sql()}) s LEFT JOIN ({_seq_sql()}) q ON s.DEPT_ID = q.DEPT_ID AND "
                  f"s.ANNEE = q.harvest_year")
def _q_seq_join(spark, sf):
    flor = _daily(spark, sf).filter(F.col("saison") == "floraison")
    seqs = sequences(flor, ["DEPT_ID", "harvest_year"], "day", ["r", "g"], _SEQ_LEN)
    pairs = _static(spark, sf).select("DEPT_ID", F.col("ANNEE").alias("harvest_year"))
    out = attach_sequences(pairs, seqs, ["DEPT_ID", "harvest_year"], _SEQ_LEN, 2)
    return out.select("DEPT_ID", F.col("harvest_year").alias("ANNEE"), "n_steps",
                      F.size("seq").alias("seq_len"))


@_reg("weather_daily_clean", None)
def _q_weather_daily_clean(spark, sf):
    daily = _stations_daily(spark, sf)
    return round_doubles(weather_daily_clean(daily, drop=[]))


def _wdc_sql():
    d = cs.station_daily_sql()
    cols = ["temp_air_c", "humidite_relative_pct", "rafale_max_ms", "precipitations_1h_mm",
            "rayonnement_global_jcm2"]
    base = (f"SELECT day, CAST(year(day) + CASE WHEN month(day) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS "
            f"harvest_year, CAST(hour(CAST(day AS TIMESTAMP)) AS INTEGER) AS heure, CAST(day(day) AS INTEGER) "
            f"AS jour, CAST(month(day) AS INTEGER) AS mois, CAST(year(day) AS INTEGER) AS annee, "
            f"{cs.season_case('day')} AS saison, lpad(dept_id, 2, '0') AS DEPT_ID, "
            + ", ".join(cols) + f" FROM ({d}) d")
    a = ("SELECT * EXCLUDE (" + ", ".join(cols) + "), " + ", ".join(
        f"coalesce({c}, median({c}) OVER (PARTITION BY DEPT_ID, harvest_year)) AS {c}" for c in cols)
        + f" FROM ({base}) b")
    b = ("SELECT * EXCLUDE (" + ", ".join(cols) + "), " + ", ".join(
        f"coalesce({c}, median({c}) OVER (PARTITION BY DEPT_ID)) AS {c}" for c in cols)
        + f" FROM ({a}) a")
    allc = ["day", "harvest_year", "heure", "jour", "mois", "annee", "saison", "DEPT_ID"] + cols
    return _r(b, cols, allc)


SQL["weather_daily_clean"] = _wdc_sql()


# ------------------------------------------------------------------ 2.10 soil features

_LOW = so.LOW_IMPORTANCE_FEATURES


def _sql_rowmean(cols: list[str]) -> str:
    num = " + ".join(f"coalesce({_q(c)}, 0)" for c in cols)
    den = " + ".join(f"(CASE WHEN {_q(c)} IS NULL THEN 0 ELSE 1 END)" for c in cols)
    return f"(({num}) / NULLIF({den}, 0))"


def _zone(var, zone, present):
    return [f"{var}_{d}_mean" for d in so.ZONES[zone] if f"{var}_{d}_mean" in present]


def _fe_sql(stage: str):
    """SQL of the soil feature chain up to ``stage``; returns (sql, cols, doubles)."""
    cols = list(TRAINING_COLS)
    doubles = set(TRAINING_DOUBLES)
    src = f"({_training_sql()})"
    cols = [c for c in cols if c not in _LOW]
    if stage == "drop_listed":
        return f"SELECT {_sel(cols)} FROM {src} t", cols, doubles
    exprs = {}
    for n, a, b in so.INTERACTIONS:
        exprs[n] = f"{_q(a)} * {_q(b)}"
    if stage == "soil_weather_products":
        out = cols + list(exprs)
        return (f"SELECT {_sel(cols)}, " + ", ".join(f"{e} AS {_q(n)}" for n, e in exprs.items())
                + f" FROM {src} t"), out, doubles | set(exprs)
    present = set(cols)
    layer = {}
    for var in so.SOIL_VARS:
        zs = {z: _zone(var, z, present) for z in so.ZONES}
        for z, cz in zs.items():
            if cz:
                layer[f"{var}_{z}_mean"] = _sql_rowmean(cz)
        if zs["surface"] and zs["deep"]:
            layer[f"{var}_gradient"] = f"({_sql_rowmean(zs['surface'])} - {_sql_rowmean(zs['deep'])})"
    if stage == "soil_layer_means":
        return (f"SELECT {_sel(cols)}, " + ", ".join(f"{e} AS {_q(n)}" for n, e in layer.items())
                + f" FROM {src} t"), cols + list(layer), doubles | set(layer)
    allx = {**exprs, **layer}
    inner = (f"SELECT {_sel(cols)}, " + ", ".join(f"{e} AS {_q(n)}" for n, e in allx.items())
             + f" FROM {src} t")
    cols2 = cols + list(allx)
    more = {}
    if "silt_surface_mean" in cols2 and "sand_surface_mean" in cols2:
        more["ratio_silt_sand_surface"] = "silt_surface_mean / (sand_surface_mean + 1e-6)"
        more["ratio_silt_sand_deep"] = "silt_deep_mean / (sand_deep_mean + 1e-6)"
    if stage == "soil_ratios":
        return (f"SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in more.items()) + f" FROM ({inner}) i",
                cols2 + list(more), doubles | set(allx) | set(more))
    water = {}
    for z in so.ZONES:
        if f"wv0033_{z}_mean" in cols2 and f"wv1500_{z}_mean" in cols2:
            water[f"AWC_{z}"] = f"wv0033_{z}_mean - wv1500_{z}_mean"
        if f"wv0033_{z}_mean" in cols2 and f"wv0010_{z}_mean" in cols2:
            water[f"retention_ratio_{z}"] = f"wv0033_{z}_mean / (wv0010_{z}_mean + 1e-6)"
    if stage == "soil_water":
        return (f"SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in water.items()) + f" FROM ({inner}) i",
                cols2 + list(water), doubles | set(allx) | set(water))
    mid = (f"SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in {**more, **water}.items())
           + f" FROM ({inner}) i")
    cols3 = cols2 + list(more) + list(water)
    stress = {}
    if {"floraison_cumul_pluie_10j_max", "remplissage_nb_jours_tx_gt_25"} <= set(cols3):
        stress["stress_floraison_chaleur_secheresse"] = (
            "remplissage_nb_jours_tx_gt_25 * (1.0 / (floraison_cumul_pluie_10j_max + 1e-6))")
    if {"remplissage_heatwave_length_max", "remplissage_max_consecutive_dry_days"} <= set(cols3):
        stress["stress_remplissage_combine"] = (
            "CAST(remplissage_heatwave_length_max * remplissage_max_consecutive_dry_days AS BIGINT)")
    if "hiver_anormalement_chaud" in cols3 and "AWC_deep" in cols3:
        stress["stress_vernal_x_AWC"] = "hiver_anormalement_chaud * AWC_deep"
    dbl = doubles | set(allx) | set(more) | set(water) | {
        "stress_floraison_chaleur_secheresse", "stress_vernal_x_AWC"}
    if stage == "stress_indices":
        return (f"SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in stress.items()) + f" FROM ({mid}) m",
                cols3 + list(stress), dbl)
    final = {}
    for var in so.SOIL_VARS:
        s, m, d = (_zone(var, z, present) for z in ("surface", "medium", "deep"))
        if m and d:
            final[f"{var}_gradient_mid_deep"] = f"({_sql_rowmean(m)} - {_sql_rowmean(d)})"
    full = (f"SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in {**stress, **final}.items())
            + f" FROM ({mid}) m")
    keep = [c for c in cols3 + list(stress) + list(final)
            if not any(c.endswith(sfx) for sfx in so.DEPTH_SUFFIXES)]
    return f"SELECT {_sel(keep)} FROM ({full}) f", keep, dbl | set(final)


def _fe_reg(key: str, fn):
    sql, cols, dbl = _fe_sql(key)
    SQL[key] = _r(sql, [c for c in cols if c in dbl], cols)
    Q[key] = fn


_fe_reg("drop_listed", lambda spark, sf: round_doubles(so.drop_listed(_training(spark, sf))))
_fe_reg("soil_weather_products", lambda spark, sf: round_doubles(
    so.soil_weather_products(so.drop_listed(_training(spark, sf)))))
_fe_reg("soil_layer_means", lambda spark, sf: round_doubles(
    so.soil_layer_means(so.drop_listed(_training(spark, sf)))))


def _chain(upto):
    def run(spark, sf):
        df = so.drop_listed(_training(spark, sf))
        df = so.soil_layer_means(so.soil_weather_products(df))
        for step in (so.soil_ratios, so.soil_water, so.stress_indices):
            df = step(df)
            if step.__name__ == upto:
                return round_doubles(df)
        return round_doubles(so.soil_final(df))
    return run


def _chain_ratios(spark, sf):
    df = so.soil_layer_means(so.soil_weather_products(so.drop_listed(_training(spark, sf))))
    return round_doubles(so.soil_ratios(df))


def _chain_water(spark, sf):
    df = so.soil_layer_means(so.soil_weather_products(so.drop_listed(_training(spark, sf))))
    return round_doubles(so.soil_water(df))


_fe_reg("soil_ratios", _chain_ratios)
_fe_reg("soil_water", _chain_water)
_fe_reg("stress_indices", _chain("stress_indices"))
_fe_reg("soil_final", _chain("soil_final"))
Q["feature_engineering"] = lambda spark, sf: round_doubles(so.feature_engineering(_training(spark, sf)))
SQL["feature_engineering"] = SQL["soil_final"]


# ------------------------------------------------------------------ 2.11 splits, scaling, metrics

@_reg("split_random", "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', "
                      "CAST(o_orderkey AS VARCHAR), '42'))) <= ceil(0.2 * count(*) OVER ()) THEN 'test' "
                      "ELSE 'train' END AS split FROM orders")
def _q_split_random(spark, sf):
    o = tb.read(spark, sf, "orders").select("o_orderkey")
    return ds.random_split(o, ["o_orderkey"], 0.2, 42)


@_reg("split_temporal", f"SELECT DEPT_ID, harvest_year, CASE WHEN harvest_year <= 1997 THEN 'train' "
                        f"WHEN harvest_year IN (1998, 1999) THEN 'val' WHEN harvest_year >= 2000 THEN "
                        f"'test' END AS split FROM ({_training_sql()}) t")
def _q_split_temporal(spark, sf):
    return _training(spark, sf).select("DEPT_ID", "harvest_year", ds.temporal_labels(
        "harvest_year", 1997, (1998, 1999), 2000).alias("split"))


@_reg("split_by_year", f"SELECT DEPT_ID, ANNEE, CASE WHEN ANNEE <= 1998 THEN 'train' WHEN ANNEE >= 1999 "
                       f"THEN 'test' END AS split FROM ({cs.clean_target_sql()}) t")
def _q_split_by_year(spark, sf):
    split = ds.TemporalSplit(train_max_year=1998, test_min_year=1999)
    t = clean_target(_target(spark, sf))
    return t.select("DEPT_ID", "ANNEE", split.label("ANNEE").alias("split"))


_SCALE_COLS = ["ndvi_poly_mean", "silt_0-5cm_mean", "floraison_cumul_pluie_10j_max"]


def _scaled_sql(kind: str) -> str:
    t = _training_sql()
    if kind == "minmax":
        stats = ", ".join(f"min({_q(c)}) AS mn{i}, max({_q(c)}) AS mx{i}" for i, c in enumerate(_SCALE_COLS))
        exprs = ", ".join(f"({_q(c)} - mn{i}) / (CASE WHEN mx{i} - mn{i} = 0 THEN 1.0 ELSE mx{i} - mn{i} END) "
                          f"AS {_q(c)}" for i, c in enumerate(_SCALE_COLS))
    elif kind == "robust":
        stats = ", ".join(f"quantile_cont({_q(c)}, 0.5) AS md{i}, quantile_cont({_q(c)}, 0.25) AS q1{i}, "
                          f"quantile_cont({_q(c)}, 0.75) AS q3{i}" for i, c in enumerate(_SCALE_COLS))
        exprs = ", ".join(f"({_q(c)} - md{i}) / (CASE WHEN q3{i} - q1{i} = 0 THEN 1.0 ELSE q3{i} - q1{i} END) "
                          f"AS {_q(c)}" for i, c in enumerate(_SCALE_COLS))
    else:
        stats = ", ".join(f"CASE WHEN count_if({_q(c)} IS NULL) > 0 THEN NULL ELSE avg({_q(c)}) END AS mu{i}, "
                          f"CASE WHEN count_if({_q(c)} IS NULL) > 0 THEN NULL WHEN stddev_pop({_q(c)}) = 0 "
                          f"THEN 1.0 ELSE stddev_pop({_q(c)}) END AS sd{i}" for i, c in enumerate(_SCALE_COLS))
        exprs = ", ".join(f"({_q(c)} - mu{i}) / sd{i} AS {_q(c)}" for i, c in enumerate(_SCALE_COLS))
    return (f"SELECT t.DEPT_ID, t.harvest_year, {exprs} FROM ({t}) t, (SELECT {stats} FROM ({t}) x "
            f"WHERE harvest_year <= 1998) st")


def _scaled(kind):
    def run(spark, sf):
        # read to fit and to apply: written once
        mart = stored(_training(spark, sf).select("DEPT_ID", "harvest_year", *_SCALE_COLS), "mart")
        train = mart.filter(F.col("harvest_year") <= 1998)
        if kind == "minmax":
            out = ds.apply_minmax(mart, ds.fit_minmax(train, _SCALE_COLS), _SCALE_COLS)
        elif kind == "robust":
            out = ds.apply_robust(mart, ds.fit_robust(train, _SCALE_COLS), _SCALE_COLS)
        else:
            out = ds.apply_zscore(mart, ds.fit_zscore(train, _SCALE_COLS), _SCALE_COLS)
        return round_doubles(out)
    return run


for _k, _kind in (("scale_minmax", "minmax"), ("scale_robust", "robust"), ("zscore_static", "z")):
    Q[_k] = _scaled(_kind)
    SQL[_k] = _r(_scaled_sql(_kind), _SCALE_COLS, ["DEPT_ID", "harvest_year"] + _SCALE_COLS)


def _zseq_sql():
    p = (f"SELECT DEPT_ID, harvest_year, r, g, row_number() OVER (PARTITION BY DEPT_ID, harvest_year "
         f"ORDER BY day) AS pos FROM ({daily_panel_sql()}) p WHERE saison = 'floraison'")
    pairs = "(SELECT count(*) FROM (SELECT DISTINCT DEPT_ID, harvest_year FROM (" + p + ") q WHERE harvest_year <= 1998) pp)"
    tot = f"(CAST({pairs} AS DOUBLE) * {_SEQ_LEN})"
    rows = f"SELECT * FROM ({p}) p WHERE pos <= {_SEQ_LEN} AND harvest_year <= 1998"
    sel = []
    for c in ("r", "g"):
        mu = f"(coalesce(sum({c}), 0) / {tot})"
        var = f"(coalesce(sum({c} * {c}), 0) / {tot} - {mu} * {mu})"
        sd = f"sqrt(greatest({var}, 0))"
        sel += [f"{mu} AS {c}_mean", f"CASE WHEN {sd} = 0 THEN 1.0 ELSE {sd} END AS {c}_std"]
    return f"SELECT {', '.join(sel)} FROM ({rows}) r"


@_reg("zscore_sequence", _r(_zseq_sql(), ["r_mean", "r_std", "g_mean", "g_std"],
                            ["r_mean", "r_std", "g_mean", "g_std"]))
def _q_zscore_sequence(spark, sf):
    from pyspark.sql import Window
    flor = _daily(spark, sf).filter(F.col("saison") == "floraison")
    w = Window.partitionBy("DEPT_ID", "harvest_year").orderBy("day")
    rows = (flor.withColumn("__pos", F.row_number().over(w))
            .filter((F.col("__pos") <= _SEQ_LEN) & (F.col("harvest_year") <= 1998)))
    pairs = flor.filter(F.col("harvest_year") <= 1998).select("DEPT_ID", "harvest_year").distinct()
    return round_doubles(ds.padded_moments(rows, ["r", "g"], pairs, _SEQ_LEN))


@_reg("metrics", _r(f"SELECT count(*) AS n, avg(abs(RENDEMENT - yield_pred)) AS mae, "
                    f"avg((RENDEMENT - yield_pred) * (RENDEMENT - yield_pred)) AS mse, "
                    f"sqrt(avg((RENDEMENT - yield_pred) * (RENDEMENT - yield_pred))) AS rmse, "
                    f"1 - sum((RENDEMENT - yield_pred) * (RENDEMENT - yield_pred)) / "
                    f"(sum(RENDEMENT * RENDEMENT) - count(*) * avg(RENDEMENT) * avg(RENDEMENT)) AS r2 "
                    f"FROM ({_lag_sql()}) s WHERE RENDEMENT IS NOT NULL AND yield_pred IS NOT NULL",
                    ["mae", "mse", "rmse", "r2"], ["n", "mae", "mse", "rmse", "r2"], 4))
def _q_metrics(spark, sf):
    t = clean_target(_target(spark, sf)).select("DEPT_ID", "ANNEE", "RENDEMENT")
    return round_doubles(ds.regression_metrics(ds.lag_baseline(t), "RENDEMENT", "yield_pred"), 4)


@_reg("score_holdout", _r(f"SELECT DEPT_ID, ANNEE, RENDEMENT, yield_pred FROM ({_lag_sql()}) s "
                          f"WHERE ANNEE = 2001", ["RENDEMENT", "yield_pred"],
                          ["DEPT_ID", "ANNEE", "RENDEMENT", "yield_pred"]))
def _q_score_holdout(spark, sf):
    t = clean_target(_target(spark, sf)).select("DEPT_ID", "ANNEE", "RENDEMENT")
    _, hold = holdout_split(ds.lag_baseline(t), "ANNEE", 2001)
    return round_doubles(hold)


# ------------------------------------------------------------------ training marts

def _annual_mart_sql():
    return (f"SELECT s.*, w.* EXCLUDE (DEPT_ID, ANNEE) FROM ({cs.static_sql()}) s JOIN ({_annual_sql()}) w "
            f"ON s.DEPT_ID = w.DEPT_ID AND s.ANNEE = w.ANNEE")


@_reg("training_mart_annual", _r(_annual_mart_sql(), STATIC_DOUBLES + _ANNUAL_MEAN + _ANNUAL_SUM,
                                 STATIC_COLS + _ANNUAL_MEAN + _ANNUAL_SUM, 8))
def _q_training_mart_annual(spark, sf):
    weather = annual_weather(_stations_daily(spark, sf), _ANNUAL_MEAN, _ANNUAL_SUM)
    return round_doubles(training_mart_annual(_target(spark, sf), tt.soil_layers(spark, sf),
                                              tt.ndvi_monthly(spark, sf), weather), 8)


_HOURLY_NAMES = [f.name for f in tb.TESTBED_HOURLY]
_HOURLY_DOUBLES = [f.name for f in tb.TESTBED_HOURLY
                   if f.kind in ("excess", "roll_max")
                   or (f.kind in ("count", "joint_count", "run_max") and f.unit != 1.0)]


def _hourly_training_sql():
    mart = FeatureSQL(hourly_panel_sql(), tb.HOURLY_ROLES, "datetime").mart(tb.TESTBED_HOURLY)
    agro = (f"SELECT * FROM (SELECT * REPLACE (harvest_year - 27 AS harvest_year) FROM ({mart}) a) b "
            f"WHERE DEPT_ID NOT IN ('03', '04') AND harvest_year > 1995 AND harvest_year <= 1998 "
            f"AND NOT (DEPT_ID = '05' AND harvest_year = 1997)")
    static = (f"SELECT * FROM ({cs.static_sql()}) s WHERE DEPT_ID NOT IN ('03', '04') "
              f"AND ANNEE > 1995")
    return (f"SELECT s.*, m.* EXCLUDE (DEPT_ID, harvest_year) FROM ({static}) s JOIN ({agro}) m "
            f"ON s.DEPT_ID = m.DEPT_ID AND s.ANNEE = m.harvest_year")


@_reg("training_mart_hourly", _r(_hourly_training_sql(), STATIC_DOUBLES + _HOURLY_DOUBLES,
                                 STATIC_COLS + _HOURLY_NAMES, 7))
def _q_training_mart_hourly(spark, sf):
    return round_doubles(hourly_training_mart(spark, sf), 7)


def hourly_training_mart(spark, sf):
    from harvestlens.plans.training import agro_mart_hourly
    # the hourly panel spans harvest years 2023-2025; they stand for the
    # target's 1996-1998 (shift 27) and are filtered on the panel's own years
    shift = 2023 - 1996
    agro = agro_mart_hourly(_hourly(spark, sf), tb.TESTBED_HOURLY, ["03", "04"],
                            1995 + shift, 1998 + shift, roles=tb.HOURLY_ROLES)
    agro = agro.withColumn("harvest_year", F.col("harvest_year") - F.lit(shift))
    return training_static_hourly(_target(spark, sf), tt.soil_layers(spark, sf),
                                  tt.ndvi_monthly(spark, sf), agro, excluded=["03", "04"],
                                  min_year_exclusive=1995, max_year=1998, pairs=[("05", 1997)])


@_reg("sequence_dataset", None)
def _q_sequence_dataset(spark, sf):
    """Hourly sequence dataset (rows-only: nested normalised arrays); its
    steps are checked one by one by impute_three_level, cyclic_encode,
    sequence_pad, seq_join, zscore_sequence and zscore_static."""
    from harvestlens.plans.sequences import sequence_dataset
    shift = 2023 - 1996
    static = _static(spark, sf).select(
        "DEPT_ID", (F.col("ANNEE") + F.lit(shift)).alias("harvest_year"),
        "RENDEMENT", "ndvi_poly_mean", F.col("`silt_0-5cm_mean`").alias("silt_surface"))
    data, _ = sequence_dataset(_hourly(spark, sf), static, ["ndvi_poly_mean", "silt_surface"],
                               target="RENDEMENT", excluded=["03", "04"], min_year_exclusive=2022,
                               max_year=2025, pairs_dropped=[("05", 2024)], train_max=2023,
                               val_years=(2024,), test_min=2025)
    return data.select("DEPT_ID", "harvest_year", "split", "RENDEMENT", "n_steps", F.size("seq").alias("steps"),
                       "ndvi_poly_mean", "silt_surface", "seq")


def register(q: dict, sql: dict) -> None:
    q.update(Q)
    sql.update({k: v for k, v in SQL.items() if v is not None})
