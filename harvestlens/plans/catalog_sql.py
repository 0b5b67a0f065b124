"""DuckDB SQL for the non-kernel registered queries (oracle side only)."""

from __future__ import annotations

from harvestlens.operators.soil import DEPTHS, SOIL_VARS
from harvestlens.plans.sql_oracle import SEASON_SQL, harvest_year_sql
from harvestlens.plans.testbed_tables import YEARS

CROP_LIKE = "%blé tendre d''hiver%"


def wide_sql() -> str:
    cols = []
    for y in YEARS:
        iy = f"year(l.l_shipdate) = {y}"
        cols.append(f"CASE WHEN count(CASE WHEN {iy} THEN 1 END) > 0 THEN "
                    f"CAST(count(CASE WHEN {iy} THEN 1 END) AS DOUBLE) END AS SURF_{y}")
        cols.append(f"sum(CASE WHEN {iy} THEN l.l_quantity END) AS PROD_{y}")
        cols.append(f"round(sum(CASE WHEN {iy} THEN l.l_discount * 10.0 END), 4) AS REND_{y}")
    return f"""SELECT 'R' || CAST(n.n_regionkey AS VARCHAR) AS LIB_REG2,
  (CASE WHEN n.n_nationkey >= 22 THEN '9' ELSE '0' END)
   || (CASE WHEN n.n_nationkey = 20 THEN '2A' WHEN n.n_nationkey = 21 THEN '2B'
            ELSE lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') END)
   || ' - ' || n.n_name AS LIB_DEP,
  CASE WHEN l.l_returnflag = 'N' THEN 'Blé tendre d''hiver et épeautre'
       WHEN l.l_returnflag = 'A' THEN 'Blé dur d''hiver'
       ELSE 'Orge d''hiver et escourgeon' END AS LIB_SAA,
  CASE WHEN n.n_regionkey = 4 THEN NULL WHEN n.n_regionkey % 2 = 0 THEN 'Définitif'
       ELSE 'Provisoire' END AS STATUT_QUALITE,
  {", ".join(cols)}
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY 1, 2, 3, 4"""


def crop_rows_sql() -> str:
    """Filtered, coded wide rows (before melting)."""
    return f"""SELECT substr(regexp_replace(LIB_DEP, '^0', ''), 1, 2) AS DEPT_ID,
  substr(regexp_replace(LIB_DEP, '^0', ''), 5) AS DEPT,
  lower(LIB_SAA) AS "TYPE BLE", STATUT_QUALITE, * EXCLUDE (LIB_REG2, LIB_DEP, LIB_SAA, STATUT_QUALITE)
FROM ({wide_sql()}) w
WHERE lower(LIB_SAA) LIKE '{CROP_LIKE}' AND LIB_DEP LIKE '0%'"""


def melt_sql(prefix: str, value: str) -> str:
    cols = ", ".join(f"{prefix}{y}" for y in YEARS)
    return f"""SELECT DEPT_ID, DEPT, "TYPE BLE", STATUT_QUALITE,
  replace(ANNEE, '{prefix}', '') AS ANNEE, {value}
FROM (SELECT DEPT_ID, DEPT, "TYPE BLE", STATUT_QUALITE, {cols} FROM ({crop_rows_sql()}) c)
UNPIVOT INCLUDE NULLS ({value} FOR ANNEE IN ({cols}))"""


def production_long_sql(year_int: bool = False) -> str:
    keys = ["DEPT_ID", "DEPT", '"TYPE BLE"', "STATUT_QUALITE", "ANNEE"]

    def on(a, b):
        return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)
    year = "CAST(s.ANNEE AS INTEGER)" if year_int else "s.ANNEE"
    return f"""SELECT s.DEPT_ID, s.DEPT, s."TYPE BLE", s.STATUT_QUALITE, {year} AS ANNEE,
  s.SURFACE, p.PRODUCTION, r.RENDEMENT
FROM ({melt_sql('SURF_', 'SURFACE')}) s
JOIN ({melt_sql('PROD_', 'PRODUCTION')}) p ON {on('s', 'p')}
JOIN ({melt_sql('REND_', 'RENDEMENT')}) r ON {on('s', 'r')}"""


def clean_target_sql() -> str:
    return f"""SELECT DEPT_ID, DEPT, STATUT_QUALITE, ANNEE, RENDEMENT
FROM ({production_long_sql(True)}) t
WHERE RENDEMENT IS NOT NULL AND (DEPT_ID IS NULL OR DEPT_ID NOT IN ('2A', '2B'))"""


SOIL_EXPR_SQL = {
    "silt": "l.l_quantity / 1000.0",
    "sand": "l.l_discount * 10.0",
    "clay": "l.l_tax * 10.0",
    "wv0033": "l.l_quantity / 100.0",
    "wv0010": "l.l_quantity / 50.0",
    "wv1500": "l.l_tax * 100.0",
    "cfvo": "l.l_discount * 100.0",
    "ocd": "l.l_tax + l.l_discount",
    "soc": "(l.l_partkey % 100) / 100.0",
    "nitrogen": "(l.l_suppkey % 50) / 10.0",
    "cec": "(l.l_orderkey % 30) / 10.0",
    "phh2o": "CAST(l.l_quantity AS DOUBLE) - 7 * floor(l.l_quantity / 7)",
    "bdod": "CAST(l.l_quantity AS DOUBLE) - 11 * floor(l.l_quantity / 11)",
}


def soil_sql() -> str:
    cols = []
    for var in SOIL_VARS:
        for k, depth in enumerate(DEPTHS, start=1):
            cols.append(f'round(sum(CASE WHEN (l.l_linenumber - 1) % 6 + 1 = {k} THEN {SOIL_EXPR_SQL[var]} END), 4) '
                        f'AS "{var}_{depth}_mean"')
    return f"""SELECT lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS DEPT_ID, n.n_name AS dept_nom,
  {", ".join(cols)}
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY 1, 2"""


def ndvi_monthly_sql() -> str:
    return """SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS DEPT_ID,
  n.n_name AS department_name, CAST(year(o.o_orderdate) AS INTEGER) AS year,
  CAST(month(o.o_orderdate) AS INTEGER) AS month,
  round(avg(o.o_totalprice) / 1000.0, 2) AS ndvi_poly_mean
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2, 3, 4"""


def ndvi_annual_sql() -> str:
    return f"""SELECT DEPT_ID, department_name AS DEPT, year AS ANNEE,
  avg(ndvi_poly_mean) AS ndvi_poly_mean
FROM ({ndvi_monthly_sql()}) m GROUP BY 1, 2, 3"""


def static_sql() -> str:
    """clean target x soil (dept_nom dropped) x yearly NDVI (DEPT_x / DEPT_y)."""
    return f"""SELECT t.DEPT_ID, t.DEPT AS DEPT_x, t.STATUT_QUALITE, t.ANNEE, t.RENDEMENT,
  s.* EXCLUDE (DEPT_ID, dept_nom), v.DEPT AS DEPT_y, v.ndvi_poly_mean
FROM ({clean_target_sql()}) t
JOIN ({soil_sql()}) s ON t.DEPT_ID = s.DEPT_ID
JOIN ({ndvi_annual_sql()}) v ON t.DEPT_ID = v.DEPT_ID AND t.ANNEE = v.ANNEE"""


def station_sql() -> str:
    return """SELECT lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS region,
  s.s_suppkey AS NUM_POSTE, round(s.s_acctbal / 200.0, 4) AS LAT,
  round(s.s_acctbal / 400.0, 4) AS LON, s.s_nationkey * 10.0 AS ALTI,
  strftime(l.l_shipdate, '%Y%m%d') || lpad(CAST(l.l_linenumber * 3 AS VARCHAR), 2, '0') AS AAAAMMJJHH,
  CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE l.l_quantity END AS T,
  l.l_tax * 100.0 AS RR1, l.l_discount * 200.0 AS FXI, l.l_quantity * 2.0 AS U,
  round(l.l_extendedprice / 1000.0, 1) AS GLO, l.l_orderkey AS Q_EXTRA
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey"""


STATION_MEASURES = [("ALTI", "altitude_m"), ("T", "temp_air_c"), ("RR1", "precipitations_1h_mm"),
                    ("FXI", "rafale_max_ms"), ("U", "humidite_relative_pct"),
                    ("GLO", "rayonnement_global_jcm2")]


def station_hourly_sql() -> str:
    aggs = ", ".join(f"avg({raw}) AS {name}" for raw, name in STATION_MEASURES)
    return f"""SELECT region AS dept_id, strptime(AAAAMMJJHH, '%Y%m%d%H') AS datetime, {aggs}
FROM ({station_sql()}) r GROUP BY 1, 2"""


def station_daily_sql() -> str:
    return f"""SELECT dept_id, CAST(datetime AS DATE) AS day,
  avg(temp_air_c) AS temp_air_c, avg(humidite_relative_pct) AS humidite_relative_pct,
  avg(rafale_max_ms) AS rafale_max_ms,
  coalesce(sum(precipitations_1h_mm), 0.0) AS precipitations_1h_mm,
  coalesce(sum(rayonnement_global_jcm2), 0.0) AS rayonnement_global_jcm2
FROM ({station_hourly_sql()}) h GROUP BY 1, 2"""


def season_case(t: str) -> str:
    return SEASON_SQL.format(t=t)


__all__ = ["wide_sql", "production_long_sql", "clean_target_sql", "soil_sql", "ndvi_monthly_sql",
           "ndvi_annual_sql", "static_sql", "station_sql", "station_hourly_sql",
           "station_daily_sql", "harvest_year_sql", "season_case", "melt_sql", "crop_rows_sql"]
