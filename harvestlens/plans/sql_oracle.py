"""DuckDB SQL cross-checks for the indicator queries.

The SQL follows the step-by-step shape of the original computation (stage
filter, change flag + running sum as run id, run length per run, one
subquery per indicator, outer merge on the keys). It shares nothing with the
Spark plan except the parameter rows, so agreement is a real check.
"""

from __future__ import annotations

from harvestlens.operators.features import Feature, Quantile
from harvestlens.plans.testbed import STAGE_SHIFTS, YEAR_SHIFTS

SEASON_SQL = """CASE
      WHEN month({t}) IN (9, 10, 11) THEN 'semis'
      WHEN month({t}) IN (12, 1, 2) THEN 'vernalisation'
      WHEN month({t}) = 3 OR (month({t}) = 4 AND day({t}) <= 15) THEN 'tallage'
      WHEN (month({t}) = 4 AND day({t}) > 15) OR (month({t}) = 5 AND day({t}) <= 15) THEN 'montaison'
      WHEN (month({t}) = 5 AND day({t}) > 15) OR (month({t}) = 6 AND day({t}) <= 15) THEN 'floraison'
      WHEN (month({t}) = 6 AND day({t}) > 15) OR month({t}) IN (7, 8) THEN 'remplissage'
    END"""


def harvest_year_sql(t: str) -> str:
    return f"CAST(year({t}) + CASE WHEN month({t}) >= 9 THEN 1 ELSE 0 END AS INTEGER)"


DAILY_BASE_SQL = """SELECT lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS DEPT_ID,
       CAST(l.l_shipdate AS DATE) AS day,
       round(avg(CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE l.l_quantity END), 6) AS t,
       round(sum(l.l_tax) * 100.0, 4) AS r,
       round(max(l.l_discount) * 200.0, 4) AS g,
       round(sum(l.l_extendedprice), 2) AS rad
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY 1, 2"""


def daily_panel_sql() -> str:
    return (f"SELECT DEPT_ID, day, t, r, g, rad, round(2.0 * t, 6) AS hum, "
            f"{harvest_year_sql('day')} AS harvest_year, {SEASON_SQL.format(t='day')} AS saison "
            f"FROM ({DAILY_BASE_SQL}) d")


HOURLY_BASE_SQL = """SELECT lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') AS DEPT_ID,
       date_trunc('hour', ts) AS datetime,
       round(avg(CASE WHEN event_type = 'error' THEN NULL ELSE value END), 3) AS t,
       round(sum(value), 4) AS r,
       round(max(value), 4) AS g
FROM events GROUP BY 1, 2"""


def hourly_panel_sql() -> str:
    rows = ", ".join(f"({s + y}, {f})" for s in STAGE_SHIFTS for (y, f) in YEAR_SHIFTS)
    shifted = (f"SELECT b.DEPT_ID, b.datetime + to_days(CAST(k.d AS INTEGER)) AS datetime, "
               f"round(b.t * k.f, 4) AS t, round(b.r * k.f, 5) AS r, round(b.g * k.f, 5) AS g "
               f"FROM ({HOURLY_BASE_SQL}) b, (VALUES {rows}) AS k(d, f)")
    return (f"SELECT DEPT_ID, datetime, t, r, g, {harvest_year_sql('datetime')} AS harvest_year, "
            f"{SEASON_SQL.format(t='datetime')} AS saison FROM ({shifted}) h")


class FeatureSQL:
    """Builds one subquery (DEPT_ID, harvest_year, <name>) per indicator."""

    def __init__(self, panel_sql: str, roles: dict, time_col: str):
        self.panel, self.roles, self.t = panel_sql, roles, time_col

    def col(self, role: str) -> str:
        return self.roles.get(role, role)

    def stage_rows(self, f: Feature) -> str:
        """Stage rows with quantile thresholds as extra columns thr0, thr1..."""
        extra = []
        for i, term in enumerate(f.terms):
            if isinstance(term.threshold, Quantile):
                part = ("DEPT_ID" if term.threshold.scope == "region"
                        else "DEPT_ID, harvest_year")
                extra.append(f"quantile_cont({self.col(term.role)}, {term.threshold.q}) "
                             f"OVER (PARTITION BY {part}) AS thr{i}")
        sel = ", ".join(["*"] + extra)
        return f"(SELECT {sel} FROM ({self.panel}) p WHERE saison = '{f.stage}')"

    def cond(self, f: Feature) -> str:
        parts = []
        for i, term in enumerate(f.terms):
            rhs = f"thr{i}" if isinstance(term.threshold, Quantile) else repr(float(term.threshold))
            parts.append(f"{self.col(term.role)} {term.op} {rhs}")
        return " AND ".join(parts)

    def flag(self, f: Feature) -> str:
        return f"CASE WHEN {self.cond(f)} THEN 1 ELSE 0 END"

    def _div(self, expr: str, f: Feature, int_type: str = "BIGINT") -> str:
        if f.unit == 1.0:
            return f"CAST({expr} AS {int_type})"
        return f"CAST({expr} AS DOUBLE) / {float(f.unit)}"

    def rolling(self, f: Feature, partition: str) -> str:
        x = self.col(f.value)
        w = (f"(PARTITION BY {partition} ORDER BY {self.t} "
             f"ROWS BETWEEN {f.window - 1} PRECEDING AND CURRENT ROW)")
        s = f"sum({x}) OVER {w}"
        if f.ndigits is not None:
            s = f"round({s}, {f.ndigits})"
        return (f"SELECT DEPT_ID, harvest_year, CASE WHEN count({x}) OVER {w} = {f.window} "
                f"THEN {s} END AS roll FROM ({self.panel}) p WHERE saison = '{f.stage}'")

    def runs(self, f: Feature) -> str:
        """Rows with flag and run_length (length of the flagged run they are in)."""
        key = "DEPT_ID, harvest_year"
        flagged = f"SELECT DEPT_ID, harvest_year, {self.t}, {self.flag(f)} AS flag FROM {self.stage_rows(f)} s"
        change = (f"SELECT *, CASE WHEN flag IS DISTINCT FROM lag(flag) OVER "
                  f"(PARTITION BY {key} ORDER BY {self.t}) THEN 1 ELSE 0 END AS chg FROM ({flagged}) a")
        run_id = (f"SELECT *, sum(chg) OVER (PARTITION BY {key} ORDER BY {self.t} "
                  f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id FROM ({change}) b")
        return (f"SELECT *, sum(flag) OVER (PARTITION BY {key}, run_id) AS run_length "
                f"FROM ({run_id}) c")

    def sql(self, f: Feature) -> str:
        n, k = f.name, f.kind
        if k in ("count", "joint_count"):
            return (f"SELECT DEPT_ID, harvest_year, {self._div(f'sum({self.flag(f)})', f)} AS {n} "
                    f"FROM {self.stage_rows(f)} s GROUP BY 1, 2")
        if k == "low_count":
            days = f"sum({self.flag(f)})" + ("" if f.unit == 1.0 else f" / {float(f.unit)}")
            return (f"SELECT DEPT_ID, harvest_year, CAST(CASE WHEN {days} < {float(f.limit)} "
                    f"THEN 1 ELSE 0 END AS INTEGER) AS {n} FROM {self.stage_rows(f)} s GROUP BY 1, 2")
        if k == "excess":
            x, b = self.col(f.value), float(f.base)
            per_row = f"({x} - {b})" + ("" if f.unit == 1.0 else f" / {float(f.unit)}")
            return (f"SELECT DEPT_ID, harvest_year, CAST(sum(CASE WHEN {x} > {b} THEN {per_row} "
                    f"ELSE 0 END) AS DOUBLE) AS {n} FROM {self.stage_rows(f)} s GROUP BY 1, 2")
        if k == "roll_max":
            return (f"SELECT DEPT_ID, harvest_year, max(roll) AS {n} FROM "
                    f"({self.rolling(f, 'DEPT_ID, harvest_year')}) r WHERE roll IS NOT NULL GROUP BY 1, 2")
        if k == "roll_exceed":
            thr = (f"SELECT *, quantile_cont(roll, {f.q}) OVER (PARTITION BY DEPT_ID) AS thr FROM "
                   f"({self.rolling(f, 'DEPT_ID')}) r WHERE roll IS NOT NULL")
            return (f"SELECT DEPT_ID, harvest_year, CAST(sum(CASE WHEN roll > thr THEN 1 ELSE 0 END) "
                    f"AS BIGINT) AS {n} FROM ({thr}) q GROUP BY 1, 2")
        if k == "run_max":
            return (f"SELECT DEPT_ID, harvest_year, {self._div('max(run_length)', f)} AS {n} "
                    f"FROM ({self.runs(f)}) r GROUP BY 1, 2")
        if k == "run_rows":
            return (f"SELECT DEPT_ID, harvest_year, CAST(sum(CASE WHEN flag = 1 AND run_length >= "
                    f"{f.min_len} THEN 1 ELSE 0 END) AS BIGINT) AS {n} FROM ({self.runs(f)}) r GROUP BY 1, 2")
        if k == "mean_exceed":
            m = f"avg({self.col(f.value)})"
            if f.ndigits is not None:
                m = f"round({m}, {f.ndigits})"
            means = f"SELECT DEPT_ID, harvest_year, {m} AS m FROM {self.stage_rows(f)} s GROUP BY 1, 2"
            return (f"SELECT DEPT_ID, harvest_year, CAST(CASE WHEN m > quantile_cont(m, {f.q}) OVER "
                    f"(PARTITION BY DEPT_ID) THEN 1 ELSE 0 END AS INTEGER) AS {n} FROM ({means}) mm")
        raise ValueError(k)

    def mart(self, features: list[Feature]) -> str:
        stages = ", ".join(f"'{s}'" for s in sorted({f.stage for f in features}))
        spine = f"SELECT DISTINCT DEPT_ID, harvest_year FROM ({self.panel}) p WHERE saison IN ({stages})"
        sql = f"SELECT k.DEPT_ID, k.harvest_year, " + ", ".join(
            f"f{i}.{f.name}" for i, f in enumerate(features)) + f" FROM ({spine}) k"
        for i, f in enumerate(features):
            sql += f" LEFT JOIN ({self.sql(f)}) f{i} ON k.DEPT_ID = f{i}.DEPT_ID AND k.harvest_year = f{i}.harvest_year"
        return sql


def spark_round(expr: str, ndigits: str | int) -> str:
    """Round like Spark's ``round`` on doubles: HALF_UP on the shortest
    decimal text of the value (not on its binary expansion)."""
    return (f"CAST(ROUND(TRY_CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18)), {ndigits}) "
            f"AS DOUBLE)")


def _split_args(body: str) -> list[str]:
    depth, start, out = 0, 0, []
    for i, ch in enumerate(body):
        if ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append(body[start:i])
            start = i + 1
    out.append(body[start:])
    return out


def sparkify_rounds(sql: str) -> str:
    """Rewrite every lower-case ``round(x, n)`` call into ``spark_round``."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 1, j + 6
        while depth:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
            k += 1
        args = _split_args(sql[j + 6:k - 1])
        out.append(sql[i:j])
        if len(args) == 2:
            out.append(spark_round(sparkify_rounds(args[0]), args[1].strip()))
        else:
            out.append("round(" + sparkify_rounds(sql[j + 6:k - 1]) + ")")
        i = k


def rounded(sql: str, double_cols: list[str], all_cols: list[str], ndigits: int = 6) -> str:
    """Wrap a query so that its double columns are rounded like the Spark side."""
    def q(c):
        return f'"{c}"'
    sel = ", ".join(f"round({q(c)}, {ndigits}) AS {q(c)}" if c in double_cols else q(c)
                    for c in all_cols)
    return f"SELECT {sel} FROM ({sql}) z"
