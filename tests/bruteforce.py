"""Plain pandas re-statement of the indicator semantics, used as a test
reference: per-feature stage filter, sort, shift/cumsum run ids, run lengths
merged back, rolling sums, group quantiles, outer merge of all features."""

from __future__ import annotations

import operator

import numpy as np
import pandas as pd

from harvestlens.operators.features import DEFAULT_ROLES, Quantile

OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
KEYS = ["DEPT_ID", "harvest_year"]


def _col(roles, r):
    return {**DEFAULT_ROLES, **(roles or {})}.get(r, r)


def _flag(df, f, roles):
    m = pd.Series(True, index=df.index)
    for t in f.terms:
        x = df[_col(roles, t.role)]
        if isinstance(t.threshold, Quantile):
            keys = ["DEPT_ID"] if t.threshold.scope == "region" else KEYS
            thr = df.groupby(keys)[_col(roles, t.role)].transform(
                lambda s, q=t.threshold.q: s.quantile(q))
        else:
            thr = t.threshold
        m &= OPS[t.op](x, thr).fillna(False).astype(bool)
    return m.astype(int)


def _runs(df, flag_col):
    df = df.copy()
    df["run_id"] = df.groupby(KEYS)[flag_col].transform(lambda x: (x != x.shift()).cumsum())
    lengths = df.groupby(KEYS + ["run_id"])[flag_col].sum().rename("run_length").reset_index()
    return df.merge(lengths, on=KEYS + ["run_id"])


def feature(pdf: pd.DataFrame, f, roles=None, time_col="day") -> pd.DataFrame:
    st = pdf[pdf["saison"] == f.stage].copy()
    n = f.name
    if f.kind in ("count", "joint_count", "low_count"):
        st["flag"] = _flag(st, f, roles)
        out = st.groupby(KEYS, as_index=False)["flag"].sum()
        if f.unit != 1.0:
            out["flag"] = out["flag"] / f.unit
        if f.kind == "low_count":
            out["flag"] = (out["flag"] < f.limit).astype(int)
        return out.rename(columns={"flag": n})
    if f.kind == "excess":
        x = st[_col(roles, f.value)]
        st["e"] = (x - f.base).clip(lower=0) / f.unit
        return st.groupby(KEYS, as_index=False)["e"].sum().rename(columns={"e": n})
    if f.kind in ("roll_max", "roll_exceed"):
        part = KEYS if f.kind == "roll_max" else ["DEPT_ID"]
        st = st.sort_values(part + [time_col])
        roll = (st.groupby(part)[_col(roles, f.value)]
                .rolling(window=f.window, min_periods=f.window).sum()
                .reset_index(level=list(range(len(part))), drop=True))
        st["roll"] = roll
        if f.ndigits is not None:
            st["roll"] = st["roll"].round(f.ndigits)
        st = st.dropna(subset=["roll"])
        if f.kind == "roll_max":
            return st.groupby(KEYS, as_index=False)["roll"].max().rename(columns={"roll": n})
        st["thr"] = st.groupby("DEPT_ID")["roll"].transform(lambda s: s.quantile(f.q))
        st["hit"] = (st["roll"] > st["thr"]).astype(int)
        return st.groupby(KEYS, as_index=False)["hit"].sum().rename(columns={"hit": n})
    if f.kind in ("run_max", "run_rows"):
        st = st.sort_values(KEYS + [time_col])
        st["flag"] = _flag(st, f, roles)
        st = _runs(st, "flag")
        if f.kind == "run_max":
            out = st.groupby(KEYS, as_index=False)["run_length"].max().rename(
                columns={"run_length": n})
            if f.unit != 1.0:
                out[n] = out[n] / f.unit
            return out
        ep = st[(st["flag"] == 1) & (st["run_length"] >= f.min_len)]
        cnt = ep.groupby(KEYS).size().reset_index(name=n)
        spine = st[KEYS].drop_duplicates()
        return spine.merge(cnt, on=KEYS, how="left").fillna({n: 0}).astype({n: int})
    if f.kind == "mean_exceed":
        m = st.groupby(KEYS)[_col(roles, f.value)].mean().reset_index(name="m")
        if f.ndigits is not None:
            m["m"] = m["m"].round(f.ndigits)
        m["thr"] = m.groupby("DEPT_ID")["m"].transform(lambda s: s.quantile(f.q))
        m[n] = (m["m"] > m["thr"]).astype(int)
        return m[KEYS + [n]]
    raise ValueError(f.kind)


def mart(pdf: pd.DataFrame, features, roles=None, time_col="day") -> pd.DataFrame:
    out = None
    for f in features:
        part = feature(pdf, f, roles, time_col)
        out = part if out is None else out.merge(part, on=KEYS, how="outer")
    return out.sort_values(KEYS).reset_index(drop=True)


def random_daily_panel(seed: int, n_dept: int = 3, years=(1999, 2000, 2001),
                       missing: float = 0.15, nulls: float = 0.08) -> pd.DataFrame:
    """Daily panel with reference column names, missing days and nulls;
    values on a 0.5 grid so thresholds are hit exactly sometimes."""
    rng = np.random.default_rng(seed)
    days = pd.date_range(f"{years[0] - 1}-09-01", f"{years[-1]}-08-31", freq="D")
    rows = []
    for d in range(n_dept):
        keep = rng.random(len(days)) > missing
        for day in days[keep]:
            base = 12 + 14 * np.sin((day.dayofyear - 110) / 365 * 2 * np.pi)
            tx = np.round((base + rng.normal(0, 6)) * 2) / 2
            rows.append({
                "DEPT_ID": f"{d + 1:02d}", "day": day.date(),
                "temp_air_c": tx - 6.0, "temp_max_c": tx,
                "precipitations_1h_mm": float(np.round(max(0.0, rng.normal(1, 6)) * 2) / 2),
                "humidite_relative_pct": float(np.round(rng.uniform(60, 100))),
                "rayonnement_global_jcm2": float(np.round(rng.uniform(200, 2000), -1)),
                "rafale_max_ms": float(np.round(rng.uniform(0, 25))),
            })
    pdf = pd.DataFrame(rows)
    for c in ["temp_air_c", "temp_max_c", "precipitations_1h_mm", "humidite_relative_pct"]:
        pdf.loc[rng.random(len(pdf)) < nulls, c] = np.nan
    ts = pd.to_datetime(pdf["day"])
    pdf["harvest_year"] = (ts.dt.year + (ts.dt.month >= 9).astype(int)).astype("int32")
    return pdf


def season_of(d) -> str:
    m, day = d.month, d.day
    if m in (9, 10, 11):
        return "semis"
    if m in (12, 1, 2):
        return "vernalisation"
    if m == 3 or (m == 4 and day <= 15):
        return "tallage"
    if (m == 4 and day > 15) or (m == 5 and day <= 15):
        return "montaison"
    if (m == 5 and day > 15) or (m == 6 and day <= 15):
        return "floraison"
    return "remplissage"


def with_season(pdf: pd.DataFrame, time_col: str = "day") -> pd.DataFrame:
    out = pdf.copy()
    out["saison"] = [season_of(d) for d in pd.to_datetime(out[time_col])]
    return out
