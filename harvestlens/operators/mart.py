"""One-pass crop-stage feature mart.

Plan (one shuffle of the panel for the whole mart):

1. keep the rows of the stages the chosen features need, and only the
   measure columns they read (pruned down to the scan);
2. hash-partition by (region, stage) once; every window groups by keys that
   contain both, so Spark adds no further exchange for them;
3. one sort on (region, stage, harvest year, time) serves every window:
   rolling sums, run positions and per-stage quantile thresholds;
4. one ``groupBy(region, harvest_year)`` of stage-conditional aggregates
   replaces the reference's 19 filter/aggregate/outer-merge functions; what it
   exchanges is one partial row per (region, stage, year);
5. the per-region quantile of stage means (``mean_exceed``) is a window over
   the aggregated rows of each region (a few rows per region).

Windows hold one region's stage rows at a time. The panel has one row per
(region, time step), so a window partition is bounded by the calendar
(years x stage length), whatever the size or skew of the raw data.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.functions.calendar import crop_stage, harvest_year
from harvestlens.functions.nulls import flag
from harvestlens.operators.features import DEFAULT_ROLES, Feature, Quantile

REGION, YEAR, STAGE = "DEPT_ID", "harvest_year", "saison"
_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def label_stages(panel: DataFrame, time_col: str) -> DataFrame:
    """Add harvest year and crop stage columns to a weather panel."""
    return panel.withColumns({YEAR: harvest_year(time_col), STAGE: crop_stage(time_col)})


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


def _roles(roles: dict | None) -> dict:
    r = dict(DEFAULT_ROLES)
    r.update(roles or {})
    return r


def _maybe_round(c: Column, ndigits: int | None) -> Column:
    return F.round(c, ndigits) if ndigits is not None else c


APPROX_ACCURACY = 10000


def _quantile(c: Column, q: float, approx: bool) -> Column:
    """Exact (linear interpolation) by default; ``approx`` uses the mergeable
    sketch of ``percentile_approx`` (returns a data value, no interpolation)."""
    if approx:
        return F.percentile_approx(c, F.lit(q), APPROX_ACCURACY)
    return F.percentile(c, F.lit(q))


class _Plan:
    """Collects window columns (by phase) and aggregate columns for features."""

    def __init__(self, roles, region, year, stage, time_col):
        self.roles, self.region, self.year = roles, region, year
        self.stage, self.time_col = stage, time_col
        # Sort order (region, stage, year, time) == time order inside a
        # (region, stage) partition: within one stage the harvest year is a
        # non-decreasing function of time. Ordering both window families the
        # same way lets one sort serve all of them.
        self.w_region = Window.partitionBy(region, stage).orderBy(year, time_col)
        self.w_key = Window.partitionBy(region, stage, year).orderBy(time_col)
        self.w_region_all = Window.partitionBy(region, stage)
        self.w_key_all = Window.partitionBy(region, stage, year)
        self.phase1: dict[str, Column] = {}   # thresholds, rolling sums, row numbers
        self.phase2: dict[str, Column] = {}   # flags / rolling thresholds
        self.phase3: dict[str, Column] = {}   # run positions, next flag
        self.aggs: list[Column] = []
        self.post: dict[str, Column] = {}     # columns computed after the groupBy
        self.post_drop: list[str] = []
        self.outputs: list[str] = []

    def m(self, role: str) -> Column:
        return F.col(self.roles.get(role, role))

    def in_stage(self, f: Feature) -> Column:
        return F.col(self.stage) == F.lit(f.stage)

    def threshold(self, f: Feature, term, i: int) -> Column:
        th = term.threshold
        if not isinstance(th, Quantile):
            return F.lit(float(th))
        name = f"__thr_{_safe(f.name)}_{i}"
        w = self.w_region_all if th.scope == "region" else self.w_key_all
        self.phase1[name] = _quantile(F.when(self.in_stage(f), self.m(term.role)),
                                      th.q, th.approx).over(w)
        return F.col(name)

    def cond(self, f: Feature) -> Column:
        parts = [_OPS[t.op](self.m(t.role), self.threshold(f, t, i))
                 for i, t in enumerate(f.terms)]
        return flag(reduce(lambda a, b: a & b, parts))

    def run_columns(self, f: Feature) -> tuple[Column, Column]:
        """(position in current run, is-last-row-of-run) for the feature's flag."""
        s = _safe(f.name)
        fl, rn, pos, nxt = f"__flag_{s}", "__rn", f"__pos_{s}", f"__next_{s}"
        self.phase1[rn] = F.row_number().over(self.w_key)
        self.phase2[fl] = self.cond(f)
        running = self.w_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last_break = F.max(F.when(~F.col(fl), F.col(rn))).over(running)
        self.phase3[pos] = F.col(rn) - F.coalesce(last_break, F.lit(0))
        self.phase3[nxt] = F.lead(F.col(fl)).over(self.w_key)
        is_end = F.col(fl) & ~F.coalesce(F.col(nxt), F.lit(False))
        return F.col(pos), is_end

    def add(self, f: Feature):
        st = self.in_stage(f)
        unit = F.lit(float(f.unit))
        k = f.kind
        if k == "count" or k == "joint_count":
            hits = F.sum(F.when(st, self.cond(f).cast("int")))
            col = hits if f.unit == 1.0 else hits / unit
        elif k == "low_count":
            hits = F.sum(F.when(st, self.cond(f).cast("int")))
            days = hits if f.unit == 1.0 else hits / unit
            col = F.when(hits.isNotNull(), (days < F.lit(float(f.limit))).cast("int"))
        elif k == "excess":
            excess = F.greatest(self.m(f.value) - F.lit(float(f.base)), F.lit(0.0))
            col = F.sum(F.when(st, excess if f.unit == 1.0 else excess / unit))
        elif k == "roll_max":
            roll = self._rolling(f, self.w_key, f"__roll_{_safe(f.name)}")
            col = F.max(F.when(st, roll))
        elif k == "roll_exceed":
            name = f"__roll_{_safe(f.name)}"
            roll = self._rolling(f, self.w_region, name)
            thr = f"__rthr_{_safe(f.name)}"
            self.phase2[thr] = _quantile(F.when(st, roll), f.q, f.approx).over(self.w_region_all)
            col = F.sum(F.when(st & roll.isNotNull(), (roll > F.col(thr)).cast("int")))
        elif k == "run_max":
            pos, _ = self.run_columns(f)
            longest = F.max(F.when(st, pos))
            col = longest.cast("long") if f.unit == 1.0 else longest / unit
        elif k == "run_rows":
            pos, is_end = self.run_columns(f)
            col = F.sum(F.when(st, F.when(is_end & (pos >= F.lit(f.min_len)), pos)
                               .otherwise(F.lit(0))).cast("long"))
        elif k == "mean_exceed":
            mean_name = f"__mean_{_safe(f.name)}"
            has_name = f"__has_{_safe(f.name)}"
            self.aggs.append(_maybe_round(F.avg(F.when(st, self.m(f.value))), f.ndigits)
                             .alias(mean_name))
            self.aggs.append(F.max(st.cast("int")).alias(has_name))
            thr = _quantile(F.col(mean_name), f.q, f.approx).over(
                Window.partitionBy(self.region))
            self.post[f.name] = F.when(F.col(has_name) == 1,
                                       flag(F.col(mean_name) > thr).cast("int"))
            self.post_drop += [mean_name, has_name]
            self.outputs.append(f.name)
            return
        else:  # pragma: no cover - guarded by Feature.__post_init__
            raise ValueError(k)
        self.aggs.append(col.alias(f.name))
        self.outputs.append(f.name)

    def _rolling(self, f: Feature, w, name: str) -> Column:
        frame = w.rowsBetween(-(f.window - 1), Window.currentRow)
        x = self.m(f.value)
        roll = F.when(F.count(x).over(frame) == F.lit(f.window), F.sum(x).over(frame))
        self.phase1[name] = _maybe_round(F.when(self.in_stage(f), roll), f.ndigits)
        return F.col(name)


def build_mart(panel: DataFrame, features: list[Feature], *, time_col: str = "day",
               roles: dict | None = None, region: str = REGION, year: str = YEAR,
               stage: str = STAGE, sort: bool = False) -> DataFrame:
    """Feature mart: one row per (region, harvest year) with one column per
    feature, for every key that has rows in at least one chosen stage.

    ``panel`` needs the region, time, harvest-year and stage columns
    (``label_stages``) plus the measure columns named by ``roles``.
    """
    if not features:
        raise ValueError("no features requested")
    roles = _roles(roles)
    plan = _Plan(roles, region, year, stage, time_col)
    for f in features:
        plan.add(f)

    stages = sorted({f.stage for f in features})
    measure_cols = sorted({roles.get(t.role, t.role) for f in features for t in f.terms}
                          | {roles.get(f.value, f.value) for f in features if f.value})
    # NaN -> NULL on the measures read (pandas has one missing value; Spark's
    # NaN compares greater than every number)
    measures = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c)
                for c in measure_cols]
    df = (panel.filter(F.col(stage).isin(stages))
          .select(region, year, stage, time_col, *measures)
          .filter(F.col(region).isNotNull())
          .repartition(region, stage))
    for phase in (plan.phase1, plan.phase2, plan.phase3):
        if phase:
            df = df.withColumns(phase)
    out = df.groupBy(region, year).agg(*plan.aggs)
    if plan.post:
        out = out.withColumns(plan.post).drop(*plan.post_drop)
    out = out.select(region, year, *plan.outputs)
    return out.orderBy(region, year) if sort else out


def feature_frame(panel: DataFrame, feature: Feature, **kw) -> DataFrame:
    """One indicator on its own, with the key set of the reference function:
    rolling kernels only list keys that have a complete window."""
    out = build_mart(panel, [feature], **kw)
    if feature.kind in ("roll_max", "roll_exceed"):
        out = out.filter(F.col(feature.name).isNotNull())
    return out


def build_mart_outer(panel: DataFrame, features: list[Feature], **kw) -> DataFrame:
    """Reference-shaped form: one frame per feature, full-outer-joined on the
    keys. Kept as a cross-check of ``build_mart``; it shuffles once per
    feature, so use ``build_mart`` for real work."""
    frames = [feature_frame(panel, f, **kw) for f in features]
    keys = [kw.get("region", REGION), kw.get("year", YEAR)]
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)
