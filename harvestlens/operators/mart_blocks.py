"""The feature mart from blocks of time: same values as ``mart.build_mart``, without any
window or percentile over a whole region.

Thresholds that are quantiles come from value counts by rank (``quantile``), runs from block
summaries and rolling sums from stretches with margins (``blocks``). The pruned panel is
written once and read by each of these; what they bring is a few rows per region and year,
put together by one aggregate. Meant for panels whose regions are too long or too unequal
for a task each; ``build_mart`` shuffles less where they are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlens.functions.nulls import flag
from harvestlens.operators import blocks
from harvestlens.operators.features import Feature, Quantile
from harvestlens.operators.mart import _OPS, REGION, STAGE, YEAR, _maybe_round, _roles
from harvestlens.operators.quantile import quantile_columns
from harvestlens.session import stored


class _Parts:
    def __init__(self, panel, features, time_col, roles, region, year, stage, seconds, stretch):
        self.roles, self.region, self.year, self.stage, self.time_col = _roles(roles), region, year, stage, time_col
        self.seconds, self.stretch, self.features = seconds, stretch, features
        measures = sorted({self.role(t.role) for f in features for t in f.terms}
                          | {self.role(f.value) for f in features if f.value})
        self.panel = stored(panel.filter(F.col(stage).isin(sorted({f.stage for f in features})) & F.col(region).isNotNull())
                            .select(region, year, stage, time_col,
                                    *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in measures]), "panel")
        self.thresholds: dict[tuple, str] = {}
        self.rows = self._with_thresholds()

    def role(self, name: str) -> str:
        return self.roles.get(name, name)

    def _with_thresholds(self) -> DataFrame:
        """The panel with one column per quantile that a term compares with."""
        scopes: dict[tuple, dict] = {}
        for f in self.features:
            for t in f.terms:
                if isinstance(t.threshold, Quantile):
                    keys = (self.region, self.stage) + ((self.year,) if t.threshold.scope != "region" else ())
                    key = (keys, self.role(t.role), t.threshold.q)
                    self.thresholds[key] = f"__thr_{len(self.thresholds)}" if key not in self.thresholds else self.thresholds[key]
                    scopes.setdefault(keys, {})[self.thresholds[key]] = key[1:]
        rows = self.panel
        for keys, wanted in scopes.items():
            rows = rows.join(quantile_columns(self.panel, list(keys), wanted), list(keys), "left")
        return rows

    def cond(self, f: Feature) -> Column:
        parts = []
        for t in f.terms:
            th = t.threshold
            if isinstance(th, Quantile):
                keys = (self.region, self.stage) + ((self.year,) if th.scope != "region" else ())
                at = F.col(self.thresholds[keys, self.role(t.role), th.q])
            else:
                at = F.lit(float(th))
            parts.append(_OPS[t.op](F.col(self.role(t.role)), at))
        return flag(reduce(lambda a, b: a & b, parts))

    def counted(self) -> DataFrame | None:
        """Plain conditional aggregates."""
        aggs, after = [], {}
        for f in self.features:
            st, unit = F.col(self.stage) == f.stage, F.lit(float(f.unit))
            if f.kind in ("count", "joint_count", "low_count"):
                hits = F.sum(F.when(st, self.cond(f).cast("int")))
                days = hits if f.unit == 1.0 else hits / unit
                aggs.append((F.when(hits.isNotNull(), (days < float(f.limit)).cast("int")) if f.kind == "low_count" else days).alias(f.name))
            elif f.kind == "excess":
                x = F.greatest(F.col(self.role(f.value)) - F.lit(float(f.base)), F.lit(0.0))
                aggs.append(F.sum(F.when(st, x if f.unit == 1.0 else x / unit)).alias(f.name))
            elif f.kind == "mean_exceed":
                aggs += [_maybe_round(F.avg(F.when(st, F.col(self.role(f.value)))), f.ndigits).alias(f"__mean_{f.name}"),
                         F.max(st.cast("int")).alias(f"__has_{f.name}")]
                after[f.name] = (f"__mean_{f.name}", f.q)
        if not aggs:
            return None
        out = self.rows.groupBy(self.region, self.year).agg(*aggs)
        if after:
            names = {f"__q_{n}": w for n, w in after.items()}
            out = stored(out, "means")
            out = out.join(quantile_columns(out, [self.region], names), self.region, "left")
            for n, (mean, _) in after.items():
                out = out.withColumn(n, F.when(F.col(f"__has_{n}") == 1, flag(F.col(mean) > F.col(f"__q_{n}")).cast("int")))
        return out.select(self.region, self.year, *[c for c in out.columns if not c.startswith("__") and c not in (self.region, self.year)])

    def runs(self) -> DataFrame | None:
        chosen = [f for f in self.features if f.kind in ("run_max", "run_rows")]
        if not chosen:
            return None
        flags = {f"f{i}": ((F.col(self.stage) == f.stage) & self.cond(f), f.min_len or 1) for i, f in enumerate(chosen)}
        keys = [self.region, self.stage, self.year]
        found = blocks.run_summaries(self.rows, keys, self.time_col, flags, self.seconds)
        aggs = []
        for i, f in enumerate(chosen):
            mine = F.col(self.stage) == f.stage
            if f.kind == "run_max":
                best = F.max(F.when(mine, F.col(f"f{i}_best")))
                aggs.append((best if f.unit == 1.0 else best / F.lit(float(f.unit))).alias(f.name))
            else:
                aggs.append(F.max(F.when(mine, F.col(f"f{i}_long"))).alias(f.name))
        return found.groupBy(self.region, self.year).agg(*aggs)

    def rolled(self, f: Feature) -> DataFrame:
        keys = [self.region, self.stage] + ([self.year] if f.kind == "roll_max" else [])
        rows = self.panel.filter(F.col(self.stage) == f.stage).select(
            self.region, self.stage, self.year, self.time_col, F.col(self.role(f.value)).alias("__x"))
        roll = blocks.rolling_sum(rows, keys, self.time_col, "__x", f.window, "__roll", f.ndigits, self.seconds, self.stretch)
        if f.kind == "roll_max":
            return roll.groupBy(self.region, self.year).agg(F.max("__roll").alias(f.name))
        roll = stored(roll.filter("__roll is not null"), "rolled")
        thr = quantile_columns(roll, [self.region], {"__thr": ("__roll", f.q)})
        return (roll.join(thr, self.region).groupBy(self.region, self.year)
                .agg(F.sum((F.col("__roll") > F.col("__thr")).cast("int")).alias(f.name)))


def build_mart_blocks(panel: DataFrame, features: list[Feature], *, time_col: str = "day", roles: dict | None = None,
                      region: str = REGION, year: str = YEAR, stage: str = STAGE, sort: bool = False,
                      seconds: int = blocks.BLOCK_SECONDS, stretch: int = blocks.STRETCH_ROWS) -> DataFrame:
    """The mart of :func:`mart.build_mart` (approximate thresholds are taken exactly). Within
    a stage the harvest year must not fall as time goes on, as the calendar has it."""
    if not features:
        raise ValueError("no features requested")
    parts = _Parts(panel, features, time_col, roles, region, year, stage, seconds, stretch)
    frames = [x for x in (parts.counted(), parts.runs()) if x is not None]
    frames += [parts.rolled(f) for f in features if f.kind in ("roll_max", "roll_exceed")]
    # every key of the chosen stages has a row, also where a part has none
    frames.append(parts.panel.select(region, year).distinct())
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    out = both.groupBy(region, year).agg(*[F.max(f.name).alias(f.name) for f in features])
    return out.orderBy(region, year) if sort else out
