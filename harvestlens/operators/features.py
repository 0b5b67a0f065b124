"""Crop-stage indicator specifications.

Each indicator is a parameter row for one of nine kernels; the mart builder
(``operators.mart``) turns any list of rows into one aggregate pass.

Kernels
-------
count        sum of a 0/1 flag over the stage rows (NULL operand -> 0), / unit
excess       sum of max(value - base, 0) / unit; NULL rows contribute 0
roll_max     max of the n-row rolling sum per (region, harvest year); a sum is
             defined only when all n rows are non-null; no complete window -> NULL
roll_exceed  n-row rolling sum per region over the stage rows of all years
             (frames straddle harvest years), threshold = quantile q of the
             defined sums per region; count of sums strictly above it
run_max      longest run of consecutive flagged rows / unit (0 if none)
run_rows     number of rows inside runs of at least ``min_len`` rows
mean_exceed  1 if the stage mean of the key is strictly above the quantile q of
             the stage means of the region over all years, else 0
low_count    1 if count / unit < limit else 0
joint_count  count of rows where the flag holds; a flag term may compare to a
             quantile of the stage rows per region or per (region, year)

A stage without rows for a key gives NULL; a stage with rows and no hit gives 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

KINDS = ("count", "excess", "roll_max", "roll_exceed", "run_max", "run_rows",
         "mean_exceed", "low_count", "joint_count")

# Measure roles used by the indicators and the column names they default to.
# Fixed values (column names of the reference's cleaned weather tables):
DEFAULT_ROLES = {
    "ta": "temp_air_c",
    "tx": "temp_max_c",
    "rr": "precipitations_1h_mm",
    "hum": "humidite_relative_pct",
    "rad": "rayonnement_global_jcm2",
    "gust": "rafale_max_ms",
}


@dataclass(frozen=True)
class Quantile:
    """Threshold taken as an exact (linearly interpolated) quantile of a
    measure over the stage rows of each region (``scope='region'``) or of each
    (region, harvest year) (``scope='region_year'``)."""
    q: float
    scope: str = "region"
    approx: bool = False      # percentile_approx (no interpolation) instead of exact


@dataclass(frozen=True)
class Term:
    """One comparison ``role op threshold``; terms of a feature are ANDed."""
    role: str
    op: str            # one of > >= < <=
    threshold: float | Quantile


@dataclass(frozen=True)
class Feature:
    name: str
    stage: str
    kind: str
    terms: tuple[Term, ...] = ()
    value: str | None = None       # measure role for excess / roll_* / mean_exceed
    base: float | None = None      # excess base
    window: int | None = None      # rolling window (rows)
    q: float | None = None         # quantile of roll_exceed / mean_exceed
    min_len: int | None = None     # run_rows minimum run length (rows)
    limit: float | None = None     # low_count limit
    unit: float = 1.0              # divisor (24 turns hourly counts into days)
    ndigits: int | None = None     # round rolling sums / means before comparing
    approx: bool = False           # approximate quantile for roll_exceed / mean_exceed
    extra: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kernel kind {self.kind!r}")

    def with_(self, **kw) -> "Feature":
        return replace(self, **kw)


def T(role, op, threshold):
    return Term(role, op, threshold)


# The reference's 19 daily indicators (output names, stages,
# thresholds, windows, run lengths and quantiles), in the reference's order.
DAILY_FEATURES: list[Feature] = [
    Feature("vernalisation_nb_jours_0_10C", "vernalisation", "low_count",
            (T("ta", ">=", 0.0), T("ta", "<=", 10.0)), limit=15),
    Feature("hiver_anormalement_chaud", "vernalisation", "mean_exceed", value="ta", q=0.9),
    Feature("pluie_extreme_10j", "tallage", "roll_exceed", value="rr", window=10, q=0.9),
    Feature("humidity_persistence_risk", "tallage", "run_rows",
            (T("hum", ">", 85.0),), min_len=5),
    Feature("nb_risques_rayonnement_faible", "tallage", "run_rows",
            (T("rad", "<", Quantile(0.10, "region")),), min_len=10),
    Feature("floraison_nb_jours_tx_gt_25", "floraison", "count", (T("tx", ">", 25.0),)),
    Feature("floraison_nb_jours_tx_gt_30", "floraison", "count", (T("tx", ">", 30.0),)),
    Feature("floraison_cumul_pluie_10j_max", "floraison", "roll_max", value="rr", window=10),
    Feature("floraison_max_consecutive_tx_gt_25", "floraison", "run_max", (T("tx", ">", 25.0),)),
    Feature("floraison_max_consecutive_tx_gt_30", "floraison", "run_max", (T("tx", ">", 30.0),)),
    Feature("floraison_heat_degree_days_25", "floraison", "excess", value="tx", base=25.0),
    Feature("floraison_heat_degree_days_30", "floraison", "excess", value="tx", base=30.0),
    Feature("floraison_episodes_tx_gt_30_ge3", "floraison", "run_rows",
            (T("tx", ">", 30.0),), min_len=3),
    Feature("floraison_days_heat_drought", "floraison", "joint_count",
            (T("tx", ">", 28.0), T("rr", "<", Quantile(0.10, "region_year")))),
    Feature("remplissage_nb_jours_tx_gt_25", "remplissage", "count", (T("tx", ">", 25.0),)),
    Feature("remplissage_heatwave_length_max", "remplissage", "run_max", (T("tx", ">", 28.0),)),
    Feature("remplissage_episodes_heatwave_ge3", "remplissage", "run_rows",
            (T("tx", ">", 28.0),), min_len=3),
    Feature("remplissage_max_consecutive_dry_days", "remplissage", "run_max",
            (T("rr", "<=", 0.0),)),
    Feature("remplissage_storm_event_count", "remplissage", "count",
            (T("rr", ">", 15.0), T("gust", ">", 15.0))),
]

# Hourly twins. The hourly versions read the air temperature
# where the daily ones read the daily maximum, multiply windows and run
# lengths by 24, and divide counts, run lengths and degree sums by 24
# (not the run-row counts nor the rolling-exceedance counts).
HOURS_PER_DAY = 24
_HOURLY_UNIT_KINDS = {"count", "run_max", "excess", "joint_count", "low_count"}


def _to_hourly(f: Feature) -> Feature:
    terms = tuple(Term("ta" if t.role == "tx" else t.role, t.op, t.threshold) for t in f.terms)
    value = "ta" if f.value == "tx" else f.value
    kw = dict(terms=terms, value=value)
    if f.window is not None:
        kw["window"] = f.window * HOURS_PER_DAY
    if f.min_len is not None:
        kw["min_len"] = f.min_len * HOURS_PER_DAY
    if f.kind in _HOURLY_UNIT_KINDS:
        kw["unit"] = float(HOURS_PER_DAY)
    return f.with_(**kw)


HOURLY_FEATURES: list[Feature] = [_to_hourly(f) for f in DAILY_FEATURES]

# Stage groups and feature combos of the reference.
STAGE_GROUPS = {
    "vern": [f.name for f in DAILY_FEATURES[0:2]],
    "veg": [f.name for f in DAILY_FEATURES[2:5]],
    "flor": [f.name for f in DAILY_FEATURES[5:14]],
    "remp": [f.name for f in DAILY_FEATURES[14:19]],
}
COMBOS = {
    "vern_full": STAGE_GROUPS["vern"],
    "veg_full": STAGE_GROUPS["veg"],
    "flor_full": STAGE_GROUPS["flor"],
    "remp_full": STAGE_GROUPS["remp"],
    "early_stages": STAGE_GROUPS["vern"] + STAGE_GROUPS["veg"],
    "flor_remp": STAGE_GROUPS["flor"] + STAGE_GROUPS["remp"],
    "all": [f.name for f in DAILY_FEATURES],
}


def combo(features: list[Feature], combo_id: str = "all") -> list[Feature]:
    if combo_id not in COMBOS:
        raise ValueError(f"unknown combo_id {combo_id!r}; available: {list(COMBOS)}")
    by_name = {f.name: f for f in features}
    return [by_name[n] for n in COMBOS[combo_id]]


def override(features: list[Feature], changes: dict[str, dict]) -> list[Feature]:
    """Copy of ``features`` with per-name parameter changes applied."""
    return [f.with_(**changes[f.name]) if f.name in changes else f for f in features]
