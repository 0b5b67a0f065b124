"""Hyper-parameter search: folds prepared once, random and density-ratio sampling.

What comes before the learner (imputer, assembler, scaler) depends on a fold's training rows
and not on the learner's parameters: it is fitted once per fold, and every parameter map
trains and scores on the fold's stored vectors. The density-ratio sampler learns from the
trials so far: it splits them at a quantile of their scores, models each parameter's values
in the good and in the other trials by a Parzen density, and tries the draw of the good
density whose ratio to the other one is largest.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.session import stored


# ---------------------------------------------------------------- folds

@dataclass
class Folds:
    """Per fold the training and validation vectors, and the prepared whole."""
    train: list[DataFrame]
    valid: list[DataFrame]
    prep: PipelineModel
    whole: DataFrame
    fits: int  # of the preparation, over the folds


def prepare_folds(stages: list, data: DataFrame, target: str, fold_col: str, k: int,
                  features_col: str = "features") -> Folds:
    """Fit ``stages`` on each fold's training rows and store the vectors of its two parts.
    ``data`` is read a few times per fold: pass a stored table."""
    prep = Pipeline(stages=stages)
    train, valid, fits = [], [], 0
    for fold in range(k):
        fitted = prep.fit(data.filter(F.col(fold_col) != fold))
        fits += 1
        vectors = stored(fitted.transform(data).select(features_col, target, fold_col), "fold")
        train.append(vectors.filter(F.col(fold_col) != fold).drop(fold_col).cache())
        valid.append(vectors.filter(F.col(fold_col) == fold).drop(fold_col).cache())
    whole = prep.fit(data)
    return Folds(train, valid, whole, stored(whole.transform(data).select(features_col, target), "fold"), fits)


def score_map(folds: Folds, estimator, params: dict, evaluator) -> float:
    """Mean score of one parameter map (by name) over the folds."""
    learner = estimator.copy({estimator.getParam(n): v for n, v in params.items()})
    scores = [evaluator.evaluate(learner.fit(t).transform(v)) for t, v in zip(folds.train, folds.valid)]
    return sum(scores) / len(scores)


@dataclass
class SearchResult:
    """Trials in the order they were made, (parameters, score), and the refitted best."""
    trials: list[tuple[dict, float]]
    best: dict
    model: PipelineModel
    preparations: int


def _refit(folds: Folds, estimator, params: dict) -> PipelineModel:
    learner = estimator.copy({estimator.getParam(n): v for n, v in params.items()})
    return PipelineModel(stages=[*folds.prep.stages, learner.fit(folds.whole)])


def _done(folds: Folds) -> None:
    for part in [*folds.train, *folds.valid]:
        part.unpersist()


def search_maps(stages: list, estimator, maps: list[dict], data: DataFrame, target: str, fold_col: str, k: int,
                evaluator, parallelism: int = 4) -> SearchResult:
    """Score all ``maps`` over the folds; refit the best on all rows."""
    folds = prepare_folds(stages, data, target, fold_col, k)
    with ThreadPool(parallelism) as pool:
        scores = pool.map(lambda p: score_map(folds, estimator, p, evaluator), maps)
    larger = evaluator.isLargerBetter()
    best = max(range(len(maps)), key=lambda i: scores[i] if larger else -scores[i])
    _done(folds)
    return SearchResult(list(zip(maps, scores)), maps[best], _refit(folds, estimator, maps[best]), folds.fits)


# ---------------------------------------------------------------- sampling

@dataclass(frozen=True)
class Range:
    """Numbers from ``low`` to ``high``, both included; ``log``: even in the logarithm."""
    low: float
    high: float
    integer: bool = False
    log: bool = False

    def inner(self) -> tuple[float, float]:
        # an integer stands for the interval around it
        a, b = (self.low - 0.5, self.high + 0.5) if self.integer else (self.low, self.high)
        return (math.log(a), math.log(b)) if self.log else (a, b)

    def value(self, x: float):
        v = math.exp(x) if self.log else x
        v = min(max(round(v) if self.integer else v, self.low), self.high)
        return int(v) if self.integer else float(v)

    def place(self, value) -> float:
        return math.log(value) if self.log else float(value)


@dataclass(frozen=True)
class Choice:
    values: tuple


def _draw(spec, rng: random.Random):
    return rng.choice(spec.values) if isinstance(spec, Choice) else spec.value(rng.uniform(*spec.inner()))


class _Parzen:
    """Density of a range's values: one truncated bell per value seen, as wide as the gap to
    its neighbours, and one over the whole range."""

    def __init__(self, spec: Range, values: list):
        self.spec, (self.a, self.b) = spec, spec.inner()
        span = self.b - self.a
        at = sorted([spec.place(v) for v in values] + [(self.a + self.b) / 2])
        least = span / min(100.0, 1.0 + len(at))
        self.bells = []
        prior = at.index((self.a + self.b) / 2)
        for i, m in enumerate(at):
            gap = max(m - (at[i - 1] if i else self.a), (at[i + 1] if i + 1 < len(at) else self.b) - m)
            self.bells.append((m, span if i == prior else min(max(gap, least), span)))

    def draw(self, rng: random.Random) -> float:
        m, s = rng.choice(self.bells)
        while True:
            x = rng.gauss(m, s)
            if self.a <= x <= self.b:
                return x

    def log_density(self, x: float) -> float:
        total = 0.0
        for m, s in self.bells:
            mass = 0.5 * (math.erf((self.b - m) / (s * 2 ** 0.5)) - math.erf((self.a - m) / (s * 2 ** 0.5)))
            total += math.exp(-0.5 * ((x - m) / s) ** 2) / (s * (2 * math.pi) ** 0.5 * mass)
        return math.log(total / len(self.bells) + 1e-300)


@dataclass
class DensityRatioSampler:
    """Proposes parameters from the trials told so far; lower scores are better."""
    space: dict[str, Range | Choice]
    seed: int = 42
    startup: int = 10      # drawn at random first
    good_share: float = 0.1
    candidates: int = 24
    trials: list[tuple[dict, float]] = field(default_factory=list)

    def __post_init__(self):
        self.rng = random.Random(self.seed)

    def tell(self, params: dict, score: float) -> None:
        self.trials.append((params, score))

    def ask(self) -> dict:
        known = [t for t in self.trials if t[1] == t[1]]  # not those without a score
        if len(known) < self.startup:
            return {n: _draw(s, self.rng) for n, s in self.space.items()}
        known.sort(key=lambda t: t[1])
        cut = math.ceil(self.good_share * len(known))
        good, rest = known[:cut], known[cut:]
        return {n: self._propose(s, [p[n] for p, _ in good], [p[n] for p, _ in rest]) for n, s in self.space.items()}

    def _propose(self, spec, good: list, rest: list):
        if isinstance(spec, Choice):
            def share(values, v):
                return (values.count(v) + 1) / (len(values) + len(spec.values))
            drawn = self.rng.choices(spec.values, [share(good, v) for v in spec.values], k=self.candidates)
            return max(drawn, key=lambda v: share(good, v) / share(rest, v))
        near, far = _Parzen(spec, good), _Parzen(spec, rest)
        drawn = [near.draw(self.rng) for _ in range(self.candidates)]
        return spec.value(max(drawn, key=lambda x: near.log_density(x) - far.log_density(x)))


def minimise(sampler: DensityRatioSampler, objective: Callable[[dict], float], trials: int) -> tuple[dict, float]:
    """Make ``trials`` trials one after the other; the best parameters and their score."""
    for _ in range(trials):
        params = sampler.ask()
        sampler.tell(params, objective(params))
    return min((t for t in sampler.trials if t[1] == t[1]), key=lambda t: t[1])


def density_ratio_search(stages: list, estimator, space: dict, trials: int, data: DataFrame, target: str,
                         fold_col: str, k: int, evaluator, seed: int = 42, startup: int = 10) -> SearchResult:
    """Sequential search over ``space`` by cross-validated score; refit the best on all rows."""
    folds = prepare_folds(stages, data, target, fold_col, k)
    sign = -1.0 if evaluator.isLargerBetter() else 1.0
    sampler = DensityRatioSampler(space, seed, startup)
    best, _ = minimise(sampler, lambda p: sign * score_map(folds, estimator, p, evaluator), trials)
    _done(folds)
    return SearchResult([(p, sign * s) for p, s in sampler.trials], best, _refit(folds, estimator, best), folds.fits)
