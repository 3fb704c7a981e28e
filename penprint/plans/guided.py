"""Sequential search: proposals from the finished trials, and an early end for hopeless ones.

A proposal compares two densities per parameter, one of the better trials and one of the rest, and takes the candidate
that is most likelier among the better ones. Only finished trials and their scores are kept on the driver; what a
trial measures runs on Spark.
"""

from __future__ import annotations

import math
import random
import statistics
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.evaluate import f1_scores
from penprint.plans.search import draw, light, prepared

FIRST = 10  # random trials before the first proposal
CANDIDATES = 24
WARM = 3  # finished trials that a trial is compared with at least


@dataclass
class Trial:
    """One set of values, the score of every fold that ran, and whether it was ended early."""

    number: int
    params: dict
    scores: list[float] = field(default_factory=list)
    ended: bool = False

    @property
    def score(self) -> float:
        return statistics.fmean(self.scores) if self.scores else float("-inf")


def straight(value: float, bounds: tuple) -> float:
    """A number's place on the scale it is searched on."""
    return math.log(value) if bounds[2] in ("log", "logint") else float(value)


def back(place: float, bounds: tuple) -> float | int:
    low, high, scale = bounds
    value = math.exp(place) if scale in ("log", "logint") else place
    return min(max(round(value), low), high) if scale in ("int", "logint") else min(max(value, low), high)


class Density:
    """Mixture of a bell around every seen place, as wide as the gap to its neighbours, and one over the whole range."""

    def __init__(self, places: list[float], low: float, high: float):
        self.low, self.high = low, high
        spots = sorted(places)
        edges = [low, *spots, high]
        floor = (high - low) / (10 + len(spots))
        self.bells = [(x, min(max(x - edges[k], edges[k + 2] - x, floor), high - low)) for k, x in enumerate(spots)]
        self.bells.append(((low + high) / 2, high - low))

    def draw(self, rng: random.Random) -> float:
        centre, width = rng.choice(self.bells)
        return min(max(rng.gauss(centre, width), self.low), self.high)

    def height(self, x: float) -> float:
        return sum(math.exp(-0.5 * ((x - c) / w) ** 2) / w for c, w in self.bells) / len(self.bells)


def split_trials(finished: list[Trial]) -> tuple[list[Trial], list[Trial]]:
    """The better quarter, at most 25, and the rest; of equal scores the earlier trial is the better one."""
    ranked = sorted(finished, key=lambda t: (-t.score, t.number))
    top = min(25, max(1, math.ceil(len(ranked) / 4)))
    return ranked[:top], ranked[top:]


def propose(space: dict, finished: list[Trial], rng: random.Random) -> dict:
    """Values for the next trial: random at first, then each parameter's best candidate of ``CANDIDATES``."""
    if len(finished) < FIRST:
        return draw(space, rng)
    good, rest = split_trials(finished)
    chosen = {}
    for name, bounds in space.items():
        if isinstance(bounds, list):
            def share(value, trials: list[Trial], name=name, size=len(bounds)) -> float:
                return (1 + sum(t.params[name] == value for t in trials)) / (size + len(trials))

            weights = [share(v, good) for v in bounds]
            tried = rng.choices(bounds, weights, k=CANDIDATES)
            chosen[name] = max(tried, key=lambda v: share(v, good) / share(v, rest))
            continue
        low, high = straight(bounds[0], bounds), straight(bounds[1], bounds)
        better, worse = (Density([straight(t.params[name], bounds) for t in trials], low, high) for trials in (good, rest))
        tried = [better.draw(rng) for _ in range(CANDIDATES)]
        chosen[name] = back(max(tried, key=lambda x: better.height(x) / worse.height(x)), bounds)
    return chosen


def hopeless(trial: Trial, finished: list[Trial]) -> bool:
    """Whether a trial's mean so far lies below the median of the finished ones after as many folds."""
    n = len(trial.scores)
    others = [statistics.fmean(t.scores[:n]) for t in finished if not t.ended and len(t.scores) >= n]
    return len(others) >= WARM and trial.score < statistics.median(others)


def guided_search(
    measure: Callable[[dict, int], float], space: dict, folds: int = 1, n_trials: int = 30, seed: int = 42, prune: bool = True
) -> list[Trial]:
    """Trials one after another, best first; ``measure(params, fold)`` gives a score to raise.

    A trial that :func:`hopeless` ends early keeps the scores of the folds it ran and stays behind the whole ones.
    """
    rng = random.Random(seed)
    trials: list[Trial] = []
    for number in range(n_trials):
        trial = Trial(number, propose(space, trials, rng))
        for fold in range(folds):
            trial.scores.append(measure(trial.params, fold))
            if prune and fold + 1 < folds and hopeless(trial, trials):
                trial.ended = True
                break
        trials.append(trial)
    return sorted(trials, key=lambda t: (t.ended, -t.score, t.number))


def tune_guided(
    make: Callable[[dict, int], tuple[list, list]], space: dict, df: DataFrame, k: int = 5, n_trials: int = 30, fold: str = "fold",
    label: str = "label", metric: str = "f1_weighted", seed: int = 42, prune: bool = True,
) -> list[Trial]:
    """Guided search over the stages that ``make(params, training rows)`` returns, scored fold by fold."""
    sizes = {r[fold]: r["n"] for r in df.groupBy(fold).agg(F.count("*").alias("n")).collect()}
    n_all = sum(sizes.values())
    kept: dict[str, DataFrame] = {}

    def measure(params: dict, i: int) -> float:
        local, learned = make(params, n_all - sizes.get(i, 0))
        key = repr(sorted(params.items(), key=str)) if local else ""
        if key not in kept:
            for old in kept.values():
                old.unpersist()
            kept.clear()
            kept[key] = prepared(local, df, n_all)
        train, valid = kept[key].where(F.col(fold) != i), kept[key].where(F.col(fold) == i)
        *before, last = learned
        ready = Pipeline(stages=before).fit(train)
        scored = last.fit(light(ready.transform(train), last)).transform(ready.transform(valid))
        pairs = scored.select(F.col(label).cast("int").alias("label"), F.col("prediction").cast("int"))
        return f1_scores(pairs).first()[metric]

    try:
        return guided_search(measure, space, k, n_trials, seed, prune)
    finally:
        for old in kept.values():
            old.unpersist()


def trials_table(trials: list[Trial], spark) -> DataFrame:
    """Trials as rows: trial, params, n_folds, score, ended."""
    rows = [(t.number, {p: str(v) for p, v in t.params.items()}, len(t.scores), t.score, t.ended) for t in trials]
    return spark.createDataFrame(rows, "trial int, params map<string,string>, n_folds int, score double, ended boolean")
