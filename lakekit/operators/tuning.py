"""Parameter search by Parzen estimators, and comparison of models by successive halving.

The search keeps up to ``parallelism`` trials running. The first ``at_random`` trials are drawn at random, so only those beyond are proposed: trial n
from the trials up to n - ``parallelism``, once these have ended, so that proposals do not depend on which trial ends first. The better quarter of
these and the rest are both smoothed into densities, parameter by parameter; of some draws from the first density, the
one where it stands highest against the second is tried.

Training runs as Spark jobs; the threads of the driver only wait for them.
"""

from __future__ import annotations

import random
import threading
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from math import ceil, exp, log, pi, sqrt
from typing import NamedTuple

from pyspark.sql import DataFrame

from ..sources.files import key_share
from . import ml
from .cells import Trainer


class Range(NamedTuple):
    """A parameter: from ``low`` to ``high``; ``whole`` for integers, ``scale`` "log" for orders of magnitude."""

    low: float
    high: float
    whole: bool = False
    scale: str = "linear"

    def inner(self, value: float) -> float:
        f = log if self.scale == "log" else float
        return (f(value) - f(self.low)) / ((f(self.high) - f(self.low)) or 1.0)

    def outer(self, u: float):
        u = min(1.0, max(0.0, u))
        v = exp(log(self.low) + u * (log(self.high) - log(self.low))) if self.scale == "log" else self.low + u * (self.high - self.low)
        return int(round(v)) if self.whole else v


class Trial(NamedTuple):
    number: int
    parameters: dict
    value: float


def width_of(points: list[float]) -> float:
    """Of the bells: they narrow as points become more."""
    return max(0.05, 0.5 / sqrt(len(points) + 1))


def density(points: list[float], at: float) -> float:
    """A mixture of bells around the points and one flat part over [0, 1]; bells are mirrored at the ends, so that these are not favoured."""
    width = width_of(points)
    bells = sum(exp(-0.5 * ((at - q) / width) ** 2) for p in points for q in (p, -p, 2 - p))
    return (1.0 + bells / (width * sqrt(2 * pi))) / (len(points) + 1)


def near(points: list[float], rnd: random.Random) -> float:
    """A draw from the mixture."""
    if rnd.random() * (len(points) + 1) < 1:
        return rnd.random()
    u = abs(rnd.gauss(rnd.choice(points), width_of(points)))
    return min(1.0, max(0.0, 2 - u if u > 1 else u))


def propose(space: Mapping[str, Range], ended: list[Trial], rnd: random.Random, draws: int = 24, share: float = 0.25) -> dict:
    """The next parameters to try, for the largest value."""
    order = sorted(ended, key=lambda t: -t.value)
    cut = ceil(share * len(order))
    good, bad = order[:cut], order[cut:]
    out = {}
    for name, r in space.items():
        g, b = [r.inner(t.parameters[name]) for t in good], [r.inner(t.parameters[name]) for t in bad]
        tries = [near(g, rnd) for _ in range(draws)]
        out[name] = r.outer(max(tries, key=lambda u: density(g, u) / density(b, u)))
    return out


def maximise(objective: Callable[[dict], float], space: Mapping[str, Range], trials: int, parallelism: int = 1, seed: int = 42, at_random: int = 8) -> list[Trial]:
    """All trials by number. A trial that fails ends the search with its error."""
    rnd, ended = random.Random(seed), {}
    draw = lambda: {n: r.outer(rnd.random()) for n, r in space.items()}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        running, started = {}, 0
        while started < trials or running:
            while started < trials and len(running) < parallelism:
                known = range(started - parallelism + 1)
                if started < at_random or not known:
                    p = draw()
                elif all(n in ended for n in known):
                    p = propose(space, [ended[n] for n in known], rnd)
                else:
                    break
                running[pool.submit(objective, p)] = (started, p)
                started += 1
            for f in wait(running, return_when=FIRST_COMPLETED).done:
                number, p = running.pop(f)
                ended[number] = Trial(number, p, float(f.result()))
    return [ended[n] for n in sorted(ended)]


#: Parameters of boosted trees.
BOOSTED = {"maxDepth": Range(2, 6, True), "maxIter": Range(3, 12, True), "stepSize": Range(0.05, 0.5, scale="log"), "subsamplingRate": Range(0.5, 1.0)}


def search_boosted(train: DataFrame, valid: DataFrame, trials: int = 16, parallelism: int = 10, label: str = "label", seed: int = 42, space: Mapping[str, Range] = BOOSTED):
    """(best model, one row per trial: trial, auc and every parameter) by AUC on ``valid``; ``train`` should be kept in memory."""
    models, lock, trainer = {}, threading.Lock(), Trainer(train, label).prepare()
    counts = trainer.scored_counts(valid)

    def auc_of(p: dict) -> float:
        est = ml.boosted_trees(label)
        model = trainer.fit(est.copy({est.getParam(k): v for k, v in p.items()}))
        if counts is None:
            value = ml.auc(ml.score(model, valid), label)
        else:
            value = ml.auc_frame(ml.score(model.model, counts), "label", "probability_1", weight="w").first()[0]
        with lock:
            best = max(models, default=None)
            if best is None or value > best:
                models.clear()
                models[value] = model
        return value

    done = maximise(auc_of, space, trials, parallelism, seed)
    trainer.unpersist()
    rows = [(t.number, t.value, *[float(t.parameters[k]) for k in space]) for t in done]
    schema = "trial int, auc double, " + ", ".join(f"{k} double" for k in space)
    return models[max(models)], train.sparkSession.createDataFrame(rows, schema)


def halving(train: DataFrame, valid: DataFrame, models: Mapping[str, object], key: list[str], label: str = "label", start: float = 0.125, factor: int = 2, time_limit: float | None = None) -> DataFrame:
    """Models ranked under a time box: every round fits those left on a larger share of the rows and drops the worse half.

    Shares are taken by a hash of ``key``, so each holds the ones before. One row per model: rank, share of the last fit,
    auc of it, status. Past ``time_limit`` seconds no further fit begins; what has been fitted keeps its rank, the rest says so.
    """
    import time

    begun, share, left, last = time.monotonic(), min(1.0, start), list(models), {}
    late = lambda: time_limit is not None and time.monotonic() - begun > time_limit
    while True:
        part = train if share >= 1.0 else train.where(key_share(key) < share)
        scores, trainer = {}, Trainer(part, label)
        for name in left:
            if late():
                break
            scores[name] = ml.auc_frame(ml.score_counted(trainer, trainer.fit(models[name]), valid), label, "probability_1", weight="w").first()[0]
            last[name] = (share, scores[name])
        trainer.unpersist()
        if late() or (share >= 1.0 and len(left) == 1) or not scores:
            break
        order = sorted(scores, key=lambda n: (-scores[n], n))
        if share >= 1.0 and len(left) <= 2:
            break
        left = order[: max(1, ceil(len(order) / factor))]
        if share >= 1.0:
            break
        share = min(1.0, share * factor)
    order = sorted(models, key=lambda n: (-(last[n][0] if n in last else -1), -(last[n][1] if n in last else 0), n))
    top = max((s for s, _ in last.values()), default=0)
    status = lambda n: "not fitted: time limit" if n not in last else "fitted" if last[n][0] == top else "dropped"
    rows = [(i + 1, n, *last.get(n, (None, None)), status(n)) for i, n in enumerate(order)]
    return train.sparkSession.createDataFrame(rows, "rank int, model string, share double, auc double, status string").orderBy("rank")
