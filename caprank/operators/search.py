"""Seeded random search over a scorer's parameters (M7).

Trials are drawn from a space by a seeded sampler, so trial ``i`` is the same on
every run whatever else runs.  Every trial is judged by the same thing, precision at
k (K2) on shared stratified folds.  Poor trials stop early (successive halving): all
trials run on the first fold, the best ``1 / eta`` of them go on to the next ones, and
so on; only those that ran on all folds can win.  A bounded number of fits is in
flight at a time; each is an ordinary distributed fit.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caprank.operators.metrics import topk_metrics
from caprank.operators.scorers import CohortSpec, build_scorer
from caprank.operators.split import stratified_folds
from caprank.session import cut_lineage


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def draw(self, rng: random.Random) -> float:
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class LogUniform:
    low: float
    high: float

    def draw(self, rng: random.Random) -> float:
        return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))


@dataclass(frozen=True)
class Whole:
    """Integers from ``low`` to ``high``, both included."""

    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.low, self.high)


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


#: Parameters of the rungs that learn, with the ranges that are worth a trial.
SPACES = {
    "logistic": {"C": LogUniform(1e-3, 1e2), "class_weight": Choice((None, "balanced")), "max_categories": Choice((6, 11, 21))},
    "gbt": {"max_iter": Whole(40, 300), "step_size": LogUniform(0.02, 0.3), "max_depth": Whole(2, 6), "min_instances": Choice((10, 20, 50))},
}


def draw_trials(space: dict, n_trials: int, seed: int) -> list[dict]:
    """Parameters of each trial; trial ``i`` depends on (seed, i) alone."""
    out = []
    for i in range(n_trials):
        rng = random.Random(f"{seed}:{i}")
        out.append({name: space[name].draw(rng) for name in sorted(space)})
    return out


def halving(n_trials: int, n_folds: int, eta: int = 3) -> list[tuple[int, list[int]]]:
    """(trials that run, folds of the rung) of each rung of the search: the number of
    trials falls by ``eta`` a rung, and the last rung has the folds that are left."""
    out, left, fold = [], n_trials, 0
    while fold < n_folds:
        last = left <= eta or fold == n_folds - 1
        folds = list(range(fold, n_folds)) if last else [fold]
        out.append((left, folds))
        fold += len(folds)
        left = max(1, math.ceil(left / eta))
    return out


def random_search(df: DataFrame, spec: CohortSpec, model: str, n_trials: int = 18, n_folds: int = 3, fraction: float = 0.10,
                  seed: int = 42, eta: int = 3, space: dict | None = None, parallelism: int = 4,
                  build: Callable = build_scorer, fold_seed: int | None = None) -> DataFrame:
    """One row for each trial: ``trial, params`` (JSON), ``folds`` (how many it ran
    on), ``precision_at_k`` (mean over them), ``best``.

    The best trial is the one with the highest mean among those that ran on all folds;
    ties go to the smaller trial number."""
    trials = draw_trials(space or SPACES[model], n_trials, seed)
    folded = cut_lineage(stratified_folds(df, spec.label, spec.id, n_folds, seed if fold_seed is None else fold_seed))

    def run(task: tuple[int, int]) -> float:
        trial, fold = task
        train = folded.filter(F.col("fold") != fold).drop("fold")
        test = folded.filter(F.col("fold") == fold).drop("fold")
        scorer = build(model, spec, **{model: trials[trial]}).fit(train)
        return float(topk_metrics(scorer.score(test, "_score"), spec.label, "_score", spec.id, fraction).first()["precision_at_k"])

    got: dict[int, list[float]] = {i: [] for i in range(n_trials)}
    alive = list(range(n_trials))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for n, folds in halving(n_trials, n_folds, eta):
            alive = ranked(got, alive)[:n]
            tasks = [(t, f) for t in alive for f in folds]
            for (t, _), p in zip(tasks, pool.map(run, tasks), strict=True):
                got[t].append(p)
    whole = ranked(got, [t for t in alive if len(got[t]) == n_folds])
    rows = [(t, json.dumps(trials[t], sort_keys=True), len(got[t]), sum(got[t]) / len(got[t]), t == whole[0]) for t in got]
    return df.sparkSession.createDataFrame(rows, "trial int, params string, folds int, precision_at_k double, best boolean")


def ranked(got: dict[int, list[float]], trials: Sequence[int]) -> list[int]:
    """Trials by falling mean, then number; those without a result keep their order."""
    return sorted(trials, key=lambda t: (-(sum(got[t]) / len(got[t])) if got[t] else 0.0, t))


def best_params(result: DataFrame) -> dict:
    return json.loads(result.where("best").first()["params"])
