"""Random search: seeded trials, shared folds, early stopping."""

import pytest
from pyspark.sql import functions as F

from caprank.operators import search
from caprank.operators.search import Choice, LogUniform, Uniform, Whole, best_params, draw_trials, halving, random_search
from fixtures import cohort_spec, model_frame


def test_trials_are_those_of_the_seed():
    space = {"a": Uniform(0, 1), "b": LogUniform(1e-3, 1e3), "c": Whole(2, 5), "d": Choice(("x", "y"))}
    first = draw_trials(space, 40, 7)
    assert first == draw_trials(space, 40, 7) and first[:10] == draw_trials(space, 10, 7) and first != draw_trials(space, 40, 8)
    assert all(0 <= t["a"] <= 1 and 1e-3 <= t["b"] <= 1e3 and t["c"] in (2, 3, 4, 5) and t["d"] in ("x", "y") for t in first)
    assert {t["c"] for t in first} == {2, 3, 4, 5} and sum(t["b"] < 1 for t in first) in range(10, 31)


def test_rungs_of_the_search():
    assert halving(18, 3) == [(18, [0]), (6, [1]), (2, [2])]
    assert halving(2, 3) == [(2, [0, 1, 2])]
    assert halving(9, 5) == [(9, [0]), (3, [1, 2, 3, 4])]
    for n, folds in ((1, 1), (7, 2), (50, 6)):
        rungs = halving(n, folds)
        assert rungs[0][0] == n and [f for _, fs in rungs for f in fs] == list(range(folds))


class Noise:
    """A scorer whose parameter decides how much of the label it knows."""

    fits: list = []

    def __init__(self, spec, q):
        self.spec, self.q = spec, q

    def fit(self, df):
        Noise.fits.append(self.q)
        return self

    def score(self, df, out):
        known = F.when((F.xxhash64("id", F.lit(3)) % 100 + 100) % 100 < self.q * 100, F.col("dropout")).otherwise(0)
        return df.withColumn(out, known.cast("double"))


def build(name, spec, **params):
    return Noise(spec, **params[name])


def test_best_trial_is_found_again_and_poor_ones_stop(spark):
    df = model_frame(spark, 600, seed=5, planted=True).cache()
    spec, space = cohort_spec(), {"q": Uniform(0, 1)}
    Noise.fits = []
    a = random_search(df, spec, "noise", 9, 3, 0.2, seed=3, space=space, build=build)
    assert len(Noise.fits) == 9 + 3 * 2  # nine on one fold, three of them on the others
    rows = {r["trial"]: r for r in a.collect()}
    assert sorted(r["folds"] for r in rows.values()) == [1] * 6 + [3] * 3
    b = random_search(df.repartition(5), spec, "noise", 9, 3, 0.2, seed=3, space=space, build=build, parallelism=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    best = [r for r in rows.values() if r["best"]]
    assert len(best) == 1 and best[0]["precision_at_k"] == max(r["precision_at_k"] for r in rows.values() if r["folds"] == 3)
    assert best_params(a) == draw_trials(space, 9, 3)[best[0]["trial"]]
    assert all(r["precision_at_k"] >= 0 for r in rows.values())


def test_search_over_a_real_rung(spark):
    df = model_frame(spark, 400, seed=6, planted=True).cache()
    out = random_search(df, cohort_spec(), "logistic", 2, 2, seed=1, parallelism=2)
    assert out.count() == 2 and out.where("best and folds = 2").count() == 1
    with pytest.raises(KeyError):
        random_search(df, cohort_spec(), "passrate_baseline", 2, 2)
    assert set(search.SPACES) == {"logistic", "gbt"}
