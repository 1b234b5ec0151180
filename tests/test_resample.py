"""Fixed-size resampling against plain resampling of rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caprank.operators import resample
from caprank.operators.bootstrap import bootstrap_difference, bootstrap_metric

NAN = float("nan")


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, y int, a double, b double")


def rows_of(n, seed, odd=True):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n).round(1), rng.integers(0, 5, n).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-a))).astype(int)
    rows = [(i, int(y[i]), float(a[i]), float(b[i])) for i in range(n)]
    if odd:
        values = [None, NAN, math.inf, -math.inf]
        rows = [(i, y, values[i % 4] if i % 9 == 0 else x, values[i % 4] if i % 11 == 0 else z) for i, y, x, z in rows]
    return rows


def order(rows, col):
    """Row numbers in library order: NaN, +inf, ... -inf, null; then ids."""
    def key(i):
        v = rows[i][col]
        if v is None:
            return (2, 0.0, rows[i][0])
        return (0, 0.0, rows[i][0]) if math.isnan(v) else (1, -v, rows[i][0])

    return sorted(range(len(rows)), key=key)


def plain(rows, col, k, counts):
    """(positives within k, positives) of drawn counts."""
    left, tp = k, 0
    for i in order(rows, col):
        take = min(left, counts[i])
        tp, left = tp + take * rows[i][1], left - take
    return tp, sum(c * r[1] for c, r in zip(counts, rows))


def ks(a, b):
    both = np.sort(np.concatenate((a, b)))
    return np.abs(np.searchsorted(np.sort(a), both, side="right") / len(a)
                  - np.searchsorted(np.sort(b), both, side="right") / len(b)).max()


def test_binomial_by_inverse_distribution():
    for m, p in ((1, 0.3), (7, 0.5), (40, 0.02), (60, 0.9)):
        cdf = np.cumsum([math.comb(m, x) * p**x * (1 - p)**(m - x) for x in range(m + 1)])
        for u in (1e-9, 0.001, 0.2, 0.5, 0.77, 0.999):
            assert resample.binomial(m, p, u) == int(np.searchsorted(cdf, u, side="right"))
    assert (resample.binomial(9, 0.0, 0.5), resample.binomial(9, 1.0, 0.5), resample.binomial(0, 0.5, 0.5)) == (0, 9, 0)
    big = [resample.binomial(10**9, 0.25, u) for u in np.linspace(0.01, 0.99, 99)]
    assert abs(np.mean(big) - 2.5e8) < 50 and big == sorted(big)


def test_uniforms_and_draws_are_even():
    u = resample.uniform(resample.node_keys(42, np.arange(20_000), 3))
    assert abs(u.mean() - 0.5) < 0.01 and abs(u.var() - 1 / 12) < 0.003 and len(set(u.tolist())) == 20_000
    x = resample.draws(resample.node_keys(42, 7, 1), np.arange(50_000)) * np.uint64(10) >> np.uint64(32)
    assert np.abs(np.bincount(x.astype(int)) - 5000).max() < 350


def test_all_rows_in_the_window_are_plain_draws(spark):
    rows = rows_of(150, 1)
    got = resample.replicates(frame(spark, rows), "y", {"a": "a", "b": "b"}, "id", 0.1, 40, seed=5, width=1000).orderBy("_b").collect()
    index = order(rows, 2)  # window rows are numbered in the order of the first score
    for r in got:
        at = resample.draws(resample.node_keys(5, r["_b"], 0), np.arange(150)) * np.uint64(150) >> np.uint64(32)
        counts = [0] * 150
        for x in at.tolist():
            counts[index[int(x)]] += 1
        tp_a, positives = plain(rows, 2, 15, counts)
        assert (r["tp_a"], r["tp_b"], r["positives"]) == (tp_a, plain(rows, 3, 15, counts)[0], positives)
        assert r["precision_at_k_a"] == tp_a / 15 and r["recall_at_k_a"] == pytest.approx(tp_a / positives)
        assert r["lift_at_k_a"] == pytest.approx(tp_a / 15 / (positives / 150))


@pytest.mark.parametrize("n, fraction", [(400, 0.1), (3000, 0.05), (50, 0.5)])
def test_same_distribution_as_a_plain_multinomial(spark, n, fraction):
    rows = rows_of(n, n)
    k, rng = math.ceil(fraction * n), np.random.default_rng(3)
    reps = resample.replicates(frame(spark, rows), "y", {"a": "a", "b": "b"}, "id", fraction, 2000).toPandas()
    want = {"tp_a": [], "tp_b": [], "positives": []}
    y = np.array([r[1] for r in rows])
    places = {c: np.array(order(rows, j)) for c, j in (("tp_a", 2), ("tp_b", 3))}
    for _ in range(2000):
        counts = rng.multinomial(n, np.full(n, 1 / n))
        want["positives"].append(counts @ y)
        for c, o in places.items():
            before = np.cumsum(counts[o]) - counts[o]
            want[c].append(np.clip(k - before, 0, counts[o]) @ y[o])
    for c, values in want.items():
        assert ks(reps[c].to_numpy(), np.array(values)) < 0.055  # the 0.5 % level of two samples of 2,000
    both = np.corrcoef(reps["tp_a"], reps["tp_b"])[0, 1]
    assert abs(both - np.corrcoef(want["tp_a"], want["tp_b"])[0, 1]) < 0.08


def test_one_result_at_every_size_with_null_and_nan_scores(spark):
    df = frame(spark, rows_of(2500, 4)).cache()
    small = resample.replicates(df, "y", {"a": "a", "b": "b"}, "id", 0.1, 60).orderBy("_b").collect()
    large = resample.replicates(df, "y", {"a": "a", "b": "b"}, "id", 0.1, 60, exact_limit=100).orderBy("_b").collect()
    assert small == large
    again = resample.replicates(df.repartition(7), "y", {"a": "a", "b": "b"}, "id", 0.1, 60).orderBy("_b").collect()
    assert small == again
    one = frame(spark, [(i, 1, None, NAN) for i in range(300)])  # nothing but ties
    assert {r["tp_a"] for r in resample.replicates(one, "y", {"a": "a"}, "id", 0.1, 10, exact_limit=20).collect()} == {30}


def test_a_narrow_window_is_widened(spark):
    df = frame(spark, rows_of(1000, 6, odd=False))
    got = resample.replicates(df, "y", {"a": "a"}, "id", 0.1, 200, width=1).toPandas()
    wide = resample.replicates(df, "y", {"a": "a"}, "id", 0.1, 200).toPandas()
    assert len(got) == 200 and abs(got["tp_a"].mean() - wide["tp_a"].mean()) < 3


def test_edge_budgets_and_labels(spark):
    df = frame(spark, [(i, 0, float(i), 0.0) for i in range(40)])
    got = resample.replicates(df, "y", {"a": "a"}, "id", 1.0, 20).collect()
    assert {(r["tp_a"], r["positives"], r["recall_at_k_a"], r["lift_at_k_a"]) for r in got} == {(0, 0, 0.0, 0.0)}
    ones = frame(spark, [(0, 1, 1.0, 1.0)])
    assert {r["tp_a"] for r in resample.replicates(ones, "y", {"a": "a"}, "id", 0.1, 5).collect()} == {1}
    with pytest.raises(ValueError, match="no budget"):
        resample.replicates(frame(spark, []), "y", {"a": "a"}, "id", 0.1, 5)


def test_intervals_of_four_metrics_against_plain_resampling(spark):
    rows = rows_of(600, 9, odd=False)
    got = {r["metric"]: r for r in resample.metric_intervals(frame(spark, rows), "y", "a", "id", 0.1, 2000,
                                                             metrics=(*resample.METRICS, "average_precision", "roc_auc")).collect()}
    y, a = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    o = np.lexsort((np.arange(600), -a))
    steps = np.flatnonzero(np.concatenate(([True], a[o][1:] != a[o][:-1])))

    def metrics(counts):
        c, p = counts[o], counts[o] * y[o]
        tp = np.clip(60 - (np.cumsum(c) - c), 0, c) @ y[o]
        total = p.sum()
        ps, cs = np.add.reduceat(p, steps), np.add.reduceat(c, steps)
        hits, seen = np.cumsum(ps), np.cumsum(cs)
        ap = (ps * np.divide(hits, seen, out=np.zeros(len(ps)), where=seen > 0)).sum() / total
        neg = cs - ps
        auc = (ps * (neg.sum() - np.cumsum(neg) + neg / 2)).sum() / (total * neg.sum())
        return tp / 60, tp / total, tp / 60 / (total / 600), ap, auc

    rng = np.random.default_rng(1)
    many = np.array([metrics(rng.multinomial(600, np.full(600, 1 / 600))) for _ in range(4000)])
    point = metrics(np.ones(600, dtype=int))
    for j, m in enumerate((*resample.METRICS, "average_precision", "roc_auc")):
        lo, hi = np.percentile(many[:, j], [2.5, 97.5])
        assert got[m]["point"] == pytest.approx(point[j])
        assert got[m]["ci_low"] == pytest.approx(lo, abs=0.12 * (hi - lo)) and got[m]["ci_high"] == pytest.approx(hi, abs=0.12 * (hi - lo))


def test_ladder_of_ranges_keeps_all_rows_and_is_close(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.random() < x), float(x), 0.0) for i, x in enumerate(rng.random(4000))]
    df = frame(spark, rows)
    p, c = resample.ladder(df, "y", "a", "id")
    assert len(c) == 4000 and c.sum() == 4000
    p2, c2 = resample.ladder(df, "y", "a", "id", steps=200)
    assert 190 <= len(c2) <= 201 and c2.sum() == 4000 and p2.sum() == p.sum() and c2.max() <= 25
    exact = resample.average_precision_of(p[None], c[None])[0]
    assert resample.average_precision_of(p2[None], c2[None])[0] == pytest.approx(exact, abs=0.01)
    assert list(p2[:3].cumsum()) == [p[:n].sum() for n in c2[:3].cumsum()]
    odd = frame(spark, rows_of(300, 5))
    p, c = resample.ladder(odd, "y", "a", "id")
    assert c.sum() == 300
    none = frame(spark, [(i, 0, float(i), 0.0) for i in range(30)])
    point, values = resample.ladder_replicates(none, "y", "a", "id", resample.average_precision_of, 20)
    assert math.isnan(point) and np.isnan(values).all()


def test_ladder_of_ranges_has_exact_bounds_without_laying_out_positions(spark, monkeypatch):
    def laid_out(*_, **__):
        raise AssertionError("positions as literals fill the driver's memory")

    monkeypatch.setattr(resample, "find_cuts", laid_out)
    for n, steps in ((3000, 64), (1500, 37), (999, 200)):
        rng = np.random.default_rng(n)
        rows = [(i, i % 3 % 2, NAN if i % 50 == 7 else None if i % 41 == 1 else float(x), 0.0) for i, x in
                enumerate(np.where(rng.random(n) < 0.3, 2.0, rng.normal(size=n)))]
        places = order(rows, 2)
        value = [2e9 if rows[i][2] is not None and math.isnan(rows[i][2]) else -2e9 if rows[i][2] is None else rows[i][2] for i in places]
        bounds = np.array(sorted({value[max(1, round(i * n / steps)) - 1] for i in range(1, steps)}))
        of = len(bounds) - np.searchsorted(bounds, value, side="right")
        want = [(sum(rows[i][1] for i, s in zip(places, of) if s == step), int((of == step).sum())) for step in sorted(set(of))]
        p, c = resample.ladder(frame(spark, rows), "y", "a", "id", steps=steps)
        assert list(zip(p.tolist(), c.tolist())) == want


def whole_order(rows, col, counts):
    """(average precision, ROC area) of drawn counts, equal scores as one step."""
    steps = {}
    for place, i in enumerate(order(rows, col)):
        v = rows[i][col]
        key = "null" if v is None else "nan" if math.isnan(v) else v
        p, c = steps.get(key, (0, 0))
        steps[key] = (p + counts[i] * rows[i][1], c + counts[i])
    p, c = (np.array(x, dtype=float) for x in zip(*steps.values()))
    hits, seen, q = np.cumsum(p), np.cumsum(c), c - p
    ap = (p * np.divide(hits, seen, out=np.zeros(len(p)), where=seen > 0)).sum() / p.sum()
    return ap, (p * (q.sum() - np.cumsum(q) + q / 2)).sum() / (p.sum() * q.sum())


def test_no_scores_are_tied_beyond_one_block(spark):
    rng = np.random.default_rng(12)
    x = rng.random(6000)
    rows = [(i, int(rng.random() < v), float(v), 0.0) for i, v in enumerate(x.tolist())]
    df = frame(spark, rows)
    p, c = resample.ladder(df, "y", "a", "id")
    assert len(p) == 6000 and set(c.tolist()) == {1}
    exact = whole_order(rows, 2, [1] * 6000)
    got = {r["metric"]: r for r in resample.metric_intervals(df, "y", "a", "id", n_iter=40, metrics=("average_precision", "roc_auc")).collect()}
    for m, want in zip(("average_precision", "roc_auc"), exact):
        assert got[m]["point"] == pytest.approx(want, abs=1e-12) and got[m]["ci_low"] < want < got[m]["ci_high"]


def test_blocks_draw_the_same_distribution_as_rows(spark):
    rows = rows_of(700, 21)
    df = frame(spark, rows).repartition(5)
    both = [resample.average_precision_of, resample.auc_of]
    found = resample.ladder_values(df, "y", "a", both, 1500, seed=3, block=16)
    again = resample.ladder_values(df.repartition(3), "y", "a", both, 1500, seed=3, block=16)
    once = resample.ladder_values(df, "y", "a", both, 1500, seed=3, block=4096)
    rng, n = np.random.default_rng(8), len(rows)
    plain_draws = np.array([whole_order(rows, 2, rng.multinomial(n, np.full(n, 1 / n)).tolist()) for _ in range(1500)])
    for j, want in enumerate(whole_order(rows, 2, [1] * n)):
        assert found[j][0] == pytest.approx(want, abs=1e-12) and once[j][0] == pytest.approx(want, abs=1e-12)
        assert len(found[j][1]) == 1500 and np.array_equal(found[j][1], again[j][1])
        for values in (found[j][1], once[j][1]):
            assert ks(values, plain_draws[:, j]) < 0.063  # the 0.5 % level of two samples of 1,500
    both_ways = np.corrcoef(found[0][1], found[1][1])[0, 1]  # the metrics share their draws
    assert abs(both_ways - np.corrcoef(plain_draws[:, 0], plain_draws[:, 1])[0, 1]) < 0.05


def test_shares_of_blocks_add_up_to_the_metric():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 4, (9, 50))
    positives = rng.integers(0, rows + 1)
    for f in (resample.average_precision_of, resample.auc_of):
        parts = 0
        for lo, hi in ((0, 7), (7, 8), (8, 50)):
            above = positives[:, :lo].sum(axis=1), rows[:, :lo].sum(axis=1)
            parts = parts + f(positives[:, lo:hi], rows[:, lo:hi], above, (positives.sum(axis=1), rows.sum(axis=1)))
        assert parts == pytest.approx(f(positives, rows))


def test_blocks_without_a_label_and_scores_of_one_order_value(spark):
    none = frame(spark, [(i, 0, float(i), 0.0) for i in range(30)])
    point, values = resample.ladder_replicates(none, "y", "a", "id", resample.average_precision_of, 20, block=4)
    assert math.isnan(point) and len(values) == 20 and np.isnan(values).all()
    tiny = [(i, i % 2, x, 0.0) for i, x in enumerate([0.0, 5e-324, 1e-323, -0.0, 1.0, 2.0, -1.0])]
    got = resample.ladder_values(frame(spark, tiny), "y", "a", [resample.average_precision_of, resample.auc_of], 5, block=2)
    for j, want in enumerate(whole_order(tiny, 2, [1] * 7)):
        assert got[j][0] == pytest.approx(want, abs=1e-12)


def test_bootstrap_metrics_and_methods(spark):
    df = frame(spark, rows_of(500, 8, odd=False)).cache()
    for metric in resample.METRICS:
        r = bootstrap_metric(df, "y", "a", "id", 0.1, metric=metric).first()
        assert r["metric"] == metric and r["ci_low"] <= r["point"] <= r["ci_high"]
        d = bootstrap_difference(df, "y", "a", "b", "id", 0.1, metric=metric).first()
        assert d["ci_low"] <= d["point"] <= d["ci_high"] and d["excludes_zero"] == (d["ci_low"] > 0 or d["ci_high"] < 0)
    p, q = (bootstrap_metric(df, "y", "a", "id", 0.1, n_iter=400, method=m).first() for m in ("fixed", "poisson"))
    assert p["point"] == q["point"] and abs(p["ci_low"] - q["ci_low"]) < 0.1
    with pytest.raises(ValueError, match="no metric"):
        bootstrap_metric(df, "y", "a", "id", metric="f1")
    with pytest.raises(ValueError, match="precision at k alone"):
        bootstrap_metric(df, "y", "a", "id", n_iter=5, metric="recall_at_k", method="poisson")


def test_poisson_with_null_and_nan_scores_at_any_size(spark):
    df = frame(spark, rows_of(1200, 3)).cache()
    a, b = (bootstrap_metric(df, "y", "a", "id", 0.1, n_iter=30, method="poisson", exact_limit=limit).first() for limit in (10**6, 100))
    assert a == b
