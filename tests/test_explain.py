import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from caprank.operators import explain as E
from caprank.operators.scorers import GBTScorer, LogisticScorer
from fixtures import cohort_spec, model_frame


@pytest.fixture(scope="module")
def gbt(spark):
    df = model_frame(spark, 500, seed=5, planted=True)
    return GBTScorer(cohort_spec(), max_iter=15, early_stopping=False, min_instances=10).fit(df), df


def test_attributions_are_additive_and_exact(spark, gbt):
    g, df = gbt
    trees = E.read_trees(spark, g.model.stages[-1])
    pdf = g.model.transform(df.limit(50)).select(
        vector_to_array("features").alias("x"), vector_to_array("rawPrediction").alias("r")).toPandas()
    X = np.vstack(pdf["x"].to_numpy())
    raw = np.vstack(pdf["r"].to_numpy())[:, 1]
    assert np.abs(E.margin(trees, X) - raw).max() < 1e-9
    phi, base = E.tree_shap(trees, X)
    assert np.abs(phi.sum(1) + base - raw).max() < 1e-9


def random_tree(rng, depth, n_features):
    """Node table of a random tree; some features are split more than once."""
    nodes = {}

    def grow(d, cover):
        nid = len(nodes)
        nodes[nid] = None
        if d == 0 or cover < 4 or rng.random() < 0.15:
            nodes[nid] = {"pred": float(rng.normal()), "cover": float(cover), "left": -1, "right": -1, "feature": -1, "split": [], "ncat": -1}
            return nid
        part = int(rng.integers(1, cover))
        f = int(rng.integers(n_features))
        left, right = grow(d - 1, part), grow(d - 1, cover - part)
        categories = f == 0
        split = [float(x) for x in range(4) if rng.random() < 0.5] if categories else [float(rng.normal())]
        nodes[nid] = {"pred": 0.0, "cover": float(cover), "left": left, "right": right, "feature": f, "split": split,
                      "ncat": 4 if categories else -1}
        return nid

    grow(depth, 200)
    return nodes


def value(nodes, known, x, nid=0):
    """Path-dependent value of a coalition: follow the row at splits on known
    features, weigh both children by cover elsewhere."""
    nd = nodes[nid]
    if nd["left"] < 0:
        return nd["pred"]
    if nd["feature"] in known:
        v = x[nd["feature"]]
        left = v <= nd["split"][0] if nd["ncat"] < 0 else v in nd["split"]
        return value(nodes, known, x, nd["left" if left else "right"])
    return sum(nodes[nd[side]]["cover"] / nd["cover"] * value(nodes, known, x, nd[side]) for side in ("left", "right"))


def test_attributions_equal_brute_force_shapley_values():
    from itertools import combinations
    from math import factorial

    rng = np.random.default_rng(7)
    for p in (2, 4, 5):
        tables = [random_tree(rng, 5, p) for _ in range(3)]
        weights = [1.0, 0.1, 0.7]
        X = np.column_stack([rng.integers(0, 4, 12), *rng.normal(size=(p - 1, 12))]).astype(float)
        phi, base = E.tree_shap([E._compile_tree({"nodes": t, "weight": w}) for t, w in zip(tables, weights)], X)
        assert base == pytest.approx(sum(w * value(t, set(), X[0]) for t, w in zip(tables, weights)))
        for row, got in zip(X, phi):
            for i in range(p):
                others = [j for j in range(p) if j != i]
                want = 0.0
                for size in range(p):
                    for s in combinations(others, size):
                        share = factorial(size) * factorial(p - size - 1) / factorial(p)
                        want += share * sum(w * (value(t, {*s, i}, row) - value(t, set(s), row)) for t, w in zip(tables, weights))
                assert got[i] == pytest.approx(want, abs=1e-12)


def test_importance_sorted_nonnegative(gbt):
    g, df = gbt
    att = E.tree_attributions(g, df, ["id"])
    imp = E.global_importance(att, g.feature_names).collect()
    vals = [r["mean_abs_attribution"] for r in imp]
    assert len(imp) > 20 and all(v >= 0 for v in vals) and vals == sorted(vals, reverse=True)


def test_reasons_shape_and_order(gbt):
    g, df = gbt
    att = E.tree_attributions(g, df.limit(30), ["id"])
    rows = E.top_reasons(att, g.feature_names, 3).collect()
    assert len(rows) == 30
    for r in rows:
        assert r["reason_1_value"] >= r["reason_2_value"] >= r["reason_3_value"]
        assert r["reason_1"] in g.feature_names


def test_linear_closed_form_additive(spark):
    df = model_frame(spark, 400, seed=9, planted=True)
    lr = LogisticScorer(cohort_spec()).fit(df)
    att = E.linear_attributions(lr, df, df, ["id"])
    scored = lr.model.transform(df).select("id", vector_to_array("rawPrediction")[1].alias("logit"))
    j = att.join(scored, "id").select(
        (F.aggregate("attributions", F.lit(0.0), lambda a, b: a + b) + F.col("base_value") - F.col("logit")).alias("d"))
    assert j.agg(F.max(F.abs("d"))).first()[0] < 1e-9
