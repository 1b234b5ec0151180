import math

import pytest
from pyspark.sql import functions as F

from caprank.operators.crossval import cross_val_precision
from caprank.operators.gate import promotion_decision
from caprank.operators.metrics import evaluate_ladder, evaluate_model
from caprank.operators.scorers import LADDER, score_ladder
from caprank.operators.slices import slice_table
from caprank.operators.split import stratified_folds, stratified_split
from fixtures import cohort_spec, model_frame

GBT = {"gbt": {"max_iter": 40, "min_instances": 20, "seed": 42}}


@pytest.fixture(scope="module")
def ladder(spark):
    df = model_frame(spark, 1000, seed=11, planted=True)
    sp = stratified_split(df, "dropout", "id", 0.2).persist()
    train, test = sp.filter(~F.col("is_test")), sp.filter("is_test")
    wide, fitted = score_ladder(train, test, cohort_spec(), **GBT)
    return wide, fitted, test


def test_split_sizes_exact(spark):
    df = model_frame(spark, 1000, seed=11, planted=True)
    sp = stratified_split(df, "dropout", "id", 0.2)
    assert sp.filter("is_test").count() == 200
    f = stratified_folds(df, "dropout", "id", 5).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in f) == [200] * 5


def test_every_rung_finite_and_ordered(ladder):
    wide, fitted, _ = ladder
    assert list(fitted) == list(LADDER)
    for m in fitted:
        bad = wide.filter(F.isnan(f"score_{m}") | F.col(f"score_{m}").isNull()).count()
        assert bad == 0
    res = {r["model"]: r for r in evaluate_ladder(wide, "dropout", "id", {m: f"score_{m}" for m in fitted}).collect()}
    assert [res[m]["rung"] for m in LADDER] == [0, 1, 2, 3]
    assert res["passrate_baseline"]["precision_at_k"] > res["majority_baseline"]["precision_at_k"]


def test_majority_precision_near_base_rate(spark):
    from caprank.operators.metrics import topk_metrics
    from caprank.operators.scorers import MajorityScorer

    df = model_frame(spark, 1000, seed=11, planted=True)
    scored = MajorityScorer(cohort_spec()).fit(df).score(df)
    r = topk_metrics(scored, "dropout", "score", "id", 0.1).first()
    assert abs(r["precision_at_k"] - r["base_rate"]) < 0.12


def test_bundle_keys(ladder):
    wide, _, _ = ladder
    b = evaluate_model(wide, "dropout", "score_logistic", "id", 0.1, n_bootstrap=50).first().asDict()
    assert set(b) == {"precision_at_k", "precision_at_k_ci_low", "precision_at_k_ci_high", "lift_at_k",
                      "recall_at_k", "pr_auc", "brier", "base_rate"}
    assert all(v is not None and math.isfinite(v) for v in b.values())


def test_slices_invariants(ladder):
    wide, _, _ = ladder
    st = slice_table(wide, "dropout", "score_gbt", "id", ["Gender", "Debtor", "Nope"], 0.1)
    rows = st.collect()
    for s in ("Gender", "Debtor"):
        part = [r for r in rows if r["slice"] == s]
        assert sum(r["group_n"] for r in part) == 200
        assert sum(r["n_flagged"] for r in part) == 20
        for r in part:
            assert r["selection_rate"] == pytest.approx(r["n_flagged"] / r["group_n"])
            assert (r["precision_in_group"] is None) == (r["n_flagged"] == 0)
            assert r["small_slice"] == (r["group_n"] < 20)
    assert not [r for r in rows if r["slice"] == "Nope"]


def test_gate(ladder):
    wide, _, _ = ladder
    d = promotion_decision(wide, "dropout", "score_passrate_baseline", "score_majority_baseline", "id",
                           None, 0.1, n_bootstrap=100).first()
    assert len(d.asDict()) == 11
    assert d["beats_baseline"] and d["slice_gate_passed"]
    same = promotion_decision(wide, "dropout", "score_logistic", "score_logistic", "id", None, 0.1,
                              n_bootstrap=50).first()
    assert not same["promote"] and same["difference"] == 0
    strict = promotion_decision(wide, "dropout", "score_logistic", "score_majority_baseline", "id",
                                slice_table(wide, "dropout", "score_logistic", "id", ["Gender"], 0.1),
                                0.1, slice_tolerance=-1.0, n_bootstrap=50).first()
    assert not strict["slice_gate_passed"] and not strict["promote"]


def test_cross_validation_five_folds(spark):
    df = model_frame(spark, 600, seed=3, planted=True)
    r = cross_val_precision(df, cohort_spec(), ["passrate_baseline", "logistic"], 5, 0.1).collect()
    assert len(r) == 2
    assert all(len(x["cv_folds"]) == 5 and x["cv_precision_at_k_std"] >= 0 for x in r)


def test_fits_run_on_partitions_that_follow_the_rows(spark):
    from caprank.operators.scorers import GBTScorer

    sc, models = spark.sparkContext, []
    for parts in (24, 3):
        df = model_frame(spark, 300, seed=4, planted=True).repartition(parts)
        sc.setJobGroup(f"fit-{parts}", "")
        try:
            models.append(GBTScorer(cohort_spec(), max_iter=3, max_depth=2).fit(df).model.stages[-1].toDebugString)
        finally:
            sc.setJobGroup("", "")
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(f"fit-{parts}") for s in tracker.getJobInfo(j).stageIds}
        wide = [s for s in stages if (info := tracker.getStageInfo(s)) and info.numTasks == parts]
        assert stages and len(wide) <= 3  # the rows are counted and dealt out once
    assert models[0].split("\n", 1)[1] == models[1].split("\n", 1)[1]
