"""Champions of every rung: saved, registered, resolved, ranked."""

import tempfile

import pytest
from pyspark.sql import functions as F

from caprank.operators.artifact import ArtifactError, load_scorer, save_scorer
from caprank.operators.explain import linear_attributions, top_reasons
from caprank.operators.inference import rank_cohort, score_and_rank
from caprank.operators.registry import register_version, set_alias
from caprank.operators.scorers import GBTScorer, LogisticScorer, MajorityScorer, RuleScorer
from caprank.plans.inference import inference_run
from fixtures import cohort_spec, model_frame


@pytest.fixture(scope="module")
def cohort(spark):
    return model_frame(spark, 500, seed=41, planted=True).cache()


@pytest.fixture(scope="module")
def rungs(cohort):
    spec = cohort_spec()
    return {"majority_baseline": MajorityScorer(spec).fit(cohort), "passrate_baseline": RuleScorer(spec).fit(cohort),
            "logistic": LogisticScorer(spec).fit(cohort), "gbt": GBTScorer(spec, max_iter=5, min_instances=10).fit(cohort)}


@pytest.mark.parametrize("name", ["majority_baseline", "passrate_baseline", "logistic", "gbt"])
def test_round_trip_through_the_registry(spark, cohort, rungs, name):
    root, scorer = tempfile.mkdtemp(prefix="caprank-art-"), rungs[name]
    path = save_scorer(spark, scorer, f"{root}/artifacts/{name}", cohort)
    back = load_scorer(spark, path)
    assert back.name == name and back.spec == scorer.spec
    want = {r["id"]: r["s"] for r in scorer.score(cohort, "s").collect()}
    assert {r["id"]: r["s"] for r in back.score(cohort, "s").collect()} == pytest.approx(want)
    set_alias(spark, root, "m", "champion", register_version(spark, root, "m", path, "r1"))
    register_version(spark, root, "m", "/elsewhere", "r2")  # newer, but the alias decides
    scored = cohort.drop("dropout")
    got = score_and_rank(spark, root, "m", scored, add_reasons=False).orderBy("rank").collect()
    own = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:50]
    assert [(r["student_id"], r["risk_score"]) for r in got] == [(i, pytest.approx(s)) for i, s in own]
    if name == "majority_baseline":
        with pytest.raises(ValueError, match="no reasons"):
            score_and_rank(spark, root, "m", scored)
        return
    listed = inference_run(spark, cohort, None, root, "m", f"{root}/list").orderBy("rank").collect()
    direct = {r["student_id"]: r for r in rank_cohort(scorer if name != "logistic" else back, scored, 0.10, "id").collect()}
    assert [r["rank"] for r in listed] == list(range(1, 51)) and all(r["reason_1"] == direct[r["student_id"]]["reason_1"] for r in listed)
    if name == "passrate_baseline":
        assert {r["reason_1"] for r in listed} == {"pass_rate"} and all(r["reason_2"] is None for r in listed)
        assert all(r["reason_1_value"] == pytest.approx(r["risk_score"]) for r in listed)


def test_linear_reasons_need_no_training_rows(spark, cohort, rungs):
    root = tempfile.mkdtemp(prefix="caprank-art-")
    back = load_scorer(spark, save_scorer(spark, rungs["logistic"], f"{root}/a", cohort))
    top = rank_cohort(back, cohort.drop("dropout"), 0.1, "id")
    names = back.feature_names
    want = {r["id"]: r for r in top_reasons(linear_attributions(rungs["logistic"], cohort, cohort, ["id"]), names, 3).collect()}
    for r in top.collect():
        assert [r[f"reason_{j}"] for j in (1, 2, 3)] == [want[r["student_id"]][f"reason_{j}"] for j in (1, 2, 3)]
    bare = load_scorer(spark, save_scorer(spark, rungs["logistic"], f"{root}/b"))
    with pytest.raises(ValueError, match="means of its training rows"):
        rank_cohort(bare, cohort.drop("dropout"), 0.1, "id")


def test_reasons_are_given_in_many_tasks(spark, cohort, rungs):
    out = rank_cohort(rungs["gbt"], cohort.drop("dropout"), 0.5, "id")
    assert out.rdd.getNumPartitions() > 1 or "Exchange hashpartitioning(id" in out._jdf.queryExecution().toString()


def test_folders_that_are_no_artifacts(spark, rungs):
    root = tempfile.mkdtemp(prefix="caprank-art-")
    with pytest.raises(ArtifactError, match="no artifact"):
        load_scorer(spark, f"{root}/none")
    save_scorer(spark, rungs["passrate_baseline"], f"{root}/a")
    with pytest.raises(ArtifactError, match="already"):
        save_scorer(spark, rungs["passrate_baseline"], f"{root}/a")
    body = open(f"{root}/a/scorer.json").read().replace('"format": 1', '"format": 9')
    spark.createDataFrame([(body,)], "v string").coalesce(1).write.text(f"{root}/b/scorer.json")
    with pytest.raises(ArtifactError, match="format 9"):
        load_scorer(spark, f"{root}/b")
    assert F is not None
