import pytest
from pyspark.sql import functions as F

from caprank.operators.inference import rank_cohort
from caprank.operators.scorers import GBTScorer
from fixtures import cohort_spec, model_frame


@pytest.fixture(scope="module")
def fitted(spark):
    df = model_frame(spark, 800, seed=21, planted=True)
    return GBTScorer(cohort_spec(), max_iter=20, min_instances=10).fit(df), df


def test_list_size_contract_and_order(fitted):
    g, df = fitted
    out = rank_cohort(g, df.drop("dropout"), 0.10, "id", add_reasons=True)
    rows = out.orderBy("rank").collect()
    assert len(rows) == 80
    assert out.columns == ["student_id", "risk_score", "rank", "reason_1", "reason_1_value", "reason_2",
                           "reason_2_value", "reason_3", "reason_3_value"]
    scores = [r["risk_score"] for r in rows]
    assert scores == sorted(scores, reverse=True)
    assert [r["rank"] for r in rows] == list(range(1, 81))


def test_no_reasons_and_custom_id(fitted):
    g, df = fitted
    df2 = df.withColumn("student_code", F.col("id") + 10_000)
    out = rank_cohort(g, df2, 0.10, "student_code", add_reasons=False)
    assert out.columns == ["student_id", "risk_score", "rank"]
    ids = [r["student_id"] for r in out.collect()]
    assert min(ids) >= 10_000 and len(ids) == 80
