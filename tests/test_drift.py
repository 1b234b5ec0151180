import pytest
from pyspark.sql import functions as F

from caprank.operators.drift import chi2_sf, volume_check
from caprank.plans.drift import drift_run
from fixtures import u


def normal(seed, name, mu, sd):
    # Box-Muller from two hash uniforms
    a, b = u(seed, name + "1"), u(seed, name + "2")
    return F.lit(mu) + F.lit(sd) * F.sqrt(-2 * F.log(F.greatest(a, F.lit(1e-12)))) * F.cos(2 * 3.141592653589793 * b)


def frame(spark, n, seed, shifted=False):
    df = spark.range(n)
    if not shifted:
        return df.select(normal(seed, "g", 120, 20).alias("grade"), normal(seed, "a", 25, 6).alias("age"),
                         normal(seed, "s", 50, 10).alias("score"))
    return df.select(normal(seed, "g", 170, 20).alias("grade"),
                     (F.floor(u(seed, "a") * 30) + 35).cast("double").alias("age"),
                     F.floor(u(seed, "u") * 7).cast("int").alias("units"))


def test_same_distribution_no_alert(spark):
    rep, verdict = drift_run(frame(spark, 2000, 1), frame(spark, 2000, 2))
    v = verdict.first()
    assert not v["alert"] and v["n_columns_compared"] == 3


def test_shifted_alerts_and_lists_grade(spark):
    rep, verdict = drift_run(frame(spark, 600, 1), frame(spark, 400, 3, shifted=True))
    v = verdict.first()
    assert v["n_columns_compared"] == 2  # units is not in the reference
    assert v["alert"] and "grade" in v["drifted_columns"]


def test_volume(spark):
    df = spark.range(885).withColumn("s", F.when(F.col("id") < 89, 1.0).otherwise(0.0))
    assert not volume_check(df, "s", 1.0, 0.10, 0.30).first()["alert"]
    df = spark.range(885).withColumn("s", F.when(F.col("id") < 450, 1.0).otherwise(0.0))
    assert volume_check(df, "s", 1.0, 0.10, 0.30).first()["alert"]
    assert volume_check(df, "s", 1.0, 0.10, 0.30, mode="relative").first()["alert"]


def test_chi2_survival_values(spark):
    rows = spark.createDataFrame([(3.841458820694124, 1), (1.442083, 4), (30.0, 4)], "x double, dof long")
    p = [r[0] for r in rows.select(chi2_sf(F.col("x"), F.col("dof"))).collect()]
    assert p[0] == pytest.approx(0.05, abs=1e-9)
    assert p[1] == pytest.approx(0.8368, abs=1e-3)
    assert p[2] < 1e-5


def test_decimals_dates_and_times_are_ordered(spark):
    d = spark.range(400).select((F.col("id") / 7).cast("decimal(12,2)").alias("amount"),
                                F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
                                F.timestamp_seconds("id").alias("at"), F.when(F.col("id") % 2 == 0, float("nan")).otherwise(1.0).alias("gap"))
    from caprank.operators.drift import drift_report

    rows = {r["column"]: r for r in drift_report(d.where("amount < 30"), d.where("amount >= 30")).collect()}
    assert {r["method"] for r in rows.values()} == {"ks"}
    assert all(rows[c]["statistic"] == 1.0 for c in ("amount", "day", "at")) and rows["gap"]["statistic"] == 0.0
