"""Null, NaN and infinite scores and null partitions: the same rows and ranks
whether an input counts as small or as large."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caprank.operators.profile import histogram
from caprank.operators.ranking import find_cut, rank_rows, rank_within
from caprank.operators.validate import Rules, coerce, validation_report


@pytest.fixture(scope="module")
def odd(spark):
    d = spark.range(6000).withColumn("u", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1000)) / 10.0)
    score = (F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 97 == 1, F.lit(float("nan")))
             .when(F.col("id") % 89 == 2, F.lit(float("-inf"))).when(F.col("id") % 83 == 3, F.lit(float("inf"))).otherwise(F.col("u")))
    part = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("b"))
    return d.select("id", score.cast("double").alias("score"), part.alias("part")).cache()


def expected(d, *keys):
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("score"), F.asc("id"))
    return {r["id"]: r["rank"] for r in d.withColumn("rank", F.row_number().over(w)).collect()}


@pytest.mark.parametrize("limit", [200_000, 500])
def test_ranks_of_odd_scores(odd, limit):
    got = rank_rows(odd, "score", "id", exact_limit=limit, target_bucket_rows=300)
    assert {r["id"]: r["rank"] for r in got.collect()} == expected(odd)


@pytest.mark.parametrize("limit", [200_000, 500])
def test_ranks_within_null_partitions(odd, limit):
    got = rank_within(odd, "part", "score", "id", exact_limit=limit, target_bucket_rows=300)
    assert {r["id"]: r["rank"] for r in got.collect()} == expected(odd, "part")


@pytest.mark.parametrize("limit", [200_000, 500])
def test_cuts_among_odd_scores(odd, limit):
    rank = expected(odd)
    for k in (1, 30, 100, 140, 2500, 5360, 5400, 5500, 6000):
        cut = find_cut(odd, "score", "id", k, exact_limit=limit, n_buckets=16)
        inside = {r["id"] for r in odd.where(cut.contains("score", "id")).select("id").collect()}
        assert inside == {i for i, r in rank.items() if r <= k}


def test_histogram_ignores_missing_values(spark):
    d = spark.createDataFrame([(float(i), 1) for i in range(10)] + [(None, 1)] * 10 + [(float("nan"), 1)], "x double, y int")
    rows = histogram(d, "x", "y", 5).collect()
    assert sum(r["n_rows"] for r in rows) == 10 and max(r["n_rows"] for r in rows) == 2


def test_report_and_coercion_agree(spark):
    d = spark.createDataFrame([("1", "2.5"), ("1.0", "x"), ("1.5", None), ("3000000000", "1e3"), (None, "7")], "k string, v string")
    rules = Rules(int_columns=("k",), float_columns=("v",), null_columns=())
    report = {(r["check"], r["column"]): r["n_violations"] for r in validation_report(d, rules).collect()}
    assert report["coerce_int", "k"] == 1 and report["coerce_float", "v"] == 1
    rows = coerce(d, rules).collect()
    assert [r["k"] for r in rows] == [1, 1, None, 3_000_000_000, None]
    assert [r["v"] for r in rows] == [2.5, None, None, 1000.0, 7.0]


@pytest.mark.parametrize("limit", [200_000, 400])
def test_several_cuts_of_several_groups(odd, limit):
    from caprank.operators.ranking import find_cuts

    rank = expected(odd, "part")
    part = {r["id"]: r["part"] for r in odd.collect()}
    counts = {g: sum(p == g for p in part.values()) for g in (None, "a", "b")}
    wanted = {g: [1, n // 3, n // 2, n] for g, n in counts.items()}
    cuts = find_cuts(odd, "score", "id", wanted, counts, by="part", exact_limit=limit, n_buckets=16)
    for (g, k), cut in cuts.items():
        mine = odd.where(F.col("part").eqNullSafe(F.lit(g)) & cut.contains("score", "id"))
        assert {r["id"] for r in mine.select("id").collect()} == {i for i, r in rank.items() if part[i] == g and r <= k}


def test_quantiles_take_few_jobs(spark):
    from caprank.operators.ranking import exact_quantiles

    d = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7).alias("x")).cache()
    x = sorted(r["x"] for r in d.collect())
    probs = [i / 10 for i in range(1, 10)]
    sc = spark.sparkContext
    sc.setJobGroup("quantiles", "quantiles")
    got = exact_quantiles(d, "x", probs, exact_limit=1000, n_buckets=64)
    jobs = len(sc.statusTracker().getJobIdsForGroup("quantiles"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    for p, g in zip(probs, got, strict=True):
        h = p * (len(x) - 1)
        lo = int(h)
        assert g == pytest.approx(x[lo] + (h - lo) * (x[min(lo + 1, len(x) - 1)] - x[lo]))
    assert jobs <= 12


@pytest.mark.parametrize("limit", [200_000, 500])
def test_running_totals_with_null_partitions(odd, limit):
    from caprank.operators.prefix import running_totals

    d = odd.select("part", F.col("id").alias("at"), F.lit(1).alias("one"))
    got = running_totals(d, "at", ["one"], ["part"], exact_limit=limit, n_buckets=7)
    w = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["at"]: r["x"] for r in d.withColumn("x", F.sum("one").over(w)).collect()}
    assert {r["at"]: r["cum_one"] for r in got.collect()} == want
