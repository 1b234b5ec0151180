"""Hand-computed ranking vectors, ties, and bucketed-vs-window agreement."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caprank.operators.bootstrap import bootstrap_difference, bootstrap_metric, replicate_precision
from caprank.operators.metrics import average_precision, brier, topk_metrics
from caprank.operators.prefix import running_totals
from caprank.operators.ranking import find_cut, k_from_fraction, rank_rows, rank_top_k, rank_within
from fixtures import u, vectors


def test_k_from_fraction_goldens():
    assert k_from_fraction(885, 0.1) == 89
    assert k_from_fraction(1000, 0.1) == 100
    assert k_from_fraction(5, 0.1) == 1
    assert k_from_fraction(100, 0.07) == 8  # binary double arithmetic, not DECIMAL
    with pytest.raises(ValueError):
        k_from_fraction(0, 0.1)
    with pytest.raises(ValueError):
        k_from_fraction(10, 0.0)


def _p(spark, y, s, f):
    return topk_metrics(vectors(spark, y, s), "y", "score", "id", f).first()


def test_perfect_worst_partial(spark):
    assert _p(spark, [1, 1, 1] + [0] * 7, [.9, .8, .7] + [.1] * 7, .3)["precision_at_k"] == 1.0
    assert _p(spark, [1, 1, 1] + [0] * 7, [.1] * 3 + [.9, .8, .7, .6, .5, .4, .3], .3)["precision_at_k"] == 0.0
    assert _p(spark, [1, 0, 1, 0] + [0] * 5, [.9, .85, .8, .7] + [.1] * 5, .5)["precision_at_k"] == pytest.approx(.4)
    assert _p(spark, [1, 0, 1, 0, 0], [.9, .85, .8, .7, .1], .5)["precision_at_k"] == pytest.approx(2 / 3)


def test_lift_and_capped_recall(spark):
    r = _p(spark, [1, 1] + [0] * 8, [.9, .8] + [.1] * 8, .2)
    assert r["lift_at_k"] == pytest.approx(5.0)
    r = _p(spark, [1] * 10 + [0] * 90, [1.0] * 10 + [0.0] * 90, .02)
    assert r["recall_at_k"] == pytest.approx(.2)
    assert r["recall_ceiling"] == pytest.approx(.2)


def test_ties_broken_by_id(spark):
    r = _p(spark, [1, 0, 1, 0, 1, 0], [.5] * 6, .5)
    assert r["precision_at_k"] == pytest.approx(2 / 3)


def test_no_positives(spark):
    r = _p(spark, [0] * 10, [float(i) for i in range(10)], .2)
    assert r["recall_at_k"] == 0.0 and r["lift_at_k"] == 0.0


def _random(spark, n, seed=1, ties=False):
    df = spark.range(n).select(F.col("id"), (u(seed, "y") < 0.3).cast("int").alias("y"),
                               u(seed, "s").alias("score"))
    if ties:
        df = df.withColumn("score", F.floor(F.col("score") * 3) / 3)
    return df


@pytest.mark.parametrize("ties", [False, True])
def test_bucketed_cut_equals_window(spark, ties):
    df = _random(spark, 5000, ties=ties).cache()
    w = Window.orderBy(F.desc("score"), F.asc("id"))
    ref = df.withColumn("rn", F.row_number().over(w))
    for k in (1, 37, 500, 4999):
        cut = find_cut(df, "score", "id", k, exact_limit=100, n_buckets=8)
        row = ref.filter(F.col("rn") == k).first()
        assert (cut.score, cut.id) == (row["score"], row["id"])


@pytest.mark.parametrize("ties", [False, True])
def test_bucketed_rank_equals_window(spark, ties):
    df = _random(spark, 3000, ties=ties).cache()
    w = Window.orderBy(F.desc("score"), F.asc("id"))
    ref = df.withColumn("rn", F.row_number().over(w))
    got = rank_rows(df, "score", "id", rank_col="rk", exact_limit=100, target_bucket_rows=200)
    bad = got.join(ref, "id").filter(F.col("rk") != F.col("rn")).count()
    assert bad == 0
    top = rank_top_k(df, "score", "id", 0.1, exact_limit=100, target_bucket_rows=50)
    assert top.count() == 300
    assert sorted(r["rank"] for r in top.collect()) == list(range(1, 301))


def test_rank_within_hot_partition(spark):
    # one group holds most rows: it is split into buckets, ranks stay exact
    df = _random(spark, 4000, ties=True).withColumn("g", F.when(F.col("id") % 10 < 8, "hot").otherwise("cold"))
    w = Window.partitionBy("g").orderBy(F.desc("score"), F.asc("id"))
    ref = df.withColumn("rn", F.row_number().over(w))
    got = rank_within(df, "g", "score", "id", rank_col="rk", exact_limit=500, target_bucket_rows=300)
    assert got.join(ref.select("id", "rn"), "id").filter(F.col("rk") != F.col("rn")).count() == 0


def test_running_totals_bucketed_equals_window(spark):
    g = _random(spark, 2000).groupBy(F.col("id") % 3).agg(F.count("*").alias("c"))
    df = _random(spark, 3000).withColumn("part", F.col("id") % 2).withColumn("one", F.lit(1))
    a = running_totals(df, "score", ["one"], partition_by=["part"], exact_limit=10 ** 9)
    b = running_totals(df, "score", ["one"], partition_by=["part"], exact_limit=10, n_buckets=7)
    j = a.select("id", F.col("cum_one").alias("x")).join(b.select("id", F.col("cum_one").alias("z")), "id")
    assert j.filter(F.col("x") != F.col("z")).count() == 0
    assert g.count() == 3


def test_average_precision_matches_definition(spark):
    y = [1, 0, 1, 1, 0, 0, 1, 0]
    s = [.9, .8, .8, .6, .5, .5, .2, .1]
    # thresholds: .9 (1/1), .8 (2/3), .6 (3/4), .5 (3/6), .2 (4/7), .1 (4/8)
    exp = (1 * 1.0 + 1 * (2 / 3) + 1 * (3 / 4) + 1 * (4 / 7)) / 4
    got = average_precision(vectors(spark, y, s), "y", "score").first()[0]
    assert got == pytest.approx(exp)
    got_b = average_precision(vectors(spark, y, s), "y", "score", exact_limit=2, n_buckets=3).first()[0]
    assert got_b == pytest.approx(exp)


def test_brier_and_out_of_range(spark):
    r = brier(vectors(spark, [1, 0], [0.5, 1.5]), "y", "score").first()
    assert r["brier"] == pytest.approx((0.25 + 2.25) / 2)
    assert r["n_out_of_range"] == 1


def test_bootstrap_inside_ci(spark):
    df = _random(spark, 500, seed=3)
    r = bootstrap_metric(df, "y", "score", "id", 0.1, n_iter=100).first()
    assert r["ci_low"] <= r["point"] <= r["ci_high"]


def test_bootstrap_clear_winner_and_identical(spark):
    df = spark.range(500).select("id", (F.col("id") < 100).cast("int").alias("y"),
                                 F.col("id").cast("double").alias("a"), u(5, "b").alias("b"))
    df = df.withColumn("a", (F.col("y") + F.lit(0.0)).cast("double"))
    r = bootstrap_difference(df, "y", "a", "b", "id", 0.1, n_iter=100).first()
    assert r["point"] > 0 and r["excludes_zero"]
    r = bootstrap_difference(df, "y", "b", "b", "id", 0.1, n_iter=100).first()
    assert r["point"] == 0 and not r["excludes_zero"]


def test_bootstrap_bucketed_equals_small_path(spark):
    df = _random(spark, 3000, seed=7, ties=True).cache()
    a = replicate_precision(df, "y", {"a": "score"}, "id", 0.1, n_iter=20, seed=42).orderBy("_b").collect()
    b = replicate_precision(df, "y", {"a": "score"}, "id", 0.1, n_iter=20, seed=42,
                            exact_limit=100).orderBy("_b").collect()
    assert [round(r["p_a"], 12) for r in a] == [round(r["p_a"], 12) for r in b]


def test_exact_quantiles_by_selection_match_numpy(spark):
    import numpy as np

    from caprank.operators.ranking import exact_quantiles

    df = _random(spark, 4000, seed=13, ties=True).withColumn("score", F.col("score") + F.col("id") % 7)
    vals = np.array([r["score"] for r in df.select("score").collect()])
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, "score", probs, exact_limit=50, n_buckets=8)
    assert got == pytest.approx(list(np.quantile(vals, probs)), abs=1e-12)


def test_leakage_scan_paths_agree(spark):
    from caprank.operators.profile import leakage_scan

    df = _random(spark, 3000, seed=17, ties=True).withColumn("f2", F.col("id") % 5)
    a = {r["feature"]: r for r in leakage_scan(df, "y", "id", ["score", "f2"], 0.1).collect()}
    b = {r["feature"]: r for r in leakage_scan(df, "y", "id", ["score", "f2"], 0.1, exact_limit=100).collect()}
    for f in ("score", "f2"):
        assert a[f]["precision_at_k"] == pytest.approx(b[f]["precision_at_k"])
        assert a[f]["best_direction"] == b[f]["best_direction"]
