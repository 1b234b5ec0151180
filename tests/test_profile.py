"""Group medians and sorted values by distributed selection."""

import statistics

import pytest
from pyspark.sql import functions as F

from caprank.operators.profile import distinct_values, group_stats, leakage_scan
from caprank.operators.validate import duplicate_rows


@pytest.mark.parametrize("limits", [{}, {"exact_limit": 40}])
def test_group_medians_with_a_null_group(spark, limits):
    rows = [(None if i % 7 == 0 else i % 2, None if i % 31 == 0 else float(i * 37 % 400)) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["group"]: r for r in group_stats(df, "v", "g", **limits).collect()}
    assert set(got) == {None, 0, 1}
    for g, r in got.items():
        own = [v for x, v in rows if x == g and v is not None]
        assert r["median"] == statistics.median(own) and r["mean"] == pytest.approx(statistics.fmean(own))
        assert r["n"] == sum(x == g for x, _ in rows) and r["std"] == pytest.approx(statistics.stdev(own))
    gap = got[1]["mean"] - got[0]["mean"]
    assert all(r["mean_gap"] == pytest.approx(gap) for r in got.values())


def test_a_group_without_values_has_no_median(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, None)], "g int, v double")
    got = {r["group"]: r["median"] for r in group_stats(df, "v", "g").collect()}
    assert got == {0: 2.0, 1: None}


@pytest.mark.parametrize("limits", [{}, {"exact_limit": 50, "target_bucket_rows": 30}])
def test_sorted_values_of_a_column_with_many(spark, limits):
    df = spark.range(800).select(F.concat(F.lit("v"), F.col("id") % 500).alias("many"),
                                 F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("string")).alias("few"))
    got = distinct_values(df, ["many", "few"], **limits).collect()
    for c, values in (("many", sorted(f"v{i}" for i in range(500))), ("few", [None, "0", "1", "2"])):
        own = sorted((r["position"], r["value"]) for r in got if r["column"] == c)
        assert [v for _, v in own] == values and [p for p, _ in own] == list(range(1, len(values) + 1))


@pytest.mark.parametrize("limits", [{}, {"exact_limit": 20}, {"n_buckets": 5, "exact_limit": 30}])
def test_leakage_scan_against_plain_ranking(spark, limits):
    nan, inf = float("nan"), float("inf")
    rows = []
    for i in range(700):
        odd = [None, nan, inf, -inf, 0.0][i % 5] if i % 3 == 0 else float(i % 50)
        rows.append((f"id{i * 7919 % 700:04d}", int(i * 31 % 10 < 3), odd, float(i % 2), float(i), None, nan))
    names = ["odd", "tie", "line", "none", "nans"]
    df = spark.createDataFrame(rows, "id string, y int, odd double, tie double, line double, none double, nans double")
    got = {r["feature"]: r for r in leakage_scan(df, "y", "id", names, 0.1, **limits).collect()}

    def tp(j, sign):
        def key(r):
            v = r[j]
            if v is None:
                return (2, 0.0, r[0])
            return (0, 0.0, r[0]) if v != v else (1, -sign * v, r[0])

        return sum(r[1] for r in sorted(rows, key=key)[:70])

    rate = sum(r[1] for r in rows) / 700
    for j, f in enumerate(names, 2):
        best = max(tp(j, 1), tp(j, -1)) / 70
        assert got[f]["precision_at_k"] == pytest.approx(best) and got[f]["lift_at_k"] == pytest.approx(best / rate)
        assert got[f]["best_direction"] == ("pos" if tp(j, 1) >= tp(j, -1) else "neg")


def test_duplicates_confirmed_on_whole_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", 1.0), (None, None, None), (None, None, None), (None, None, None)],
                               "i int, t string, x double")
    assert {(r["i"], r["n_rows"]) for r in duplicate_rows(df).collect()} == {(1, 2), (None, 3)}
    assert duplicate_rows(df.limit(0)).count() == 0
