"""A stored profile gives the verdict that the raw rows give."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from caprank.operators import drift, reference


def cohort(spark, n, seed, shift=0.0, odd=True):
    rng = np.random.default_rng(seed)
    rows = [(float(x), float(int(y)), ["a", "b", "c"][int(z)], None if odd and i % 17 == 0 else float(x) / 3, float(s), f"d{i % 4}")
            for i, (x, y, z, s) in enumerate(zip(rng.normal(shift, 1, n), rng.poisson(3 + shift, n), rng.integers(0, 3, n), rng.random(n)))]
    return spark.createDataFrame(rows, "x double, steps double, kind string, gaps double, score double, day string")


COLUMNS = ["x", "steps", "kind", "gaps"]


@pytest.fixture(scope="module")
def ref(spark):
    return cohort(spark, 6000, 1).cache()


@pytest.fixture(scope="module")
def stored(spark, ref):
    path = tempfile.mkdtemp(prefix="caprank-prof-")
    reference.build_profile(ref, COLUMNS, cutoffs={"score": 0.9}, part=F.col("day")).write(path)
    return path


@pytest.mark.parametrize("seed, shift", [(2, 0.0), (3, 0.5), (4, 0.02)])
def test_same_verdict_as_from_the_rows(spark, ref, stored, seed, shift):
    cur = cohort(spark, 3000, seed, shift)
    profile = reference.read_profile(spark, stored)
    want = {r["column"]: r for r in drift.drift_report(ref, cur, COLUMNS).collect()}
    got = {r["column"]: r for r in reference.report_from_profile(profile, cur, COLUMNS).collect()}
    assert set(got) == set(want)
    for c, r in got.items():
        assert r["method"] == want[c]["method"]
        if r["method"] == "ks":
            assert abs(r["statistic"] - want[c]["statistic"]) <= reference.rank_error()
        else:
            assert r["statistic"] == pytest.approx(want[c]["statistic"]) and r["p_value"] == pytest.approx(want[c]["p_value"])
        if r["certain"]:
            assert r["drifted"] == want[c]["drifted"]
    a, b = (drift.drift_verdict(x).first() for x in (drift.drift_report(ref, cur, COLUMNS), reference.report_from_profile(profile, cur, COLUMNS)))
    if all(r["certain"] for r in got.values()):
        assert a == b


def test_small_sketches_state_their_error(spark, ref):
    cur = cohort(spark, 2000, 9)
    profile = reference.build_profile(ref, ["x"], k=64)
    got = reference.ks_from_profile(profile, cur, ["x"]).first()
    want = drift.ks_statistics(ref, cur, ["x"]).first()
    assert abs(got["statistic"] - want["statistic"]) <= reference.rank_error(64) < 0.06
    assert got["p_low"] <= got["p_value"] <= got["p_high"] and (got["n_ref"], got["n_cur"]) == (6000, 2000)


def test_parts_merge_and_are_replaced(spark, ref, stored):
    whole = reference.build_profile(ref, COLUMNS)
    parts = reference.read_profile(spark, stored)
    a, b = ({r["column"]: r for r in p.merged_lines().collect()} for p in (whole, parts))
    for c in a:
        assert a[c]["n"] == b[c]["n"] and a[c]["mean"] == pytest.approx(b[c]["mean"]) and a[c]["sd"] == pytest.approx(b[c]["sd"])
    assert {tuple(r) for r in whole.merged_categories().collect()} == {tuple(r) for r in parts.merged_categories().collect()}
    path = tempfile.mkdtemp(prefix="caprank-prof-")
    for day in ("d0", "d1", "d0"):  # a part is written again: one copy
        reference.build_profile(ref.where(F.col("day") == day), COLUMNS, part=day).write(path)
    two = reference.read_profile(spark, path)
    assert {r["column"]: r["n"] for r in two.merged_lines().collect()}["x"] == 3000


def test_volume_and_psi_without_the_rows(spark, ref, stored):
    profile = reference.read_profile(spark, stored)
    cur = cohort(spark, 4000, 5).withColumn("score", F.col("score") * 1.5)
    rate = ref.where("score >= 0.9").count() / 6000
    got = reference.volume_from_profile(profile, cur, "score", 0.2).first()
    assert got == drift.volume_check(cur, "score", 0.9, rate, 0.2).first() and got["alert"]
    with pytest.raises(LookupError):
        reference.volume_from_profile(profile, cur, "nothing", 0.2)
    moved = cohort(spark, 4000, 6, 0.4)
    want = {r["column"]: r["psi"] for r in drift.psi(ref, moved, ["x", "gaps"]).collect()}
    got = {r["column"]: r["psi"] for r in reference.psi_from_profile(profile, moved, ["x", "gaps"]).collect()}
    assert got == pytest.approx(want, abs=0.01)


def test_new_and_missing_categories(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "kind string")
    cur = spark.createDataFrame([("a",)] * 40 + [("z",)] * 60, "kind string")
    profile = reference.build_profile(ref)
    got = reference.report_from_profile(profile, cur).first()
    want = drift.drift_report(ref, cur).first()
    assert got["statistic"] == pytest.approx(want["statistic"]) and got["drifted"]
    js = reference.report_from_profile(profile, cur, methods={"kind": "jensenshannon"}).first()
    assert js["statistic"] == pytest.approx(drift.jensen_shannon(ref, cur, ["kind"]).first()["statistic"]) and js["p_value"] is None
