"""Ranking by ids of any type: same rows and ranks as a plain sort."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from caprank.functions.order import splits_at_or_before
from caprank.operators.bootstrap import bootstrap_difference
from caprank.operators.inference import rank_cohort
from caprank.operators.metrics import topk_metrics
from caprank.operators.profile import cutoff_inspection, leakage_scan
from caprank.operators.ranking import find_cut, rank_rows, rank_top_k, rank_within
from caprank.operators.slices import slice_table

N = 900


def ids(kind, i):
    j = (i * 7919) % N
    if kind == "text":
        return f"customer-{j:06d}-é" if j % 2 else f"Customer {j}"
    if kind == "binary":
        return bytes([j % 7, j // 256, j % 256])
    if kind == "large":
        return (1 << 60) + j  # doubles tell only every 256th apart
    if kind == "date":
        return dt.date(2020, 1, 1) + dt.timedelta(days=j)
    return j - 400


def frame(spark, kind, scores):
    kinds = {"text": "string", "binary": "binary", "large": "bigint", "date": "date", "int": "int"}
    rows = [(ids(kind, i), i % 3 == 0, scores(i), "g" if i % 3 else None) for i in range(N)]
    return spark.createDataFrame(rows, f"id {kinds[kind]}, y boolean, s double, g string").withColumn("y", F.col("y").cast("int")), rows


SCORES = {"ties": lambda i: float(i % 2), "one": lambda i: 1.0, "odd": lambda i: (None, math.nan, 0.5, math.inf)[i % 4], "mixed": lambda i: (i * 31 % 57) / 10}


def order(rows):
    def key(r):
        v = r[2]
        if v is None:
            return (2, 0.0, r[0])
        return (0, 0.0, r[0]) if math.isnan(v) else (1, -v, r[0])

    return sorted(rows, key=key)


def plain(x):
    return bytes(x) if isinstance(x, bytearray) else x


@pytest.mark.parametrize("m", [0, 1, 15, 16, 17, 255, 256, 257, 5000])
def test_search_tree_of_literals(spark, m):
    splits = [3 * i for i in range(m)]
    values = [-1, 0, 1, 2, 3, 44, 45, 46, 47, 48, 49, 765, 767, 768, 769, 3 * m - 4, 3 * m - 3, 3 * m, 10**6]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in df.select(splits_at_or_before(F.col("v"), splits)).collect()]
    assert got == [sum(x <= v for x in splits) for v in values]
    text = [f"{x:08d}" for x in splits]
    got = [r[0] for r in df.where("v >= 0").select(splits_at_or_before(F.format_string("%08d", "v"), text)).collect()]
    assert got == [sum(x <= v for x in splits) for v in values if v >= 0]


@pytest.mark.parametrize("kind", ["text", "binary", "large", "date", "int"])
@pytest.mark.parametrize("scores", sorted(SCORES))
def test_ranks_and_cuts(spark, kind, scores):
    df, rows = frame(spark, kind, SCORES[scores])
    want = [r[0] for r in order(rows)]
    for limit in (40, 10**6):
        got = rank_rows(df, "s", "id", exact_limit=limit, target_bucket_rows=60).orderBy("rank").collect()
        assert [plain(r["id"]) for r in got] == want and [r["rank"] for r in got] == list(range(1, N + 1))
        for k in (1, 90, 457, N):
            cut = find_cut(df, "s", "id", k, exact_limit=limit, n_buckets=16)
            assert plain(cut.id) == want[k - 1]
            assert {plain(r["id"]) for r in df.where(cut.contains("s", "id")).collect()} == set(want[:k])
        top = rank_top_k(df, "s", "id", 0.1, exact_limit=limit).orderBy("rank").collect()
        assert [plain(r["id"]) for r in top] == want[:90]
    inner = rank_within(df, "g", "s", "id", exact_limit=50, target_bucket_rows=60).collect()
    for g in ("g", None):
        own = [r[0] for r in order([r for r in rows if r[3] == g])]
        assert [plain(r["id"]) for r in sorted((r for r in inner if r["g"] == g), key=lambda r: r["rank"])] == own


def test_operators_take_text_ids(spark):
    df, rows = frame(spark, "text", SCORES["ties"])
    num, _ = frame(spark, "int", SCORES["ties"])
    text = df.withColumn("id", F.col("id")).cache()
    first = {r[0] for r in order(rows)[:90]}
    tp = sum(r[1] for r in rows if r[0] in first)
    assert topk_metrics(text, "y", "s", "id", 0.1).first()["tp_at_k"] == tp
    assert topk_metrics(text, "y", "s", "id", 0.1, exact_limit=30).first()["tp_at_k"] == tp
    assert cutoff_inspection(text, "y", "s", "id", 0.1).first()["positives_in_top"] == tp
    assert slice_table(text, "y", "s", "id", ["g"], 0.1).count() > 0
    assert leakage_scan(text, "y", "id", ["s"], 0.1).first()["precision_at_k"] >= tp / 90
    d = bootstrap_difference(text.withColumn("b", F.col("s") * 2), "y", "s", "b", "id", 0.1, n_iter=50).first()
    assert d["point"] == 0 and d["ci_low"] == d["ci_high"] == 0

    class Own:
        spec = None

        def score(self, cohort, out):
            return cohort.withColumn(out, F.col("s"))

    ranked = rank_cohort(Own(), text, 0.1, "id", add_reasons=False).orderBy("rank").collect()
    assert [r["student_id"] for r in ranked] == [r[0] for r in order(rows)[:90]]
