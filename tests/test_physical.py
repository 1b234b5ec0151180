"""Scale properties of the plans, checked on the physical plan and on
bucket sizes rather than on results."""

from pyspark.sql import functions as F

from caprank.operators.ranking import _in_range, _sample_splits, assign_buckets, rank_rows
from fixtures import u

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_giant_tie_is_split_into_balanced_buckets(spark):
    # 80 % of rows share one score (a third of all rows or more in one key)
    df = spark.range(20000).select("id", F.when(u(3, "t") < 0.8, F.lit(1.0)).otherwise(u(3, "s")).alias("score"))
    splits = _sample_splits(df.select("score", "id"), 20000, 40, 7)
    sizes = [r["count"] for r in assign_buckets(df, splits, F.col("score"), F.col("id"), "_b")
             .groupBy("_b").count().collect()]
    assert max(sizes) < 4 * 20000 / 40  # no bucket holds the tie block
    assert sum(sizes) == 20000


def test_cut_range_is_pushed_into_the_scan(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    cur = o.select(F.col("o_totalprice").alias("_s"), F.col("o_orderkey").alias("_i"))
    q = cur.filter(_in_range((400000.0, 5), (300000.0, 7), F.col("_s"), F.col("_i"))).groupBy().count()
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(o_totalprice), Or(LessThan(o_totalprice,400000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_large_rank_has_no_single_partition_window(spark):
    df = spark.range(6000).select("id", u(9, "s").alias("score"))
    ranked = rank_rows(df, "score", "id", exact_limit=500, target_bucket_rows=500)
    plan = _plan(ranked)
    # the row-level window is partitioned by bucket; the only single-partition
    # step is the offsets window over the bucket-count table (<= #buckets rows)
    assert "hashpartitioning(_rb" in plan
    for line in plan.splitlines():
        if "SinglePartition" in line:
            assert "Exchange SinglePartition" in line


def test_bucket_assignment_stays_in_codegen(spark):
    df = spark.range(6000).select("id", u(9, "s").alias("score"))
    splits = _sample_splits(df.select("score", "id"), 6000, 256, 1)
    q = assign_buckets(df, splits, F.col("score"), F.col("id"), "_b").groupBy("_b").count()
    q.collect()  # final adaptive plan
    final = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = final.splitlines()
    bucket_lines = [ln for ln in lines if "bucketizer" in ln]
    assert bucket_lines and all("*(" in ln for ln in bucket_lines)
