"""Distributed running totals (prefix sums) over an ordered numeric key.

``running_totals(df, order, sums, partition_by)`` adds ``cum_<c>`` columns:
the sum of ``c`` over all rows of the same partition whose order value is
at or before the row's.  The order values must be distinct inside a
partition (the input is normally a ``groupBy(partition, value)`` result).  With
``following``, a column of that name holds the next order value of the partition
(null at its end): inside a bucket the next row's, at its end the first one of the
next bucket that has rows.

The number of buckets of a partition follows the row count (one for about
``TARGET_BUCKET_ROWS`` rows), so no task holds a whole partition: rows are bucketed
by per-partition quantile splits (``percentile_approx``, one aggregate), per-bucket
totals form a small table whose own prefix sums give an offset per (partition,
bucket), and the final window runs per (partition, bucket).  With one bucket there
are no splits and no offsets, which leaves the window alone.  The offsets join
as their size asks for, null partition values included.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caprank.operators.ranking import EXACT_LIMIT, TARGET_BUCKET_ROWS, _bucketize

MAX_BUCKETIZER_COLUMNS = 64


def _null_safe_join(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner join on equal columns, null equal to null; the right side's key
    columns are dropped."""
    keys = {c: f"_j_{c}" for c in columns}
    cond = F.lit(True)
    for c, k in keys.items():
        cond = cond & F.col(c).eqNullSafe(F.col(k))
    return left.join(right.withColumnsRenamed(keys), cond).drop(*keys.values())


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    partition_by: Sequence[str] = (),
    descending: bool = False,
    exact_limit: int = EXACT_LIMIT,
    n_buckets: int | None = None,
    n: int | None = None,
    following: str | None = None,
) -> DataFrame:
    part = list(partition_by)
    key = F.col(order).cast("double")
    okey = -key if descending else key
    cnt = n if n is not None else df.count()
    if n_buckets is None:
        n_buckets = max(2, math.ceil(cnt / TARGET_BUCKET_ROWS))
    if cnt <= exact_limit:  # one bucket
        in_order = Window.partitionBy(*part).orderBy(okey)
        w = in_order.rowsBetween(Window.unboundedPreceding, 0)
        new = {f"cum_{c}": F.sum(c).over(w) for c in sums}
        return df.withColumns(new | ({following: F.lead(key).over(in_order)} if following else {}))

    probs = [i / n_buckets for i in range(1, n_buckets)]
    with_key = df.withColumn("_ok", okey)
    # split values per partition: #partitions x n_buckets numbers on the driver
    split_rows = with_key.groupBy(*part).agg(F.percentile_approx("_ok", probs, max(10_000, 20 * n_buckets)).alias("_splits")).collect()
    if len(split_rows) <= MAX_BUCKETIZER_COLUMNS:
        # one Bucketizer column per partition (JVM binary search per row)
        specs, bucket = [], F.lit(0).cast("double")
        keyed = with_key
        for t, r in enumerate(split_rows):
            cond = F.lit(True)
            for c in part:
                cond = cond & F.col(c).eqNullSafe(F.lit(r[c]))
            keyed = keyed.withColumn(f"_in{t}", F.when(cond, F.col("_ok")))
            specs.append((f"_in{t}", sorted({float(v) for v in r["_splits"] if v is not None}), f"_bo{t}"))
            bucket = F.when(cond, F.col(f"_bo{t}")).otherwise(bucket)
        keyed = _bucketize(keyed, specs)
        # Bucketizer counts splits <= value; ties at a split stay in one bucket
        bucketed = keyed.withColumn("_bk", bucket.cast("int")).drop(
            *[f"_in{t}" for t in range(len(split_rows))], *[f"_bo{t}" for t in range(len(split_rows))])
    else:
        splits = with_key.sparkSession.createDataFrame(split_rows) if part else None
        joined = _null_safe_join(with_key, splits, part)
        bucketed = joined.withColumn(
            "_bk", F.size(F.filter("_splits", lambda v: v <= F.col("_ok")))).drop("_splits")
    totals = bucketed.groupBy(*part, "_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums], F.min("_ok").alias("_lo"))
    by_bucket = Window.partitionBy(*part).orderBy("_bk")
    wt = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part, "_bk", *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in sums],
        F.lead("_lo").over(by_bucket).alias("_next"))
    withoff = _null_safe_join(bucketed, offsets, [*part, "_bk"])
    in_order = Window.partitionBy(*part, "_bk").orderBy("_ok")
    w = in_order.rowsBetween(Window.unboundedPreceding, 0)
    new = {f"cum_{c}": F.sum(c).over(w) + F.col(f"_o_{c}") for c in sums}
    if following:
        after = F.coalesce(F.lead("_ok").over(in_order), F.col("_next"))
        new[following] = -after if descending else after
    return withoff.withColumns(new).drop("_ok", "_bk", "_next", *[f"_o_{c}" for c in sums])
