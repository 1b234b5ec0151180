"""Gapless positions inside groups, without a task that holds a whole group.

Rows are range-partitioned by (group, order) into parts of bounded size, so a
group with a third of all rows spreads over as many parts as it needs.  A part's
offset is the number of rows of its group in earlier parts: a window over one
small row for each (group, part).  Inside a part the rows of a group are numbered
by a window of their own.  Rows that agree in group and order are interchangeable
and are told apart by their place in the scan, so they spread as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caprank.llm.common import small_side, written

#: A range part of n rows in all holds about this times the root of n, so that both
#: the parts and the table of their offsets grow slowly (12,500 parts for 1e10 rows).
PART_FACTOR = 8


def numbered(rows: DataFrame, group: list[str], order: list[str], rows_per_part: int | None = None) -> DataFrame:
    """``rows`` (a table that can be read again) with ``pos``, 0 to n-1 inside
    each group in ascending ``order``, and ``total``, the group's n.  Nulls are a
    group of their own and come first in an order."""
    own = rows.columns
    by: list[Column] = [F.col(c) for c in order] + [F.col("_place")]
    n = rows.count()
    parts = max(1, math.ceil(n / (rows_per_part or max(1.0, PART_FACTOR * math.sqrt(n)))))
    ranged = rows.withColumn("_place", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(parts, *[F.col(c) for c in group], *by) if parts > 1 else ranged.coalesce(1)
    ranged = written(ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p")).agg(
        F.count("*").alias("_rows"))
    keys = [f"_g{i}" for i in range(len(group))]
    over = Window.partitionBy(*keys)
    before = over.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.select(*keys, "_p", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                                   F.sum("_rows").over(over).alias("total")), "offsets")
    inside = Window.partitionBy("_part", *group).orderBy(*by)
    same = F.col("_part") == F.col("_p")
    for g, k in zip(group, keys, strict=True):
        same = same & F.col(g).eqNullSafe(F.col(k))
    return (ranged.withColumn("_at", F.row_number().over(inside) - 1).join(small_side(counts), same)
            .select(*own, (F.col("_before") + F.col("_at")).cast("long").alias("pos"), F.col("total").cast("long").alias("total")))
