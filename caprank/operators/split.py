"""Deterministic splitting.

Row order inside a class is ``(h, id)`` with ``h`` the 32-bit md5 hash of
``seed|id`` -- a pure function of the row, so the split is the same for any
partitioning, on any engine (the DuckDB oracle reproduces it).

* :func:`stratified_split` takes, per class, the first ``n_test_c`` rows of
  that order.  ``n_test = ceil(test_size * n)`` is shared over classes in
  proportion to their size (floors plus largest remainders).  Each class is
  cut with :func:`find_cut`, so membership is a predicate: no window and no
  shuffle of the data.
* :func:`stratified_folds` numbers rows inside their class in the same order
  (:func:`rank_within`, which spreads a hot class over many tasks) and deals
  them round-robin: ``fold = (rn - 1) % K``.
* :func:`ordered_half_split` marks the first ``floor(n/2)`` rows of an explicit
  order column as the reference half.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caprank.operators.ranking import find_cut, find_cuts, rank_within


def hash_order(seed: int, rid: str | Column) -> Column:
    rc = F.col(rid) if isinstance(rid, str) else rid
    key = F.concat_ws("|", F.lit(str(seed)), rc.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def allocate_test_counts(class_counts: dict, test_size: float) -> dict:
    """Largest-remainder allocation of ``ceil(test_size * n)`` test rows."""
    n = sum(class_counts.values())
    n_test = math.ceil(float(test_size) * n)
    exact = {c: n_test * cnt / n for c, cnt in class_counts.items()}
    alloc = {c: math.floor(v) for c, v in exact.items()}
    rest = n_test - sum(alloc.values())
    for c in sorted(exact, key=lambda c: (-(exact[c] - alloc[c]), str(c)))[:rest]:
        alloc[c] += 1
    return alloc


def stratified_split(
    df: DataFrame, label: str, rid: str, test_size: float = 0.20, seed: int = 42,
    flag_col: str = "is_test",
) -> DataFrame:
    """Adds ``is_test``; per-class test counts are exact."""
    counts = dict(df.groupBy(label).count().collect())
    alloc = allocate_test_counts(counts, test_size)
    keyed = df.withColumn("_h", hash_order(seed, rid))
    # order (h ASC, id ASC) == score DESC on -h; null is a class like any other
    wanted = {cls: [n] for cls, n in alloc.items() if n > 0}
    cuts = find_cuts(keyed.withColumn("_nh", -F.col("_h")), "_nh", rid, wanted, counts, by=label)
    cond = F.lit(False)
    for (cls, _), cut in cuts.items():
        cond = cond | (F.col(label).eqNullSafe(F.lit(cls)) & cut.contains(-F.col("_h"), rid))
    return keyed.withColumn(flag_col, cond).drop("_h")


def stratified_folds(
    df: DataFrame, label: str, rid: str, n_folds: int = 5, seed: int = 42, fold_col: str = "fold",
    **kw,
) -> DataFrame:
    keyed = df.withColumn("_nh", -hash_order(seed, rid))
    ranked = rank_within(keyed, label, "_nh", rid, rank_col="_rn", **kw)
    return ranked.withColumn(fold_col, ((F.col("_rn") - 1) % n_folds).cast("int")).drop("_nh", "_rn")


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """T4: vertical concatenation by column name (UNION ALL)."""
    return a.unionByName(b)


def ordered_half_split(
    df: DataFrame, order_col: str, rid: str, flag_col: str = "is_reference"
) -> DataFrame:
    """T5: the first ``floor(n/2)`` rows of ``(order_col ASC, id ASC)`` are
    the reference half; the rest is current."""
    n = df.count()
    half = n // 2
    key = -F.col(order_col).cast("double")
    if dict(df.dtypes)[order_col].startswith("timestamp"):
        key = -F.unix_micros(F.col(order_col).cast("timestamp")).cast("double")
    if half == 0:
        return df.withColumn(flag_col, F.lit(False))
    cut = find_cut(df.withColumn("_k", key), "_k", rid, half, n=n)
    return df.withColumn(flag_col, cut.contains(key, rid))
