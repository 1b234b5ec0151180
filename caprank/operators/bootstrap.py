"""Resampled confidence intervals for a metric at k (K5) and for the
difference between two scorers on the same resamples (K6).

The engine is fixed-size resampling (:mod:`caprank.operators.resample`).  With
``method="poisson"`` it is the Poisson bootstrap of precision at k below, whose
resamples have a random size.

Poisson bootstrap: replicate ``b`` gives row ``id`` the weight
``w ~ Poisson(1)`` drawn by inverse CDF from a 32-bit hash uniform
``h = hex(md5(seed|b|id))[0:8]``; integer thresholds make the draw bit-exact
in any SQL engine.  Per replicate: ``n_b = sum(w)``, ``k_b = max(1,
ceil(f*n_b))``, rows are taken in ``(score DESC, id ASC)`` order until the
cumulative weight reaches ``k_b`` (the boundary row counts partially), and
``P_b = positive weight inside / k_b``.  The CI is the linear-interpolated
percentile of ``P_b`` over replicates.

Scale: the replicate fan-out is a generator inside the scan (no join).  For
small inputs each replicate is one window task.  For large inputs rows are
bucketed by composite split points of the order; per (replicate, bucket)
weight sums form a ``B x buckets`` table, its running totals locate the
boundary bucket of each replicate, and only rows of those boundary buckets
are ranked row by row, partitioned by (replicate, bucket).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caprank.functions.order import as_col
from caprank.operators.resample import METRICS, interval, point_values, replicates
from caprank.session import pinned
from caprank.operators.ranking import (
    EXACT_LIMIT,
    MAX_BUCKETS,
    TARGET_BUCKET_ROWS,
    _bucketize,
    assign_buckets,
    _sample_splits,
    find_cut,
    k_from_fraction,
    order_value,
)

POISSON_MAX = 12


def poisson1_thresholds(max_count: int = POISSON_MAX) -> list[int]:
    """Integer thresholds ``T_m = ceil(2^32 * P(X <= m))``, X ~ Poisson(1)."""
    out, cdf, term = [], 0.0, math.exp(-1.0)
    for m in range(max_count + 1):
        cdf += term
        term /= m + 1
        out.append(min(2**32, math.ceil(cdf * 2**32)))
    return out


def hash_u32(seed: int, b: Column, rid: Column) -> Column:
    """32-bit unsigned hash of ``seed|b|id`` from the md5 hex digest."""
    key = F.concat_ws("|", F.lit(str(seed)), b.cast("string"), rid.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def poisson1_weight(h: Column) -> Column:
    w = F.lit(0)
    for t in poisson1_thresholds():
        w = w + F.when(h >= F.lit(t), 1).otherwise(0)
    return w


def poisson1_weight_sql(h: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {h} >= {t} THEN 1 ELSE 0 END" for t in poisson1_thresholds()) + ")"


def _base(df: DataFrame, y: str, scores: dict[str, str], rid: str) -> DataFrame:
    return df.select(
        F.col(rid).alias("_id"),
        F.col(y).cast("long").alias("_y"),
        *[as_col(c).cast("double").alias(f"_s_{m}") for m, c in scores.items()],
    )


def _explode(base: DataFrame, n_iter: int, seed: int, spread: int | None = None) -> DataFrame:
    """Replicate fan-out as a generator in the same stage as the scan.

    The hash is a column of its own, so the inverse-CDF comparisons reuse it
    instead of re-hashing per threshold.  With ``spread`` the replicates are
    hash-partitioned by ``_b`` *before* hashing: the md5 work then runs in
    parallel and the per-replicate window needs no further exchange."""
    rep = base.withColumn("_b", F.explode(F.sequence(F.lit(1), F.lit(n_iter))))
    if spread:
        rep = rep.repartition(spread, "_b")
    rep = rep.withColumn("_h", hash_u32(seed, F.col("_b"), F.col("_id")).cast("double"))
    # w = #(thresholds <= h) by one JVM binary search: the hash is referenced
    # once (a CASE per threshold would let the optimizer inline md5 13 times)
    thresholds = [float(t) for t in poisson1_thresholds()]
    rep = _bucketize(rep, [("_h", thresholds, "_wd")])
    return rep.withColumn("_w", F.col("_wd").cast("int")).drop("_h", "_wd")


def _replicate_precision_small(rep: DataFrame, m: str, fraction: float) -> DataFrame:
    """One pass: rows with weight 0 add nothing, so they are dropped first;
    the running weight and the replicate total are two windows over the same
    ``_b`` partitioning (one exchange, one sort)."""
    s = f"_s_{m}"
    part = Window.partitionBy("_b")
    w = part.orderBy(F.desc(s), F.asc("_id")).rowsBetween(Window.unboundedPreceding, 0)
    cum = rep.filter(F.col("_w") > 0).select(
        "_b", "_y", "_w", F.sum("_w").over(w).alias("_cw"), F.sum("_w").over(part).alias("_nw"))
    kb = F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(float(fraction)) * F.col("_nw")).cast("long"))
    take = F.greatest(F.lit(0), F.least(F.col("_w"), kb - (F.col("_cw") - F.col("_w"))))
    return cum.groupBy("_b").agg((F.sum(F.col("_y") * take) / F.max(kb)).alias(f"p_{m}"))


def _replicate_precision_bucketed(
    base: DataFrame, m: str, fraction: float, n: int, n_iter: int, seed: int
) -> DataFrame:
    s = f"_s_{m}"
    n_buckets = min(MAX_BUCKETS, max(2, math.ceil(n / TARGET_BUCKET_ROWS)))
    splits = _sample_splits(base.select(order_value(F.col(s)), "_id"), n, n_buckets, seed)
    # bucket once per row, before the replicate fan-out
    keyed = _explode(assign_buckets(base, splits, order_value(F.col(s)), F.col("_id"), "_bk"), n_iter, seed)
    per = keyed.groupBy("_b", "_bk").agg(
        F.sum("_w").alias("_W"), F.sum(F.col("_w") * F.col("_y")).alias("_WY")
    )
    wb = Window.partitionBy("_b").orderBy("_bk").rowsBetween(Window.unboundedPreceding, 0)
    wall = Window.partitionBy("_b")
    tab = per.select(
        "_b", "_bk", "_W", "_WY",
        F.sum("_W").over(wb).alias("_cW"),
        F.sum("_WY").over(wb).alias("_cWY"),
        F.sum("_W").over(wall).alias("_nw"),
    ).withColumn(
        "_kb", F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(float(fraction)) * F.col("_nw")).cast("long"))
    )
    boundary = tab.filter((F.col("_cW") - F.col("_W") < F.col("_kb")) & (F.col("_cW") >= F.col("_kb"))).select(
        "_b", "_bk", "_kb", (F.col("_cW") - F.col("_W")).alias("_Wb"), (F.col("_cWY") - F.col("_WY")).alias("_WYb")
    )
    rows = keyed.filter(F.col("_w") > 0).join(F.broadcast(boundary), ["_b", "_bk"])
    w = Window.partitionBy("_b", "_bk").orderBy(F.desc(s), F.asc("_id")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    cum = rows.withColumn("_cw", F.sum("_w").over(w) + F.col("_Wb"))
    take = F.greatest(F.lit(0), F.least(F.col("_w"), F.col("_kb") - (F.col("_cw") - F.col("_w"))))
    return cum.groupBy("_b").agg(
        ((F.max("_WYb") + F.sum(F.col("_y") * take)) / F.max("_kb")).alias(f"p_{m}")
    )


def replicate_precision(
    df: DataFrame,
    y: str,
    scores: dict[str, str],
    rid: str,
    fraction: float = 0.10,
    n_iter: int = 200,
    seed: int = 42,
    n: int | None = None,
    exact_limit: int = EXACT_LIMIT,
) -> DataFrame:
    """One row per replicate ``_b`` with ``p_<name>`` for every scorer; all
    scorers see the same weights."""
    if n is None:
        n = df.count()
    base = _base(df, y, scores, rid)
    parts = []
    for m in scores:
        if n <= exact_limit:
            spread = min(n_iter, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            parts.append(_replicate_precision_small(_explode(base, n_iter, seed, spread), m, fraction))
        else:
            parts.append(_replicate_precision_bucketed(base, m, fraction, n, n_iter, seed))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_b")
    return out


def _point_precision(df: DataFrame, y: str, score: str, rid: str, fraction: float, n: int) -> float:
    k = k_from_fraction(n, fraction)
    cut = find_cut(df, score, rid, k, n=n)
    tp = df.filter(cut.contains(score, rid)).agg(F.sum(F.col(y).cast("long"))).first()[0] or 0
    return tp / k


def bootstrap_metric(
    df: DataFrame,
    y: str,
    score: str,
    rid: str,
    fraction: float = 0.10,
    n_iter: int = 2000,
    ci_level: float = 0.95,
    seed: int = 42,
    n: int | None = None,
    point: float | None = None,
    metric: str = "precision_at_k",
    method: str = "fixed",
    **kw,
) -> DataFrame:
    """K5: one row ``metric, point, ci_low, ci_high, ci_level``.  Callers that
    already know ``n`` and the point estimate pass them in."""
    with pinned(df.select(F.col(rid), F.col(y), F.col(score))) as base:
        n = n if n is not None else base.count()
        if method == "poisson":
            reps = replicate_precision(base, y, {"a": score}, rid, fraction, n_iter, seed, n=n, **kw)
            value = F.col("p_a")
            _precision_only(metric)
        else:
            reps = replicates(base, y, {"a": score}, rid, fraction, n_iter, seed, n=n, **kw)
            value = F.col(f"{_at_k(metric)}_a")
        lo, hi = reps.agg(interval(value, ci_level)).first()[0]
        if point is None:
            point = point_values(base, y, score, rid, fraction, n)[metric]
    return df.sparkSession.createDataFrame(
        [(metric, float(point), lo, hi, float(ci_level))],
        "metric string, point double, ci_low double, ci_high double, ci_level double")


def bootstrap_difference(
    df: DataFrame,
    y: str,
    score_a: str,
    score_b: str,
    rid: str,
    fraction: float = 0.10,
    n_iter: int = 2000,
    ci_level: float = 0.95,
    seed: int = 42,
    n: int | None = None,
    points: tuple[float, float] | None = None,
    metric: str = "precision_at_k",
    method: str = "fixed",
    **kw,
) -> DataFrame:
    """K6: metric(a) - metric(b) with both scorers on the same resamples."""
    with pinned(df.select(F.col(rid), F.col(y), F.col(score_a).alias("_a"), F.col(score_b).alias("_b"))) as base:
        n = n if n is not None else base.count()
        scores = {"a": "_a", "b": "_b"}
        if method == "poisson":
            reps = replicate_precision(base, y, scores, rid, fraction, n_iter, seed, n=n, **kw)
            difference = F.col("p_a") - F.col("p_b")
            _precision_only(metric)
        else:
            reps = replicates(base, y, scores, rid, fraction, n_iter, seed, n=n, **kw)
            difference = F.col(f"{_at_k(metric)}_a") - F.col(f"{metric}_b")
        lo, hi = reps.agg(interval(difference, ci_level)).first()[0]
        if points is None:
            points = tuple(point_values(base, y, s, rid, fraction, n)[metric] for s in scores.values())
    row = (float(points[0] - points[1]), lo, hi, float(ci_level), bool(lo > 0 or hi < 0))
    return df.sparkSession.createDataFrame(
        [row], "point double, ci_low double, ci_high double, ci_level double, excludes_zero boolean")


def _at_k(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"no metric {metric!r} at k; there are {', '.join(METRICS)}")
    return metric


def _precision_only(metric: str) -> None:
    if metric != "precision_at_k":
        raise ValueError("the Poisson bootstrap knows precision at k alone")
