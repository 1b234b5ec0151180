"""Ranking metrics at a fixed budget (K1-K4, K7-K11) and the model bundle.

One ranked pass serves every metric: the exact cut of the top ``k`` rows is
found once (:func:`caprank.operators.ranking.find_cut`), after which
precision, recall, lift, the recall ceiling and the base rate are all sums
inside a single aggregate with the literal cut as a predicate.  Average
precision is a grouped aggregate over distinct scores followed by
distributed running totals.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caprank.functions.order import as_col
from caprank.operators.prefix import running_totals
from caprank.operators.ranking import Cut, find_cut, k_from_fraction
from caprank.session import pinned, small_result


def _counts(df: DataFrame, y: str) -> tuple[int, int]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("p")).first()
    return int(row["n"]), int(row["p"] or 0)


def topk_metrics(
    df: DataFrame,
    y: str,
    score: str,
    rid: str,
    fraction: float = 0.10,
    cut: Cut | None = None,
    n: int | None = None,
    **cut_kw,
) -> DataFrame:
    """One row: n, positives, k, tp_at_k, precision/recall/lift at k, base
    rate and recall ceiling ``least(1, k / positives)``.  The narrow input
    is pinned for the count, cut and aggregate jobs."""
    with pinned(df.select(rid, y, score)) as base:
        return small_result(_topk_metrics(base, y, score, rid, fraction, cut, n, **cut_kw))


def _topk_metrics(
    df: DataFrame,
    y: str,
    score: str,
    rid: str,
    fraction: float = 0.10,
    cut: Cut | None = None,
    n: int | None = None,
    **cut_kw,
) -> DataFrame:
    if n is None:
        n, _ = _counts(df, y)
    k = k_from_fraction(n, fraction)
    if cut is None:
        cut = find_cut(df, score, rid, k, n=n, **cut_kw)
    yy = F.col(y).cast("long")
    agg = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(yy).alias("positives"),
        F.sum(F.when(cut.contains(score, rid), yy).otherwise(0)).alias("tp_at_k"),
    )
    kk = F.lit(k).cast("long")
    pos = F.col("positives")
    base = pos / F.col("n")
    prec = F.col("tp_at_k") / kk
    return agg.select(
        F.col("n").cast("long").alias("n"),
        pos.cast("long").alias("positives"),
        kk.alias("k"),
        F.col("tp_at_k").cast("long").alias("tp_at_k"),
        prec.alias("precision_at_k"),
        F.when(pos > 0, F.col("tp_at_k") / pos).otherwise(F.lit(0.0)).alias("recall_at_k"),
        F.when(base > 0, prec / base).otherwise(F.lit(0.0)).alias("lift_at_k"),
        base.cast("double").alias("base_rate"),
        F.when(pos > 0, F.least(F.lit(1.0), kk / pos)).alias("recall_ceiling"),
    )


def average_precision(df: DataFrame, y: str, score: str, **kw) -> DataFrame:
    """Step-wise average precision: sum over distinct thresholds (descending)
    of (recall increase) x precision.  Null when there are no positives.
    The per-score table (one row per distinct score) is pinned for the
    running-total jobs."""
    g = df.groupBy(as_col(score).cast("double").alias("_sc")).agg(
        F.count(F.lit(1)).alias("_c"), F.sum(F.col(y).cast("long")).alias("_p")
    )
    with pinned(g) as gp:
        return small_result(_average_precision(gp, **kw))


def _average_precision(g: DataFrame, **kw) -> DataFrame:
    cum = running_totals(g, "_sc", ["_c", "_p"], descending=True, **kw)
    out = cum.agg(
        F.sum(F.col("_p") * (F.col("cum__p") / F.col("cum__c"))).alias("_num"),
        F.sum("_p").alias("_pos"),
    )
    return out.select(
        F.when(F.col("_pos") > 0, F.col("_num") / F.col("_pos")).alias("average_precision")
    )


def brier(df: DataFrame, y: str, score: str) -> DataFrame:
    """Mean squared difference between score and label, with a count of
    scores outside [0, 1] (reported rather than silently accepted)."""
    sc = as_col(score).cast("double")
    return df.agg(
        F.avg(F.pow(sc - F.col(y).cast("double"), 2)).alias("brier"),
        F.count_if((sc < 0) | (sc > 1)).cast("long").alias("n_out_of_range"),
    )


def base_rate(df: DataFrame, y: str) -> Column:
    return F.avg(F.col(y).cast("double"))


def evaluate_model(
    df: DataFrame,
    y: str,
    score: str,
    rid: str,
    fraction: float = 0.10,
    n_bootstrap: int = 2000,
    ci_level: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """The eight-number bundle for one scorer as a one-row DataFrame."""
    from caprank.operators.bootstrap import bootstrap_metric

    with pinned(df.select(rid, y, score)) as base:
        m = topk_metrics(base, y, score, rid, fraction).first()
        ap = average_precision(base, y, score).first()
        br = brier(base, y, score).first()
        ci = bootstrap_metric(base, y, score, rid, fraction, n_iter=n_bootstrap, ci_level=ci_level,
                              seed=seed, n=m["n"], point=m["precision_at_k"]).first()
    # the four parts are single rows already on the driver: assemble, no join
    row = (m["precision_at_k"], ci["ci_low"], ci["ci_high"], m["lift_at_k"], m["recall_at_k"],
           ap["average_precision"], br["brier"], m["base_rate"])
    return df.sparkSession.createDataFrame([row], BUNDLE_SCHEMA)


def evaluate_rungs(
    scored: DataFrame,
    y: str,
    rid: str,
    score_cols: Mapping[str, str],
    fraction: float = 0.10,
    n_bootstrap: int = 2000,
    ci_level: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """K10 for every rung (M6): ``model`` and the eight numbers of the bundle, one
    row a rung in ladder order.  The metrics at k are one grouped aggregate, the
    intervals one set of resamples that all rungs share."""
    from caprank.operators.resample import interval, replicates

    with pinned(scored.select(rid, y, *score_cols.values())) as base:
        rows = {r["model"]: r for r in evaluate_ladder(base, y, rid, score_cols, fraction).collect()}
        reps = replicates(base, y, score_cols, rid, fraction, n_bootstrap, seed)
        ends = reps.agg(*[interval(F.col(f"precision_at_k_{m}"), ci_level).alias(m) for m in score_cols]).first()
        ap = {m: average_precision(base, y, c).first()["average_precision"] for m, c in score_cols.items()}
    out = [(m, rows[m]["precision_at_k"], *ends[m], rows[m]["lift_at_k"], rows[m]["recall_at_k"], ap[m], rows[m]["brier"],
            rows[m]["base_rate"]) for m in score_cols]
    return scored.sparkSession.createDataFrame(out, f"model string, {BUNDLE_SCHEMA}")


BUNDLE_SCHEMA = (
    "precision_at_k double, precision_at_k_ci_low double, precision_at_k_ci_high double, lift_at_k double, "
    "recall_at_k double, pr_auc double, brier double, base_rate double"
)


def evaluate_ladder(
    scored: DataFrame,
    y: str,
    rid: str,
    score_cols: Mapping[str, str],
    fraction: float = 0.10,
) -> DataFrame:
    """M6/K10 without bootstrap: all rungs scored into one wide DataFrame,
    one cut per rung, then *one* grouped aggregate over the unpivoted rungs.
    Output: one row per model, in the ladder order given."""
    n, _ = _counts(scored, y)
    k = k_from_fraction(n, fraction)
    cuts = {m: find_cut(scored, c, rid, k, n=n) for m, c in score_cols.items()}
    order = {m: i for i, m in enumerate(score_cols)}
    long = scored.select(
        F.col(rid).alias("_id"),
        F.col(y).cast("long").alias("_y"),
        F.explode(
            F.array(*[
                F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score"),
                         cuts[m].contains(c, rid).alias("top"))
                for m, c in score_cols.items()
            ])
        ).alias("_r"),
    ).select("_id", "_y", "_r.*")
    kk = F.lit(k).cast("long")
    agg = long.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_y").alias("positives"),
        F.sum(F.when(F.col("top"), F.col("_y")).otherwise(0)).alias("tp_at_k"),
        F.avg(F.pow(F.col("score") - F.col("_y"), 2)).alias("brier"),
    )
    rung = F.create_map(*[x for m, i in order.items() for x in (F.lit(m), F.lit(i))])
    base = F.col("positives") / F.col("n")
    prec = F.col("tp_at_k") / kk
    return agg.select(
        rung[F.col("model")].alias("rung"),
        "model",
        kk.alias("k"),
        prec.alias("precision_at_k"),
        F.when(F.col("positives") > 0, F.col("tp_at_k") / F.col("positives")).otherwise(0.0).alias("recall_at_k"),
        F.when(base > 0, prec / base).otherwise(0.0).alias("lift_at_k"),
        "brier",
        base.alias("base_rate"),
    )
