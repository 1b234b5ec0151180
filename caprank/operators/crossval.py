"""Cross-validated precision at k (K12), train/test gap (Q11), ablation (Q13).

Folds come from :func:`stratified_folds` (a column, not K materialised
copies).  Each fold is one distributed fit on the other folds and one
distributed metric job on the held-out fold; the cohort is persisted once
for the K fits.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caprank.operators.metrics import topk_metrics
from caprank.operators.scorers import CohortSpec, build_scorer, for_fitting
from caprank.operators.split import stratified_folds


def _precision(df: DataFrame, spec: CohortSpec, score: str, fraction: float) -> float:
    return float(topk_metrics(df, spec.label, score, spec.id, fraction).first()["precision_at_k"])


def cross_val_precision(
    df: DataFrame, spec: CohortSpec, models: Sequence[str], n_folds: int = 5, fraction: float = 0.10,
    seed: int = 42, parallelism: int = 5, **params,
) -> DataFrame:
    """One row per model: mean, population std and the per-fold list."""
    folds = stratified_folds(df, spec.label, spec.id, n_folds, seed).persist()
    folded = for_fitting(folds, spec.id).persist()
    folded.count()
    folds.unpersist()

    def run(task: tuple[str, int]) -> tuple[str, int, float]:
        m, f = task
        train = folded.filter(F.col("fold") != f)
        test = folded.filter(F.col("fold") == f)
        sc = build_scorer(m, spec, **params).fit(train)
        return m, f, _precision(sc.score(test, "_score"), spec, "_score", fraction)

    # the fits are independent Spark jobs: submit them concurrently so the
    # scheduler can overlap them on the cluster
    tasks = [(m, f) for m in models for f in range(n_folds)]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tasks)))) as pool:
        rows = list(pool.map(run, tasks))
    folded.unpersist()
    spark = df.sparkSession
    per = spark.createDataFrame(rows, "model string, fold int, precision_at_k double")
    return per.groupBy("model").agg(
        F.avg("precision_at_k").alias("cv_precision_at_k_mean"),
        F.stddev_pop("precision_at_k").alias("cv_precision_at_k_std"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "precision_at_k"))),
                    lambda s: s["precision_at_k"]).alias("cv_folds"),
    )


def train_test_gap(train: DataFrame, test: DataFrame, spec: CohortSpec, model: str, fraction: float = 0.10,
                   **params) -> DataFrame:
    """Q11: P@k on the training rows vs the held-out rows."""
    sc = build_scorer(model, spec, **params).fit(train)
    p_train = _precision(sc.score(train, "_score"), spec, "_score", fraction)
    p_test = _precision(sc.score(test, "_score"), spec, "_score", fraction)
    return train.sparkSession.createDataFrame(
        [(model, p_train, p_test, p_train - p_test)],
        "model string, train_precision_at_k double, test_precision_at_k double, gap double")


def ablation(df: DataFrame, spec: CohortSpec, column: str, models: Sequence[str], n_folds: int = 5,
             fraction: float = 0.10, **params) -> DataFrame:
    """Q13: CV with the column as is vs constant 0 (P8), per model."""
    with_col = cross_val_precision(df, spec, models, n_folds, fraction, **params).withColumn(
        "variant", F.lit("with"))
    ablated = df.withColumn(column, F.lit(0).cast(dict(df.dtypes)[column]))
    without = cross_val_precision(ablated, spec, models, n_folds, fraction, **params).withColumn(
        "variant", F.lit(f"without {column}"))
    return with_col.unionByName(without)
