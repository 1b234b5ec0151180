"""Training plan (3.1): load -> validate -> split -> ladder -> metrics ->
slices -> CV -> gate -> importance -> persist + promote.

Spark shape: one fused validation aggregate, a split *column* (checkpointed), one
fit per rung, one wide scored DataFrame (checkpointed) read by the metrics, slice
and bootstrap jobs, then a one-row decision and one registry commit.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank.operators.artifact import save_scorer
from caprank.operators.crossval import cross_val_precision
from caprank.operators.explain import global_importance, tree_attributions
from caprank.operators.gate import promotion_decision
from caprank.operators.metrics import evaluate_rungs
from caprank.operators.registry import log_metrics, log_params, promote_if, write_run_table
from caprank.operators.scorers import LADDER, CohortSpec, score_ladder
from caprank.operators.slices import slice_table
from caprank.operators.split import stratified_split
from caprank.operators.validate import Rules, validate
from caprank.session import cut_lineage


@dataclass
class TrainingConfig:
    spec: CohortSpec
    registry_root: str
    model_name: str = "cohort-ranker"
    alias: str = "champion"
    fraction: float = 0.10
    test_size: float = 0.20
    seed: int = 42
    n_bootstrap: int = 2000
    ci_level: float = 0.95
    cv_folds: int = 5
    slice_columns: list[str] = field(default_factory=list)
    require_ci_excludes_zero: bool = True
    slice_tolerance: float = 0.20
    rules: Rules | None = None
    rungs: tuple[str, ...] = LADDER
    candidate: str = "gbt"
    baseline: str = "passrate_baseline"
    model_params: dict = field(default_factory=dict)
    run_cv: bool = True


def training_run(spark: SparkSession, cohort: DataFrame, cfg: TrainingConfig) -> dict:
    run_id = uuid.uuid4().hex
    s = cfg.spec
    log_params(spark, cfg.registry_root, run_id, {
        "fraction": cfg.fraction, "test_size": cfg.test_size, "seed": cfg.seed, "n_bootstrap": cfg.n_bootstrap,
        "cv_folds": cfg.cv_folds, "use_engineered": s.use_engineered, "candidate": cfg.candidate,
    })
    data = validate(cohort, cfg.rules) if cfg.rules is not None else cohort
    split = cut_lineage(stratified_split(data, s.label, s.id, cfg.test_size, cfg.seed))
    train = split.filter(~F.col("is_test")).drop("is_test")
    test = split.filter("is_test").drop("is_test")

    wide, fitted = score_ladder(train, test, s, cfg.rungs, **cfg.model_params)
    score_cols = {m: f"score_{m}" for m in fitted}
    metrics = evaluate_rungs(wide, s.label, s.id, score_cols, cfg.fraction, cfg.n_bootstrap, cfg.ci_level, cfg.seed)
    own = metrics.where(F.col("model") == cfg.candidate)
    ci = own.select(F.lit("precision_at_k").alias("metric"), F.col("precision_at_k").alias("point"),
                    F.col("precision_at_k_ci_low").alias("ci_low"), F.col("precision_at_k_ci_high").alias("ci_high"),
                    F.lit(float(cfg.ci_level)).alias("ci_level"))
    ap = own.select(F.col("pr_auc").alias("average_precision"))

    slices = None
    if cfg.slice_columns:
        slices = slice_table(wide, s.label, score_cols[cfg.candidate], s.id, cfg.slice_columns, cfg.fraction)
    cv = None
    if cfg.run_cv:
        both = train.unionByName(test)  # T4: CV on train + test together
        cv = cross_val_precision(both, s, [cfg.baseline, cfg.candidate], cfg.cv_folds, cfg.fraction, cfg.seed,
                                 **cfg.model_params)
    decision = promotion_decision(
        wide, s.label, score_cols[cfg.candidate], score_cols[cfg.baseline], s.id, slices, cfg.fraction,
        cfg.require_ci_excludes_zero, cfg.slice_tolerance, cfg.n_bootstrap, cfg.seed)
    importance = None
    cand = fitted[cfg.candidate]
    if hasattr(cand, "categorical_slots"):
        importance = global_importance(tree_attributions(cand, test, [s.id]), cand.feature_names)
    if slices is not None:
        write_run_table(slices, cfg.registry_root, "slice_tables", run_id)
    if importance is not None:
        write_run_table(importance, cfg.registry_root, "global_importance", run_id)
    # the whole run log: bundles with their intervals, folds, and the gate's figures
    gate = decision.drop("failing_slices").withColumn("model", F.lit(cfg.candidate))
    log_metrics(cfg.registry_root, run_id, metrics, *([cv] if cv is not None else []), gate)
    path = save_scorer(spark, cand, f"{cfg.registry_root}/artifacts/{run_id}", train)
    version = promote_if(spark, cfg.registry_root, decision, cfg.model_name, path, run_id, cfg.alias)
    return {"run_id": run_id, "metrics": metrics, "ci": ci, "average_precision": ap, "slices": slices,
            "cv": cv, "decision": decision, "importance": importance, "version": version,
            "fitted": fitted, "scored": wide}
