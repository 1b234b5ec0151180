"""Batch inference plan (3.2): champion -> score -> exact top-k -> reasons
on the k rows -> write the intervention list.

The list is written as Parquet by default (partitioned output, one file per
task); a single CSV file is an explicit export option only, because
``coalesce(1)`` funnels the whole list through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caprank.operators.artifact import load_scorer
from caprank.operators.inference import score_and_rank
from caprank.operators.registry import resolve_champion
from caprank.operators.scorers import CohortSpec


def write_intervention_list(ranked: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> str:
    """Ordered by rank; Parquet unless CSV export is asked for."""
    out = ranked.orderBy("rank")
    if single_file:
        out = out.coalesce(1)
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def inference_run(spark: SparkSession, cohort: DataFrame, spec: CohortSpec | None, registry_root: str, model_name: str,
                  output_path: str, fraction: float = 0.10, alias: str = "champion", add_reasons: bool = True,
                  fmt: str = "parquet", single_file: bool = False) -> DataFrame:
    """R2 + S11.  Outcome columns are dropped from the scoring input (P3).  Without a
    ``spec`` that of the champion's artifact holds."""
    if spec is None:
        spec = load_scorer(spark, resolve_champion(spark, registry_root, model_name, alias)[1]).spec
    cohort = cohort.drop(*[c for c in ("Target", spec.label) if c in cohort.columns])
    ranked = score_and_rank(spark, registry_root, model_name, cohort, spec, fraction, alias, add_reasons)
    write_intervention_list(ranked, output_path, fmt, single_file)
    return spark.read.parquet(output_path) if fmt == "parquet" else ranked
