"""Drift plan (3.3): align columns -> per-column tests -> verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame

from caprank.operators.drift import common_columns, drift_report, drift_verdict


def drift_run(reference: DataFrame, current: DataFrame, threshold: float = 0.05, share_threshold: float = 0.5,
              categorical: list[str] | None = None, drop: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Report + verdict over the common columns (outcomes dropped)."""
    ref = reference.drop(*[c for c in drop if c in reference.columns])
    cur = current.drop(*[c for c in drop if c in current.columns])
    cols = common_columns(ref, cur)
    report = drift_report(ref.select(*cols), cur.select(*cols), cols, threshold, categorical).persist()
    return report, drift_verdict(report, share_threshold)
