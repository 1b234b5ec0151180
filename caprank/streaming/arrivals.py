"""Run the batch plans when a new cohort file lands.

The reference processes one cohort per term in batch; here a file-source
stream watches the landing folder and hands every micro-batch (one or more
new cohort files) to a batch handler through ``foreachBatch`` - for example
the drift check against the training reference followed by the ranking.
``trigger(availableNow=True)`` processes what has arrived and stops, so the
same job serves a scheduled run; the stream's progress lives in the shared
checkpoint folder, so a restarted job never reprocesses a cohort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caprank.session import ensure_checkpoint_dir


def watch_cohorts(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    handler: Callable[[DataFrame, int], None],
    fmt: str = "parquet",
    name: str = "cohort-arrivals",
    available_now: bool = True,
):
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    stream = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        stream = stream.option("header", True)
    q = stream.load(landing_path).writeStream.foreachBatch(handler).option("checkpointLocation", ckpt)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def drift_then_rank(reference: DataFrame, rank: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None],
                    threshold: float = 0.05, share_threshold: float = 0.5, drop: tuple[str, ...] = ()):
    """A ready-made handler: drift verdict of the batch against the
    reference, then the ranked list; both go to ``sink`` with the batch id."""
    from caprank.plans.drift import drift_run

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        _, verdict = drift_run(reference, batch, threshold, share_threshold, drop=drop)
        sink(verdict, batch_id)
        sink(rank(batch), batch_id)

    return handle
