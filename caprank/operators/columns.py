"""Column algebra and row ids.

All of these are metadata operations or single projections: they fold into
the scan (a dropped column never leaves the Parquet reader).  Row ids are
the one exception that needs care: without a key, ids are assigned once by
per-partition counts and offsets over a *checkpointed* frame (stable
partitions, so a recomputed task yields the same ids), never by
``Window.orderBy`` over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caprank.session import cut_lineage


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Drop every column whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def drop_outcomes(df: DataFrame, outcomes: Sequence[str] = ("Target", "dropout")) -> DataFrame:
    """Drop outcome columns when present."""
    return df.drop(*[c for c in outcomes if c in df.columns])


def align_common(ref: DataFrame, cur: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames restricted to their common columns, reference order."""
    common = [c for c in ref.columns if c in set(cur.columns)]
    return ref.select(*[F.col(f"`{c}`") for c in common]), cur.select(*[F.col(f"`{c}`") for c in common])


def select_model_inputs(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """P5: categoricals first, then numerics; everything else dropped."""
    return df.select(*[F.col(f"`{c}`") for c in [*categorical, *numeric]])


def constant_out(df: DataFrame, column: str, value=0) -> DataFrame:
    """Ablation - overwrite one column with a constant of its type."""
    return df.withColumn(column, F.lit(value).cast(dict(df.dtypes)[column]))


def members(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column equals the value (pushed into the scan)."""
    return df.filter(F.col(f"`{column}`") == F.lit(value))


def assign_row_id(df: DataFrame, id_column: str = "row_id", key: str | None = None) -> DataFrame:
    """P10: use ``key`` when given; else dense ids ``0..n-1``.

    The frame is checkpointed into the shared checkpoint folder first, so
    partition contents are fixed; one tiny job counts rows per partition,
    the offsets (one per partition) become a literal array, and each row's id
    is ``offset[partition] + position in partition``."""
    if key is not None:
        return df.withColumn(id_column, F.col(f"`{key}`"))
    stable = cut_lineage(df)
    pid = F.spark_partition_id()
    counts = dict(stable.groupBy(pid.alias("p")).count().collect())
    offsets, acc = [], 0
    for p in range(stable.rdd.getNumPartitions()):
        offsets.append(acc)
        acc += counts.get(p, 0)
    off: Column = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets] or [F.lit(0).cast("long")]),
                               pid + 1)
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    return stable.withColumn(id_column, off + local)
