"""Stored, mergeable cardinalities (Q3, Q4, V13) beside the exact ones.

For each part of a table (a day, a file, ...) and each column an HLL sketch of its
values is stored.  The distinct count of any set of parts is the estimate of the union
of their sketches: no row is read again.  The relative standard error is
``relative_error(lg_k)``; 0.8 % for the default of 2 ** 14 registers.  The exact
operators are :func:`caprank.operators.profile.cardinality` and ``unknown_categories``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate from 2 ** lg_k registers."""
    return 1.04 / math.sqrt(2 ** lg_k)


def value_sketches(df: DataFrame, columns: Sequence[str], part: str | Column = "all", lg_k: int = LG_K) -> DataFrame:
    """(part, column, sketch, n_null), one aggregate for all columns; nulls are counted
    beside the sketch."""
    own = (F.lit(part) if isinstance(part, str) else part).cast("string")
    long = df.select(own.alias("part"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("r"))
    return long.groupBy("part", "r.column").agg(
        F.hll_sketch_agg("r.value", F.lit(lg_k)).alias("sketch"), F.count_if(F.col("r.value").isNull()).alias("n_null"))


def estimated_cardinality(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(column, n_distinct, relative_error) over all parts given."""
    return sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct")).select(
        "column", "n_distinct", F.lit(relative_error(lg_k)).alias("relative_error"))


def estimated_unseen(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(column, n_unseen): about how many values of the current parts the reference
    parts do not have, from the union's estimate less the reference's (V13 without
    rows); small true numbers drown in the error of both."""
    ref = reference.groupBy("column").agg(F.hll_union_agg("sketch").alias("r"))
    cur = current.groupBy("column").agg(F.hll_union_agg("sketch").alias("c"))
    return ref.join(cur, "column").select(
        "column", F.greatest(F.lit(0), F.hll_sketch_estimate(F.hll_union("r", "c")) - F.hll_sketch_estimate("r")).alias("n_unseen"))
