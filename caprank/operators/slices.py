"""Slice (fairness) table at a global budget (L1).

The top-k flag is decided once over the whole scored set (never per group),
then one ``GROUPING SETS ((a1), (a2), ...)`` aggregate produces every
(attribute, level) row.  Spark expands each row once per set right before
the partial aggregate, so the shuffle carries only per-level partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caprank.operators.ranking import Cut, find_cut, k_from_fraction


def slice_table(
    df: DataFrame,
    y: str,
    score: str,
    rid: str,
    slice_columns: Sequence[str],
    fraction: float = 0.10,
    cut: Cut | None = None,
    n: int | None = None,
    level_expr: dict | None = None,
) -> DataFrame:
    """Columns: slice, level (STRING), group_n, group_base_rate, n_flagged,
    selection_rate, precision_in_group (null when nobody is flagged),
    small_slice (= group_n < k).  Absent attributes are skipped.

    ``level_expr`` optionally maps an attribute to a Column used as its level
    (for example ``floor(age / 5) * 5`` age bands)."""
    present = [c for c in slice_columns if c in df.columns]
    if not present:
        raise ValueError("none of the slice columns is present")
    if n is None:
        n = df.count()
    k = k_from_fraction(n, fraction)
    if cut is None:
        cut = find_cut(df, score, rid, k, n=n)
    level_expr = level_expr or {}
    keys = [f"_l{i}" for i in range(len(present))]
    base = df.select(
        F.col(y).cast("long").alias("_y"),
        cut.contains(score, rid).cast("long").alias("_f"),
        *[
            (level_expr[c] if c in level_expr else F.col(c)).cast("string").alias(key)
            for c, key in zip(present, keys)
        ],
    )
    g = base.groupingSets([[F.col(key)] for key in keys], *keys).agg(
        F.count(F.lit(1)).alias("group_n"),
        F.sum("_y").alias("_pos"),
        F.sum("_f").alias("n_flagged"),
        F.sum(F.col("_f") * F.col("_y")).alias("_tp"),
        F.grouping_id().alias("_gid"),
    )
    nk = len(keys)
    # grouping_id bit (nk-1-i) is 0 for the key that is grouped
    slice_name = F.lit(None).cast("string")
    level = F.lit(None).cast("string")
    for i, (c, key) in enumerate(zip(present, keys)):
        gid = ((1 << nk) - 1) ^ (1 << (nk - 1 - i))
        slice_name = F.when(F.col("_gid") == gid, F.lit(c)).otherwise(slice_name)
        level = F.when(F.col("_gid") == gid, F.col(key)).otherwise(level)
    return g.select(
        slice_name.alias("slice"),
        level.alias("level"),
        F.col("group_n").cast("long").alias("group_n"),
        (F.col("_pos") / F.col("group_n")).alias("group_base_rate"),
        F.col("n_flagged").cast("long").alias("n_flagged"),
        (F.col("n_flagged") / F.col("group_n")).alias("selection_rate"),
        F.when(F.col("n_flagged") > 0, F.col("_tp") / F.col("n_flagged")).alias("precision_in_group"),
        (F.col("group_n") < F.lit(k)).alias("small_slice"),
    )


def ordered(slices: DataFrame, slice_columns: Sequence[str]) -> DataFrame:
    """Attributes in the given order, levels ascending (numerically when
    the level parses as a number).  Only for the small result table."""
    pos = F.create_map(*[x for i, c in enumerate(slice_columns) for x in (F.lit(c), F.lit(i))])
    return slices.orderBy(pos[F.col("slice")], F.col("level").try_cast("double"), F.col("level"))
