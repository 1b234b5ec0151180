"""Ranked intervention list (R1) and champion scoring (R2).

``rank_cohort``: engineer + score every row (one projection), take the
exact top ``ceil(f * n)`` rows with ranks 1..k (distributed, see
:mod:`caprank.operators.ranking`), and only then explain those k rows and
attach the top reasons (the attribution job never sees the other rows).
Reasons are computed on the selected rows themselves - nothing is glued by
position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caprank.operators.artifact import attributions, load_scorer
from caprank.operators.explain import top_reasons
from caprank.operators.ranking import rank_top_k
from caprank.operators.registry import resolve_champion


def rank_cohort(
    scorer,
    cohort: DataFrame,
    fraction: float = 0.10,
    id_column: str | None = None,
    add_reasons: bool = True,
    top_n: int = 3,
) -> DataFrame:
    """Columns: student_id, risk_score, rank [, reason_1..n, reason_i_value].

    The id is ``id_column``, else the spec's id column; when the cohort has
    neither, dense ids 0..n-1 are assigned once (P10)."""
    rid = id_column or scorer.spec.id
    if rid not in cohort.columns:
        # P10: no id column - dense ids assigned once (checkpointed frame)
        from caprank.operators.columns import assign_row_id

        cohort = assign_row_id(cohort, rid)
    scored = scorer.score(cohort, "risk_score")
    top = rank_top_k(scored, "risk_score", rid, fraction)
    if not add_reasons:
        return top.select(F.col(rid).alias("student_id"), "risk_score", "rank")
    # a small list is ranked in one task; its rows are explained in many
    top = top.repartition(F.col(rid))
    attr, names = attributions(scorer, top, [rid, "risk_score", "rank"])
    out = top_reasons(attr, names, min(top_n, len(names)))
    for j in range(len(names) + 1, top_n + 1):
        out = out.withColumns({f"reason_{j}": F.lit(None).cast("string"), f"reason_{j}_value": F.lit(None).cast("double")})
    cols = [F.col(rid).alias("student_id"), "risk_score", "rank"]
    for j in range(1, top_n + 1):
        cols += [f"reason_{j}", f"reason_{j}_value"]
    return out.select(*cols)


def score_and_rank(spark, registry_root: str, model_name: str, cohort: DataFrame, spec=None, fraction: float = 0.10,
                   alias: str = "champion", add_reasons: bool = True) -> DataFrame:
    """R2: resolve the champion (alias, else newest version), of whatever rung, and
    rank.  Its artifact says which columns it reads; ``spec`` may name another id."""
    _, path = resolve_champion(spark, registry_root, model_name, alias)
    scorer = load_scorer(spark, path)
    return rank_cohort(scorer, cohort, fraction, (spec or scorer.spec).id, add_reasons)
