"""Engineered feature expressions (pure ``Column`` builders).

All six features are expressions over one row, so they fuse into the scan's
projection and run inside whole-stage codegen; no UDF, no shuffle.  Column
names are parameters; the defaults come from :mod:`caprank.catalog`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caprank import catalog as C
from caprank.functions.order import as_col


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; 0.0 unless ``den > 0``; NaN and null -> 0.0.

    Not ``try_divide``: a negative denominator also yields 0.0.
    """
    n = as_col(num).cast("double")
    d = as_col(den).cast("double")
    q = F.when(d > 0, n / d)
    return F.coalesce(F.nanvl(q, F.lit(None).cast("double")), F.lit(0.0))


def zero_flag(den: str | Column) -> Column:
    """``1`` when the denominator equals 0, else 0 (null -> 0)."""
    return F.coalesce((as_col(den).cast("double") == 0).cast("int"), F.lit(0))


def scaled_difference(a: str | Column, a_max: float, b: str | Column, b_max: float) -> Column:
    """``a / a_max - b / b_max``: difference of two scale-normalised values."""
    return as_col(a).cast("double") / F.lit(float(a_max)) - as_col(b).cast("double") / F.lit(
        float(b_max)
    )


def row_max(*cols: str | Column) -> Column:
    """Null-skipping maximum across columns (``greatest``)."""
    return F.greatest(*[as_col(c) for c in cols])


def engineered_columns(
    enrolled: str = C.ENROLLED,
    approved: str = C.APPROVED,
    evaluations: str = C.EVALUATIONS,
    without_eval: str = C.WITHOUT_EVAL,
    sem1_grade: str = C.SEM1_GRADE,
    admission_grade: str = C.ADMISSION_GRADE,
    mother_qual: str = C.MOTHER_QUAL,
    father_qual: str = C.FATHER_QUAL,
) -> dict[str, Column]:
    """The six engineered features keyed by output name."""
    return {
        "sem1_pass_rate": safe_ratio(approved, enrolled),
        "sem1_eval_rate": safe_ratio(evaluations, enrolled),
        "sem1_unevaluated_ratio": safe_ratio(without_eval, enrolled),
        "zero_enrolled_flag": zero_flag(enrolled),
        "grade_delta": scaled_difference(
            sem1_grade, C.SEM1_GRADE_MAX, admission_grade, C.ADMISSION_GRADE_MAX
        ),
        "parents_max_qualification": row_max(mother_qual, father_qual),
    }


def add_engineered_features(df: DataFrame, **names: str) -> DataFrame:
    """Append (or overwrite) the six features; idempotent, input untouched."""
    return df.withColumns(engineered_columns(**names))


def rule_score(approved: str | Column = C.APPROVED, enrolled: str | Column = C.ENROLLED) -> Column:
    """Rule-baseline risk score ``1 - pass_rate`` (higher = riskier)."""
    return F.lit(1.0) - safe_ratio(approved, enrolled)
