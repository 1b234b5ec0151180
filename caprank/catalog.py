"""Column catalogue of the default cohort table.

Every operator takes column names as parameters; these lists are only the
defaults for the student-cohort shaped table (36 raw features + outcome).

Fixed values: the literal column names, label values, bounds and engineered
feature names below must equal the source table's for right results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: cohort column names -------------------------------------
ENROLLED = "Curricular units 1st sem (enrolled)"
APPROVED = "Curricular units 1st sem (approved)"
EVALUATIONS = "Curricular units 1st sem (evaluations)"
WITHOUT_EVAL = "Curricular units 1st sem (without evaluations)"
CREDITED = "Curricular units 1st sem (credited)"
SEM1_GRADE = "Curricular units 1st sem (grade)"
ADMISSION_GRADE = "Admission grade"
PREV_QUAL_GRADE = "Previous qualification (grade)"
AGE = "Age at enrollment"
MOTHER_QUAL = "Mother's qualification"
FATHER_QUAL = "Father's qualification"

SEM1_GRADE_MAX = 20.0
ADMISSION_GRADE_MAX = 200.0

FLAG_COLUMNS = [
    "Displaced",
    "Educational special needs",
    "Debtor",
    "Tuition fees up to date",
    "Gender",
    "Scholarship holder",
    "International",
]

CATEGORICAL_COLUMNS = [
    "Marital Status",
    "Application mode",
    "Application order",
    "Course",
    "Daytime/evening attendance",
    "Previous qualification",
    "Nacionality",
    "Mother's qualification",
    "Father's qualification",
    "Mother's occupation",
    "Father's occupation",
    "Displaced",
    "Educational special needs",
    "Debtor",
    "Tuition fees up to date",
    "Gender",
    "Scholarship holder",
    "International",
]

MACRO_COLUMNS = ["Unemployment rate", "Inflation rate", "GDP"]

RAW_NUMERIC_COLUMNS = [
    "Previous qualification (grade)",
    "Admission grade",
    "Age at enrollment",
    "Curricular units 1st sem (credited)",
    "Curricular units 1st sem (enrolled)",
    "Curricular units 1st sem (evaluations)",
    "Curricular units 1st sem (approved)",
    "Curricular units 1st sem (grade)",
    "Curricular units 1st sem (without evaluations)",
    "Unemployment rate",
    "Inflation rate",
    "GDP",
]

ENGINEERED_COLUMNS = [
    "sem1_pass_rate",
    "sem1_eval_rate",
    "sem1_unevaluated_ratio",
    "zero_enrolled_flag",
    "grade_delta",
    "parents_max_qualification",
]

LEAKAGE_PREFIX = "Curricular units 2nd sem"
TARGET = "Target"
LABEL = "dropout"
POSITIVE_CLASS = "Dropout"
OUTCOME_LABELS = ["Dropout", "Enrolled", "Graduate"]
EXPECTED_BASE_RATE = 0.321
BASE_RATE_TOLERANCE = 0.05

SLICE_COLUMNS = [
    "Gender",
    "Age at enrollment",
    "International",
    "Displaced",
    "Scholarship holder",
    "Debtor",
]
# --- end of fixed values ----------------------------------------------------

NUMERIC_WITH_ENGINEERED = RAW_NUMERIC_COLUMNS + ENGINEERED_COLUMNS
DOUBLE_COLUMNS = {
    "Previous qualification (grade)",
    "Admission grade",
    "Curricular units 1st sem (grade)",
    "Unemployment rate",
    "Inflation rate",
    "GDP",
}


def cohort_schema(with_outcome: bool = True) -> T.StructType:
    """Explicit StructType for the cohort CSV (never inferred)."""
    fields = []
    for c in CATEGORICAL_COLUMNS:
        fields.append(T.StructField(c, T.IntegerType(), True))
    for c in RAW_NUMERIC_COLUMNS:
        t = T.DoubleType() if c in DOUBLE_COLUMNS else T.IntegerType()
        fields.append(T.StructField(c, t, True))
    if with_outcome:
        fields.append(T.StructField(TARGET, T.StringType(), True))
    return T.StructType(fields)
