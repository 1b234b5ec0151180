"""Table validation in one fused aggregate.

Every row-level rule becomes one conditional count inside a *single*
``agg`` over the table, so checking 40 rules costs one scan and one tiny
shuffle, however big the table.  The report is long:
``(check, column, n_violations)``; :func:`validate` raises in the fixed
precedence order (nulls, base rate, required columns, coercion, value rules,
row count) and returns the coerced DataFrame lazily.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caprank import catalog as C
from caprank.session import broadcast_if_small, cut_lineage


class ValidationError(ValueError):
    """Raised with the first failing check; ``report`` holds all counts."""

    def __init__(self, message: str, report: list[tuple[str, str, int]]):
        super().__init__(message)
        self.report = report


@dataclass
class Rules:
    required: list[str] = field(default_factory=list)
    int_columns: list[str] = field(default_factory=list)
    float_columns: list[str] = field(default_factory=list)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    positive: list[str] = field(default_factory=list)
    non_negative: list[str] = field(default_factory=list)
    allowed: dict[str, list] = field(default_factory=dict)
    label: str | None = None
    expected_base_rate: float | None = None
    base_rate_tolerance: float = 0.05
    expected_rows: int | None = None
    rows_tolerance: float = 0.30
    null_columns: list[str] | None = None  # None = every column


def cohort_rules() -> Rules:
    """Default rules for the student cohort table."""
    flags = C.FLAG_COLUMNS
    counts = [C.CREDITED, C.ENROLLED, C.EVALUATIONS, C.APPROVED, C.WITHOUT_EVAL]
    bounded = {
        C.PREV_QUAL_GRADE: (0.0, 200.0),
        C.ADMISSION_GRADE: (0.0, 200.0),
        C.SEM1_GRADE: (0.0, 20.0),
    }
    return Rules(
        required=list(bounded) + [C.AGE] + counts + flags + [C.LABEL, C.TARGET],
        int_columns=[C.AGE] + counts + flags + [C.LABEL],
        float_columns=list(bounded),
        ranges=bounded,
        positive=[C.AGE],
        non_negative=counts,
        allowed={**{f: [0, 1] for f in flags}, C.LABEL: [0, 1], C.TARGET: list(C.OUTCOME_LABELS)},
        label=C.LABEL,
        expected_base_rate=C.EXPECTED_BASE_RATE,
        base_rate_tolerance=C.BASE_RATE_TOLERANCE,
    )


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _isnull(name: str, dtype: str) -> Column:
    c = _c(name)
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _number(name: str, dtype: str) -> Column:
    """The column as a double; a text that is no number gives null."""
    return _c(name).try_cast("double") if dtype == "string" else _c(name).cast("double")


def _whole(name: str, dtype: str) -> Column:
    """The column as a BIGINT; what is no whole number in range gives null."""
    c = _c(name)
    if dtype != "string":
        return c.try_cast("long")
    d = c.try_cast("double")  # '1.0' is a whole number, '1.5' is not
    return F.coalesce(c.try_cast("long"), F.when(d == F.floor(d), d.try_cast("long")))


def _checks(df: DataFrame, rules: Rules) -> list[tuple[str, str, Column]]:
    """(check, column, violation predicate) for every present column."""
    dtypes = dict(df.dtypes)
    out: list[tuple[str, str, Column]] = []
    null_cols = rules.null_columns if rules.null_columns is not None else df.columns
    for c in null_cols:
        if c in dtypes:
            out.append(("null", c, _isnull(c, dtypes[c])))
    for c in rules.int_columns:
        if c in dtypes:
            # a violation is exactly what coerce() would turn into null or round
            whole = _whole(c, dtypes[c])
            lossy = _c(c) != whole if dtypes[c] in ("double", "float") or dtypes[c].startswith("decimal") else F.lit(False)
            out.append(("coerce_int", c, _c(c).isNotNull() & (whole.isNull() | lossy)))
    for c in rules.float_columns:
        if c in dtypes:
            out.append(("coerce_float", c, _c(c).isNotNull() & _number(c, dtypes[c]).isNull()))
    for c, (lo, hi) in rules.ranges.items():
        if c in dtypes:
            d = _number(c, dtypes[c])
            out.append(("in_range", c, ~d.between(float(lo), float(hi))))
    for c in rules.positive:
        if c in dtypes:
            out.append(("positive", c, ~(_number(c, dtypes[c]) > 0)))
    for c in rules.non_negative:
        if c in dtypes:
            out.append(("non_negative", c, ~(_number(c, dtypes[c]) >= 0)))
    for c, vals in rules.allowed.items():
        if c in dtypes:
            out.append(("allowed_values", c, ~_c(c).isin(*vals)))
    return out


def validation_report(df: DataFrame, rules: Rules) -> DataFrame:
    """Long report ``(check, column, n_violations)`` from ONE aggregate.

    Besides the per-column rules it carries ``required`` (metadata, 0/1 per
    column), ``row_count`` and, when a label is configured, ``base_rate``
    (stored as a violation count of 0/1 with the rate in ``value``)."""
    checks = _checks(df, rules)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (_, _, pred) in enumerate(checks):
        aggs.append(F.count_if(F.coalesce(pred, F.lit(True))).alias(f"_v{i}"))
    has_label = rules.label is not None and rules.label in df.columns
    if has_label:
        aggs.append(F.avg(_c(rules.label).cast("double")).alias("_rate"))
    row = df.agg(*aggs)
    structs = [
        F.struct(F.lit(chk).alias("check"), F.lit(col).alias("column"),
                 F.col(f"_v{i}").cast("long").alias("n_violations"),
                 F.lit(None).cast("double").alias("value"))
        for i, (chk, col, _) in enumerate(checks)
    ]
    for c in rules.required:
        structs.append(F.struct(F.lit("required").alias("check"), F.lit(c).alias("column"),
                                F.lit(0 if c in df.columns else 1).cast("long").alias("n_violations"),
                                F.lit(None).cast("double").alias("value")))
    if has_label and rules.expected_base_rate is not None:
        bad = F.abs(F.col("_rate") - F.lit(float(rules.expected_base_rate))) > F.lit(
            float(rules.base_rate_tolerance))
        structs.append(F.struct(F.lit("base_rate").alias("check"), F.lit(rules.label).alias("column"),
                                F.coalesce(bad, F.lit(True)).cast("long").alias("n_violations"),
                                F.col("_rate").alias("value")))
    rows_bad = F.lit(0).cast("long")
    if rules.expected_rows is not None:
        rows_bad = (F.abs(F.col("_rows") - F.lit(rules.expected_rows))
                    > F.lit(rules.rows_tolerance * rules.expected_rows)).cast("long")
    structs.append(F.struct(F.lit("row_count").alias("check"), F.lit("*").alias("column"),
                            rows_bad.alias("n_violations"), F.col("_rows").cast("double").alias("value")))
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


PRECEDENCE = ["null", "base_rate", "required", "coerce_int", "coerce_float", "in_range",
              "positive", "non_negative", "allowed_values", "row_count"]


def coerce(df: DataFrame, rules: Rules) -> DataFrame:
    """Typed columns (BIGINT, DOUBLE); what the report counts as a violation
    becomes null and nothing throws."""
    dtypes = dict(df.dtypes)
    casts = {c: _whole(c, dtypes[c]) for c in rules.int_columns if c in dtypes}
    casts.update({c: _number(c, dtypes[c]) for c in rules.float_columns if c in dtypes})
    return df.withColumns(casts)


def validate(df: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One pass, all counts, raise on the first failing check in
    precedence order; return the coerced DataFrame (lazy)."""
    rules = rules or cohort_rules()
    missing_label = rules.label is not None and rules.expected_base_rate is not None and (
        rules.label not in df.columns)
    report = [(r["check"], r["column"], int(r["n_violations"]))
              for r in validation_report(df, rules).collect()]
    if missing_label:
        raise KeyError(f"label column {rules.label!r} missing; cannot check base rate")
    failing = [r for r in report if r[2] > 0]
    if failing:
        failing.sort(key=lambda r: PRECEDENCE.index(r[0]))
        chk, col, n = failing[0]
        if chk == "required":
            raise ValidationError(f"required column missing: {col!r}", report)
        raise ValidationError(f"{chk} failed on {col!r}: {n} violation(s)", report)
    return coerce(df, rules)


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Groups of identical rows (on ``columns``) with their count.

    A 64-bit hash per row is aggregated first (a narrow shuffle of hash +
    partial count); only rows whose hash repeats are grouped on the full
    column list, which confirms them exactly."""
    cols = columns or df.columns
    h = F.xxhash64(*[_c(c) for c in cols])
    keyed = df.select(*[_c(c) for c in cols]).withColumn("_h", h)
    rep = keyed.select("_h").groupBy("_h").count().filter(F.col("count") > 1).select("_h")
    # few repeated hashes: whole rows are not shuffled for the join
    cand = keyed.join(broadcast_if_small(cut_lineage(rep)), "_h", "left_semi")
    return cand.groupBy(*[_c(c) for c in cols]).agg(F.count(F.lit(1)).alias("n_rows")).filter(
        F.col("n_rows") > 1)


def learn_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """V13 (fit): the ``(column, code)`` set seen in training, as a table."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("code"))
                    for c in columns])
    return df.select(F.explode(arr).alias("r")).select("r.*").distinct()


def unknown_categories(df: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """V13 (check): codes not in the learned set, with row counts.

    Values are counted per (column, code) before the anti join, so the join
    input is one row per distinct code, never per row."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("code"))
                    for c in columns])
    codes = df.select(F.explode(arr).alias("r")).select("r.*").groupBy("column", "code").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return codes.join(known, ["column", "code"], "left_anti")
