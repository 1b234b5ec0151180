import pytest
from pyspark.sql import functions as F

from caprank import catalog as C
from caprank.operators.validate import (
    ValidationError,
    cohort_rules,
    duplicate_rows,
    learn_categories,
    unknown_categories,
    validate,
    validation_report,
)
from fixtures import randint, u


@pytest.fixture()
def valid(spark):
    df = spark.range(200).withColumns({
        C.PREV_QUAL_GRADE: u(1, "p") * 200, C.ADMISSION_GRADE: u(1, "a") * 200, C.SEM1_GRADE: u(1, "g") * 20,
        C.AGE: randint(1, "age", 17, 60), C.CREDITED: randint(1, "c", 0, 7), C.APPROVED: randint(1, "ap", 0, 7),
        C.ENROLLED: randint(1, "e", 1, 8), C.EVALUATIONS: randint(1, "ev", 0, 10),
        C.WITHOUT_EVAL: randint(1, "w", 0, 5),
        **{f: randint(1, f, 0, 2) for f in C.FLAG_COLUMNS},
        C.TARGET: F.when(F.col("id") < 64, "Dropout").otherwise("Graduate"),
    })
    return df.withColumn(C.LABEL, (F.col(C.TARGET) == "Dropout").cast("int"))


def test_valid_frame_passes(valid):
    out = validate(valid)
    assert out.count() == 200
    rep = validation_report(valid, cohort_rules())
    assert rep.filter("n_violations > 0").count() == 0


@pytest.mark.parametrize("mutate,needle", [
    (lambda d: d.withColumn(C.ADMISSION_GRADE, F.when(F.col("id") == 3, None).otherwise(F.col(f"`{C.ADMISSION_GRADE}`"))), "null"),
    (lambda d: d.withColumn(C.ADMISSION_GRADE, F.when(F.col("id") == 3, 250.0).otherwise(F.col(f"`{C.ADMISSION_GRADE}`"))), "in_range"),
    (lambda d: d.withColumn(C.AGE, F.when(F.col("id") == 3, -5).otherwise(F.col(f"`{C.AGE}`"))), "positive"),
    (lambda d: d.withColumn("Debtor", F.when(F.col("id") == 3, 7).otherwise(F.col("Debtor"))), "allowed_values"),
    (lambda d: d.withColumn(C.LABEL, F.lit(1)), "base_rate"),
    (lambda d: d.withColumn(C.TARGET, F.when(F.col("id") == 100, "Withdrawn").otherwise(F.col(C.TARGET))), "allowed_values"),
    (lambda d: d.drop(C.ADMISSION_GRADE), "required"),
])
def test_each_gate_fires(valid, mutate, needle):
    with pytest.raises(ValidationError, match=needle):
        validate(mutate(valid))


def test_missing_label_is_key_error(valid):
    with pytest.raises(KeyError):
        validate(valid.drop(C.LABEL))


def test_fractional_int_is_coercion_violation(spark):
    from caprank.operators.validate import Rules

    df = spark.createDataFrame([("1",), ("1.5",), ("x",)], "v string")
    rep = {r["check"]: r["n_violations"] for r in validation_report(df, Rules(int_columns=["v"])).collect()}
    assert rep["coerce_int"] == 2


def test_duplicates_and_unknown_codes(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c")], "k int, v string")
    d = duplicate_rows(df).collect()
    assert [(r["k"], r["v"], r["n_rows"]) for r in d] == [(1, "a", 2)]
    known = learn_categories(df.filter("k < 3"), ["v"])
    unk = unknown_categories(spark.createDataFrame([(9, "z"), (9, "a")], "k int, v string"), known, ["v"])
    assert [(r["column"], r["code"], r["n_rows"]) for r in unk.collect()] == [("v", "z", 1)]
