import pytest
from pyspark.sql import functions as F

from caprank import catalog as C
from caprank.functions.features import add_engineered_features, safe_ratio

ROWS = [
    (0, 6, 3, 6, 0, 10.0, 100.0, 3, 5),
    (1, 5, 5, 5, 0, 20.0, 200.0, 19, 12),
    (2, 0, 0, 0, 0, 0.0, 120.0, 1, 2),
    (3, 4, 1, 8, 2, 5.0, 50.0, 34, 30),
]
SCHEMA = ("id long, `{e}` int, `{a}` int, `{v}` int, `{w}` int, `{g}` double, `{ad}` double, `{m}` int, `{f}` int"
          .format(e=C.ENROLLED, a=C.APPROVED, v=C.EVALUATIONS, w=C.WITHOUT_EVAL, g=C.SEM1_GRADE,
                  ad=C.ADMISSION_GRADE, m=C.MOTHER_QUAL, f=C.FATHER_QUAL))


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _col(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_hand_computed_values(frame):
    out = add_engineered_features(frame)
    assert _col(out, "sem1_pass_rate") == [0.5, 1.0, 0.0, 0.25]
    assert _col(out, "sem1_eval_rate") == [1.0, 1.0, 0.0, 2.0]
    assert _col(out, "sem1_unevaluated_ratio") == [0.0, 0.0, 0.0, 0.5]
    assert _col(out, "zero_enrolled_flag") == [0, 0, 1, 0]
    assert _col(out, "grade_delta") == pytest.approx([0.0, 0.0, -0.6, 0.0])
    assert _col(out, "parents_max_qualification") == [5, 19, 2, 34]


def test_divide_by_zero_and_negative_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (None, 1.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.0, 0.0, 0.0, 0.0]


def test_idempotent_and_input_untouched(frame):
    once = add_engineered_features(frame)
    twice = add_engineered_features(once)
    assert once.columns == twice.columns
    assert once.orderBy("id").collect() == twice.orderBy("id").collect()
    assert "sem1_pass_rate" not in frame.columns


def test_row_max_skips_nulls(spark):
    df = spark.createDataFrame([(None, 3), (4, None)], f"`{C.MOTHER_QUAL}` int, `{C.FATHER_QUAL}` int")
    out = df.withColumns({"x": F.greatest(F.col(f"`{C.MOTHER_QUAL}`"), F.col(f"`{C.FATHER_QUAL}`"))})
    assert [r["x"] for r in out.collect()] == [3, 4]
