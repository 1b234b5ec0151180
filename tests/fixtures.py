"""Deterministic test frames built in Spark from ``spark.range`` and a hash
of ``(seed, column, id)`` - identical at any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caprank import catalog as C


def u(seed: int, name: str) -> Column:
    """Uniform [0, 1) from a 64-bit hash of (seed, column name, id)."""
    h = F.xxhash64(F.lit(seed), F.lit(name), F.col("id"))
    return (F.abs(h % F.lit(1 << 40)).cast("double") / float(1 << 40))


def randint(seed: int, name: str, lo: int, hi: int) -> Column:
    return (F.floor(u(seed, name) * (hi - lo)) + lo).cast("int")


def rows(spark: SparkSession, data: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(data, schema)


def vectors(spark: SparkSession, y: list[int], score: list[float]) -> DataFrame:
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, score))],
                                 "id long, y int, score double")


def model_frame(spark: SparkSession, n: int, seed: int = 0, planted: bool = False) -> DataFrame:
    """Fixture 4 / 5: 30 cohort columns; with ``planted`` the label follows
    Bernoulli(0.7 - 0.6 * approved / enrolled)."""
    df = spark.range(n)
    cols = {
        "Marital Status": randint(seed, "ms", 1, 7),
        "Application mode": randint(seed, "am", 1, 18),
        "Application order": randint(seed, "ao", 0, 10),
        "Course": randint(seed, "co", 1, 18),
        "Daytime/evening attendance": randint(seed, "de", 0, 2),
        "Previous qualification": randint(seed, "pq", 1, 18),
        "Nacionality": randint(seed, "na", 1, 22),
        "Mother's qualification": randint(seed, "mq", 1, 35),
        "Father's qualification": randint(seed, "fq", 1, 35),
        "Mother's occupation": randint(seed, "mo", 1, 47),
        "Father's occupation": randint(seed, "fo", 1, 47),
    }
    for f in C.FLAG_COLUMNS:
        cols[f] = randint(seed, f, 0, 2)
    cols.update({
        "Previous qualification (grade)": u(seed, "pqg") * 200,
        "Admission grade": u(seed, "ag") * 200,
        "Age at enrollment": randint(seed, "age", 17, 60),
        C.CREDITED: randint(seed, "cr", 0, 7),
        C.ENROLLED: randint(seed, "en", 1, 8),
        C.EVALUATIONS: randint(seed, "ev", 0, 10),
        C.WITHOUT_EVAL: randint(seed, "we", 0, 5),
        C.SEM1_GRADE: u(seed, "g1") * 20,
        "Unemployment rate": F.element_at(F.array(F.lit(7.6), F.lit(10.8)), randint(seed, "ur", 1, 3)),
        "Inflation rate": F.element_at(F.array(F.lit(0.3), F.lit(1.4)), randint(seed, "ir", 1, 3)),
        "GDP": F.element_at(F.array(F.lit(0.32), F.lit(1.79)), randint(seed, "gdp", 1, 3)),
    })
    df = df.withColumns(cols)
    latent = u(seed, "latent")
    low = randint(seed, "low", 0, 2)
    high = F.col(C.ENROLLED) - randint(seed, "hi", 0, 2)
    appr = F.when(latent < 0.32, low).otherwise(high)
    df = df.withColumn(C.APPROVED, F.least(F.greatest(appr, F.lit(0)), F.col(C.ENROLLED)).cast("int"))
    if planted:
        p = F.lit(0.7) - F.lit(0.6) * F.col(C.APPROVED) / F.col(C.ENROLLED)
        df = df.withColumn("dropout", (u(seed, "y") < p).cast("int"))
    else:
        df = df.withColumn("dropout", (u(seed, "y") < 0.321).cast("int"))
    return df


def cohort_spec(use_engineered: bool = True):
    from caprank.operators.scorers import CohortSpec

    return CohortSpec(
        id="id", label="dropout", categorical=list(C.CATEGORICAL_COLUMNS), numeric=list(C.RAW_NUMERIC_COLUMNS),
        roles={"enrolled": C.ENROLLED, "approved": C.APPROVED, "evaluations": C.EVALUATIONS,
               "without_eval": C.WITHOUT_EVAL, "sem1_grade": C.SEM1_GRADE,
               "admission_grade": C.ADMISSION_GRADE, "mother_qual": C.MOTHER_QUAL,
               "father_qual": C.FATHER_QUAL},
        use_engineered=use_engineered,
    )
