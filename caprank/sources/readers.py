"""Readers: parquet tables and schema-declared CSV cohorts.

CSV is always read with an explicit ``StructType``; ``FAILFAST`` for strict
runs, ``PERMISSIVE`` with a corrupt-record column for the violation report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caprank import catalog as C


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    mode: str = "FAILFAST",
    corrupt_col: str = "_corrupt_record",
) -> DataFrame:
    """CSV with header and an explicit schema (never inferred)."""
    schema = schema or C.cohort_schema()
    reader = spark.read.option("header", True).option("mode", mode)
    if mode == "PERMISSIVE":
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).csv(path)


def recombine(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Glue a features table and an outcome table on their row key."""
    return features.join(targets, key, "inner")
