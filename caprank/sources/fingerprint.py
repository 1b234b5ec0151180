"""Data fingerprints, manifests and snapshots.

A table fingerprint is order-free, so it does not depend on file layout or
partitioning: ``count(*)``, ``sum(h)`` as DECIMAL(38,0) (a BIGINT sum would
overflow) and ``bit_xor(h)`` with ``h = xxhash64(all columns)``.  One
aggregate, partial sums map-side.  ``md5`` gives a portable variant that
other engines can reproduce.  Per-file SHA-256 (byte exact, one row per
file) uses the ``binaryFile`` source.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class FingerprintMismatch(RuntimeError):
    def __init__(self, expected: dict, actual: dict):
        super().__init__(f"data changed: expected {expected}, actual {actual}")
        self.expected, self.actual = expected, actual


def _cols(df: DataFrame):
    return [F.col(f"`{c}`") for c in df.columns]


def table_fingerprint(df: DataFrame, method: str = "xxhash64") -> DataFrame:
    """One row: ``n_rows, hash_sum, hash_xor``."""
    if method == "xxhash64":
        h = F.xxhash64(*_cols(df))
    elif method == "md5":
        key = F.concat_ws("|", *[c.cast("string") for c in _cols(df)])
        h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    else:
        raise ValueError(method)
    return df.select(h.alias("_h")).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")
        .alias("hash_sum"),
        F.coalesce(F.bit_xor("_h"), F.lit(0).cast("long")).alias("hash_xor"),
    )


def file_sha256(spark: SparkSession, path: str) -> DataFrame:
    """Byte-exact SHA-256 per stored file: ``(path, length, sha256)``."""
    return spark.read.format("binaryFile").load(path).select(
        "path", "length", F.sha2("content", 256).alias("sha256"))


def fingerprint_dict(df: DataFrame) -> dict:
    r = table_fingerprint(df).first()
    return {"n_rows": int(r["n_rows"]), "hash_sum": r["hash_sum"], "hash_xor": int(r["hash_xor"])}


def write_manifest(spark: SparkSession, manifest_path: str, fp: dict) -> None:
    spark.createDataFrame([(json.dumps(fp, sort_keys=True),)], "manifest string").coalesce(1).write.mode(
        "overwrite").text(manifest_path)


def read_manifest(spark: SparkSession, manifest_path: str) -> dict:
    try:
        rows = spark.read.text(manifest_path).collect()
    except Exception as e:
        raise FileNotFoundError(f"manifest missing: {manifest_path}") from e
    if not rows:
        raise FileNotFoundError(f"manifest empty: {manifest_path}")
    return json.loads(rows[0][0])


def assert_fingerprint(spark: SparkSession, df: DataFrame, manifest_path: str) -> dict:
    """Raise before the first real job when the data changed."""
    expected = read_manifest(spark, manifest_path)
    actual = fingerprint_dict(df)
    if actual != expected:
        raise FingerprintMismatch(expected, actual)
    return actual


def write_snapshot(df: DataFrame, path: str, manifest_path: str, fmt: str = "parquet") -> dict:
    """Write, re-read from storage, fingerprint what was written."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
        back = spark.read.option("header", True).schema(df.schema).csv(path)
    else:
        writer.parquet(path)
        back = spark.read.parquet(path)
    fp = fingerprint_dict(back)
    write_manifest(spark, manifest_path, fp)
    return fp


def ingest_snapshot(features: DataFrame, targets: DataFrame, key: str, source: str, positive: str,
                    new_column: str, path: str, manifest_path: str) -> tuple[DataFrame, dict]:
    """Recombine (S2), add the binary target (P1), snapshot."""
    from caprank.operators.profile import add_binary_target
    from caprank.sources.readers import recombine

    df = add_binary_target(recombine(features, targets, key), source, positive, new_column)
    fp = write_snapshot(df, path, manifest_path)
    return df.sparkSession.read.parquet(path), fp


def load_checked(spark: SparkSession, path: str, manifest_path: str, drop_prefix: str | None = None,
                 drop_outcomes: tuple[str, ...] = ()) -> DataFrame:
    """Fingerprint check, read, drop leakage columns by prefix and
    (for scoring input) the outcome columns."""
    df = spark.read.parquet(path)
    assert_fingerprint(spark, df, manifest_path)
    drop = [c for c in df.columns if drop_prefix and c.startswith(drop_prefix)]
    drop += [c for c in drop_outcomes if c in df.columns]
    return df.drop(*drop)


def load_reference_and_current(spark: SparkSession, path: str, manifest_path: str, order_col: str, id_col: str,
                               drop_prefix: str | None = None,
                               drop_outcomes: tuple[str, ...] = ("Target", "dropout")):
    """Checked load (S4, S1/S5), leakage prefix and outcomes dropped
    (P2, P3), then the first half by ``(order_col, id)`` is the reference and
    the rest the current cohort (T5)."""
    from pyspark.sql import functions as F

    from caprank.operators.split import ordered_half_split

    df = load_checked(spark, path, manifest_path, drop_prefix, drop_outcomes)
    h = ordered_half_split(df, order_col, id_col, flag_col="_ref")
    return h.filter("_ref").drop("_ref"), h.filter(~F.col("_ref")).drop("_ref")
