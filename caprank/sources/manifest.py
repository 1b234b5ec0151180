"""Fingerprints by data file, kept up to date by reading changed files only (S3,
S4, S9).

A manifest has a row for each data file: its path below the table's folder, length,
modification time, and the rows, hash sum and hash xor of what it holds.  Both hashes
are order-free, so the table's own fingerprint is the sum and the xor over the files
(:func:`combined`), and equal to :func:`caprank.sources.fingerprint.table_fingerprint`
of the whole table.  Files whose length and time are unchanged are not read again
(:func:`refreshed`); a check names the files that differ (:func:`differences`); and a
read of some files only is checked against their rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caprank.sources.fingerprint import FingerprintMismatch

MANIFEST = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
    T.StructField("n_rows", T.LongType()), T.StructField("hash_sum", T.DecimalType(38, 0)), T.StructField("hash_xor", T.LongType()),
])

#: Rows of one data file at most.
FILE_ROWS = 1_000_000


def write_by_folder(df: DataFrame, column: str, path: str, overwrite: bool = False) -> None:
    """Write ``df`` in a folder for each value of ``column``, every task its own rows, in
    files of bounded length; with ``overwrite`` only the folders that have rows are replaced."""
    writer = df.write.option("maxRecordsPerFile", FILE_ROWS)
    if overwrite:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, modified) of the data files below a folder; no file is read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", F.col("modificationTime").alias("modified")))
    return files.select(_below("path", path).alias("file"), "length", "modified")


def _below(column: str, path: str):
    """A file's path below the table's folder."""
    folder = path.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(F.col(column), f"/{folder}/", -1)


def measured(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """Manifest rows of all files, or of some: one aggregate over their rows.  Files
    without rows have zeros."""
    found = listing(spark, path)
    if files is not None:
        found = found.where(F.col("file").isin(*files)) if files else found.limit(0)
        if not files:
            return spark.createDataFrame([], MANIFEST)
    reader = spark.read.schema(spark.read.parquet(path).schema)
    df = reader.parquet(path) if files is None else reader.option("basePath", path).parquet(*[f"{path}/{f}" for f in files])
    own = [F.col(f"`{c}`") for c in df.columns]
    rows = (df.select(_below("_metadata.file_path", path).alias("f"), F.xxhash64(*own).alias("h")).groupBy("f")
            .agg(F.count("*").alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor("h").alias("hash_xor")))
    zero = F.lit(0)
    return found.join(rows, found.file == rows.f, "left").select(
        "file", "length", "modified", F.coalesce("n_rows", zero).cast("long").alias("n_rows"),
        F.coalesce("hash_sum", zero.cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce("hash_xor", zero).cast("long").alias("hash_xor"))


def combined(manifest: DataFrame) -> DataFrame:
    """The table's fingerprint: ``n_rows, hash_sum, hash_xor``."""
    return manifest.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum("hash_sum"), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor("hash_xor"), F.lit(0).cast("long")).alias("hash_xor"))


def refreshed(spark: SparkSession, path: str, old: DataFrame) -> tuple[DataFrame, list[str]]:
    """(manifest as of now, the files that were read for it): rows of unchanged files
    are taken over, those of new and changed ones measured, others dropped."""
    now = listing(spark, path)
    same = ["file", "length", "modified"]
    kept = old.join(now, same, "left_semi")
    todo = sorted(r["file"] for r in now.join(old, same, "left_anti").collect())  # file names of what changed
    return kept.unionByName(measured(spark, path, todo)), todo


def differences(spark: SparkSession, path: str, manifest: DataFrame, files: list[str] | None = None) -> DataFrame:
    """(file, status) of files whose rows are not those of the manifest: ``missing``,
    ``added`` or ``changed``.  With ``files`` these alone are read and checked."""
    now = measured(spark, path, files)
    then = manifest if files is None else manifest.where(F.col("file").isin(*files))
    a, b = then.select("file", F.struct("n_rows", "hash_sum", "hash_xor").alias("then")), now.select(
        "file", F.struct("n_rows", "hash_sum", "hash_xor").alias("now"))
    both = a.join(b, "file", "full_outer")
    status = (F.when(F.col("now").isNull(), "missing").when(F.col("then").isNull(), "added")
              .when(F.col("now") != F.col("then"), "changed"))
    return both.select("file", status.alias("status")).where("status is not null")


def write_manifest_table(manifest: DataFrame, path: str) -> str:
    manifest.select(*MANIFEST.names).write.mode("overwrite").parquet(path)
    return path


def read_manifest_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(path)


def load_files(spark: SparkSession, path: str, manifest: DataFrame, files: list[str] | None = None) -> DataFrame:
    """S5 by files: raise with the names of the files that differ, else read."""
    bad = {r["file"]: r["status"] for r in differences(spark, path, manifest, files).collect()}
    if bad:
        raise FingerprintMismatch({"files": "as in the manifest"}, bad)
    if files is None:
        return spark.read.parquet(path)
    return spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in files])
