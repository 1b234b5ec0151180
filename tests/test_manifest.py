"""Fingerprints by file: only changed files are read, and a changed one is named."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from caprank.operators.cardinality import estimated_cardinality, estimated_unseen, relative_error, value_sketches
from caprank.sources import manifest as m
from caprank.sources.fingerprint import FingerprintMismatch, table_fingerprint


@pytest.fixture
def table(spark):
    path = tempfile.mkdtemp(prefix="caprank-man-") + "/table"
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), "id")).alias("t"))
    df.repartition(4).write.partitionBy("g").parquet(path)
    return path


def files(path):
    return sorted(os.path.join(d, f)[len(path) + 1:] for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_the_combination_is_the_tables_fingerprint(spark, table):
    man = m.measured(spark, table)
    assert sorted(r["file"] for r in man.collect()) == files(table)
    assert m.combined(man).first() == table_fingerprint(spark.read.parquet(table)).first()
    assert m.combined(man.where("n_rows > 5")).first()["n_rows"] == man.where("n_rows > 5").agg(F.sum("n_rows")).first()[0]


def test_only_changed_files_are_read(spark, table):
    stored = m.read_manifest_table(spark, m.write_manifest_table(m.measured(spark, table), table + "-manifest"))
    again, read = m.refreshed(spark, table, stored)
    assert read == [] and sorted(map(tuple, again.collect())) == sorted(map(tuple, stored.collect()))
    spark.range(50).select(F.col("id") + 5000, F.lit(1).cast("long").alias("g"), F.lit("new").alias("t")).toDF("id", "g", "t").coalesce(1).write.mode(
        "append").partitionBy("g").parquet(table)
    gone = files(table)[0]
    os.unlink(f"{table}/{gone}")
    again, read = m.refreshed(spark, table, stored)
    assert len(read) == 1 and read[0] not in {r["file"] for r in stored.collect()}
    assert m.combined(again).first() == table_fingerprint(spark.read.parquet(table)).first()
    assert {(r["file"], r["status"]) for r in m.differences(spark, table, stored).collect()} == {(gone, "missing"), (read[0], "added")}


def test_a_tampered_file_is_named_and_pruned_reads_are_checked(spark, table):
    man = m.read_manifest_table(spark, m.write_manifest_table(m.measured(spark, table), table + "-manifest"))
    bad, fine = files(table)[1], files(table)[2]
    other = spark.read.parquet(f"{table}/{bad}").withColumn("t", F.lit("tampered"))
    rows = other.collect()
    temp = tempfile.mkdtemp(prefix="caprank-man-") + "/x"
    spark.createDataFrame(rows, other.schema).coalesce(1).write.parquet(temp)
    part = [f for f in os.listdir(temp) if f.endswith(".parquet")][0]
    with open(f"{temp}/{part}", "rb") as src, open(f"{table}/{bad}", "wb") as dst:
        dst.write(src.read())
    crc = os.path.join(table, os.path.dirname(bad), f".{os.path.basename(bad)}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    assert [tuple(r) for r in m.differences(spark, table, man).collect()] == [(bad, "changed")]
    with pytest.raises(FingerprintMismatch, match="changed"):
        m.load_files(spark, table, man)
    assert m.differences(spark, table, man, [fine]).isEmpty()
    assert m.load_files(spark, table, man, [fine]).count() == man.where(F.col("file") == fine).first()["n_rows"]
    with pytest.raises(FingerprintMismatch):
        m.load_files(spark, table, man, [bad, fine])


def test_the_cohort_and_its_manifest_are_written_by_all_tasks(spark):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    roots = spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/files-*"
    known = set(glob.glob(roots))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = __spark_entry__.queries()["file_manifest"](spark, __spark_entry__.SMOKE_DIR).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    [root] = set(glob.glob(roots)) - known
    assert len(got) == 5 and sum(r["differs"] for r in got) == 1
    assert len(files(f"{root}/data")) > 5 and len(files(f"{root}/manifest")) > 1


def test_sketches_merge_to_the_cardinality_of_all_parts(spark):
    df = spark.range(30_000).select((F.col("id") % 20_000).alias("many"), (F.col("id") % 7).cast("string").alias("few"),
                                    F.lit(None).cast("string").alias("none"), (F.col("id") % 3).alias("day"))
    parts = value_sketches(df, ["many", "few", "none"], F.col("day"))
    assert parts.count() == 9 and parts.where("column = 'none'").agg(F.sum("n_null")).first()[0] == 30_000
    got = {r["column"]: r for r in estimated_cardinality(parts).collect()}
    assert got["few"]["n_distinct"] == 7 and got["none"]["n_distinct"] == 0
    assert abs(got["many"]["n_distinct"] / 20_000 - 1) < 4 * relative_error() == 4 * got["many"]["relative_error"]
    new = value_sketches(df.withColumn("many", F.col("many") + 10_000).withColumn("few", F.concat(F.lit("n"), "few")), ["many", "few"])
    unseen = {r["column"]: r["n_unseen"] for r in estimated_unseen(parts, new).collect()}
    assert unseen["few"] == 7 and abs(unseen["many"] - 10_000) < 1200
