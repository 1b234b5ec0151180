import os
import tempfile

import pytest

from caprank.operators.profile import add_binary_target
from caprank.sources.fingerprint import (
    FingerprintMismatch,
    assert_fingerprint,
    file_sha256,
    ingest_snapshot,
    table_fingerprint,
    write_snapshot,
)


@pytest.fixture()
def toy(spark):
    return spark.createDataFrame([(0, 1, "Dropout"), (1, 2, "Graduate"), (2, 3, "Enrolled"), (3, 4, "Dropout")],
                                 "id long, feat_a int, Target string")


def test_binary_target(toy):
    out = add_binary_target(toy, "Target", "Dropout", "dropout")
    assert [r["dropout"] for r in out.orderBy("id").collect()] == [1, 0, 0, 1]
    assert "Target" in out.columns


def test_binary_target_errors(toy):
    with pytest.raises(KeyError):
        add_binary_target(toy.drop("Target"), "Target", "Dropout")
    with pytest.raises(ValueError):
        add_binary_target(toy.filter("Target != 'Dropout'"), "Target", "Dropout")


def test_fingerprint_is_order_free(spark, toy):
    a = table_fingerprint(toy).first()
    b = table_fingerprint(toy.repartition(3).orderBy("feat_a")).first()
    assert a == b


def test_snapshot_round_trip_and_tamper(spark, toy):
    d = tempfile.mkdtemp(prefix="caprank-test-")
    fp = write_snapshot(toy, f"{d}/snap", f"{d}/manifest")
    assert assert_fingerprint(spark, spark.read.parquet(f"{d}/snap"), f"{d}/manifest") == fp
    tampered = toy.unionByName(spark.createDataFrame([(9, 9, "Dropout")], toy.schema))
    with pytest.raises(FingerprintMismatch):
        assert_fingerprint(spark, tampered, f"{d}/manifest")
    with pytest.raises(FileNotFoundError):
        assert_fingerprint(spark, toy, f"{d}/nope")
    files = file_sha256(spark, f"{d}/snap/*.parquet").collect()
    assert files and all(len(r["sha256"]) == 64 for r in files)


def test_ingest_recombines_by_key(spark, toy):
    d = tempfile.mkdtemp(prefix="caprank-test-")
    feats, targets = toy.select("id", "feat_a"), toy.select("id", "Target")
    df, fp = ingest_snapshot(feats, targets, "id", "Target", "Dropout", "dropout", f"{d}/s", f"{d}/m")
    assert fp["n_rows"] == 4 and df.filter("dropout = 1").count() == 2
    assert os.path.isdir(f"{d}/s")


def test_reference_current_loader_and_run_tables(spark, toy):
    from caprank.operators.registry import write_run_table
    from caprank.sources.fingerprint import load_reference_and_current

    d = tempfile.mkdtemp(prefix="caprank-test-")
    write_snapshot(toy.withColumn("Curricular units 2nd sem (x)", toy.feat_a), f"{d}/snap", f"{d}/manifest")
    ref, cur = load_reference_and_current(spark, f"{d}/snap", f"{d}/manifest", "feat_a", "id",
                                          drop_prefix="Curricular units 2nd sem")
    assert ref.count() == 2 and cur.count() == 2
    assert "Target" not in ref.columns and "Curricular units 2nd sem (x)" not in ref.columns
    assert sorted(r["feat_a"] for r in ref.collect()) == [1, 2]
    write_run_table(toy, d, "slice_tables", "run-a")
    write_run_table(toy, d, "slice_tables", "run-b")
    t = spark.read.parquet(f"{d}/slice_tables")
    assert t.filter("run_id = 'run-b'").count() == 4 and t.count() == 8
