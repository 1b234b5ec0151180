"""The commit log: exclusive commits, concurrent writers, repeatable run tables."""

import datetime as dt
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from caprank.operators import registry
from caprank.operators.registry import (NoModelError, alias_events, commit, log_metrics, log_params, promote_if, publish, read_log,
                                        read_run_table, register_version, resolve_champion, set_alias, versions, write_run_table)


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="caprank-reg-")


def test_a_name_is_published_once_and_whole(spark, root):
    path = f"{root}/log/1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: publish(spark, path, f"writer {i}\n" * 200), range(24)))
    assert sum(won) == 1
    lines = open(path).read().splitlines()
    assert set(lines) == {f"writer {won.index(True)}"} and len(lines) == 200
    assert os.listdir(f"{root}/log") == ["1.json"]  # no rest of the losers


def test_concurrent_registrations_get_different_versions(spark, root):
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda i: (i, register_version(spark, root, "m" if i % 4 else "other", f"/{i}", f"r{i}")), range(16)))
    own = sorted(v for i, v in got if i % 4)
    assert own == list(range(1, 13)) and sorted(v for i, v in got if not i % 4) == [1, 2, 3, 4]
    stored = {(r["model_name"], r["version"]): r["path"] for r in versions(spark, root).collect()}
    assert len(stored) == 16 and all(stored["m" if i % 4 else "other", v] == f"/{i}" for i, v in got)
    log = read_log(spark, root).collect()
    assert sorted(r["commit"] for r in log) == list(range(1, 17))


def test_a_writer_that_loses_reads_again(spark, root, monkeypatch):
    register_version(spark, root, "m", "/a", "r1")
    real, lost = registry.publish, []

    def slow(spark, path, text):
        if not lost:  # another writer comes first under the same number
            lost.append(path)
            assert real(spark, path, '{"commit": 2, "kind": "version", "model_name": "m", "version": 2, "path": "/b", "run_id": "r2"}\n')
        return real(spark, path, text)

    monkeypatch.setattr(registry, "publish", slow)
    assert register_version(spark, root, "m", "/c", "r3") == 3
    assert {r["version"]: r["path"] for r in versions(spark, root).collect()} == {1: "/a", 2: "/b", 3: "/c"}
    monkeypatch.setattr(registry, "publish", lambda *a: False)
    monkeypatch.setattr(registry, "ATTEMPTS", 3)
    with pytest.raises(registry.ConcurrentCommitError):
        register_version(spark, root, "m", "/d", "r4")


def test_alias_follows_the_order_of_commits(spark, root):
    for p in "abc":
        register_version(spark, root, "m", f"/{p}", p)
    assert resolve_champion(spark, root, "m") == (3, "/c")
    now = dt.datetime(2024, 5, 1)
    for v in (3, 1, 2):  # one time stamp for all: the commits decide
        set_alias(spark, root, "m", "champion", v, now)
    assert resolve_champion(spark, root, "m") == (2, "/b")
    set_alias(spark, root, "m", "shadow", 1)
    assert resolve_champion(spark, root, "m", "shadow") == (1, "/a")
    assert [r["version"] for r in alias_events(spark, root).where("alias = 'champion'").orderBy("commit").collect()] == [3, 1, 2]
    with pytest.raises(NoModelError):
        resolve_champion(spark, root, "unknown")


def test_promotion_is_one_commit(spark, root):
    yes, no = (spark.createDataFrame([(x,)], "promote boolean") for x in (True, False))
    assert promote_if(spark, root, no, "m", "/x", "r0") is None and read_log(spark, root).isEmpty()
    assert promote_if(spark, root, yes, "m", "/x", "r1") == 1
    assert {(r["commit"], r["kind"]) for r in read_log(spark, root).collect()} == {(1, "version"), (1, "alias")}
    assert resolve_champion(spark, root, "m") == (1, "/x")


def test_an_unreadable_log_is_not_an_empty_one(spark, root):
    register_version(spark, root, "m", "/a", "r1")
    open(f"{root}/log/{2:020d}.json", "w").write("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        resolve_champion(spark, root, "m")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        commit(spark, root, lambda newest: [])


def test_writing_a_run_twice_leaves_one_copy(spark, root):
    table = spark.range(5).withColumn("x", F.col("id") * 2)
    for run in ("1e5", "007", "1e5", "1e5"):  # ids that look like numbers
        write_run_table(table, root, "slices", run)
    write_run_table(table.limit(2), root, "slices", "007")  # the run was tried again and has fewer rows
    got = read_run_table(spark, root, "slices")
    assert {(r["run_id"], r["n"]) for r in got.groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {("1e5", 5), ("007", 2)}
    assert read_run_table(spark, root, "slices", run_id="007").count() == 2
    table.withColumn("run_id", F.lit("half")).write.mode("append").partitionBy("run_id").parquet(f"{root}/slices")  # never committed
    assert read_run_table(spark, root, "slices").count() == 7
    with pytest.raises(NoModelError):
        read_run_table(spark, root, "slices", run_id="half")


def test_run_log_holds_params_and_all_metric_rows(spark, root):
    for _ in range(2):
        log_params(spark, root, "r1", {"seed": 42, "rungs": ("a", "b")})
        wide = spark.createDataFrame([("a", 0.5, 3), ("b", 0.25, 4)], "model string, p double, k int")
        gate = spark.createDataFrame([("b", True, 0.1)], "model string, promote boolean, difference double")
        log_metrics(root, "r1", wide, gate)
    assert {(r["key"], r["value"]) for r in read_run_table(spark, root, "run_params").collect()} == {("seed", "42"), ("rungs", "('a', 'b')")}
    rows = {(r["model"], r["metric"], r["value"]) for r in read_run_table(spark, root, "run_metrics").collect()}
    assert rows == {("a", "p", 0.5), ("a", "k", 3.0), ("b", "p", 0.25), ("b", "k", 4.0), ("b", "promote", 1.0), ("b", "difference", 0.1)}
    assert read_run_table(spark, root, "run_metrics").count() == 6
