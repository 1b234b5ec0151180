"""Model registry, alias events and the run log.

The registry is a commit log under one root folder on shared storage: one file a
commit, ``log/<number>.json``, with one line for each action in it (a version, an
alias event, or both).  A commit is published under its number exclusively: the
finished file is moved to a name that must not exist yet, which one writer alone can
do.  A writer that loses reads the log again, takes the next version and the next
number, and tries anew, so two registrations never share a version, and nothing is
updated in place.  Moving an alias or rolling back is one more event.

Resolution is a DataFrame aggregate: the alias's latest event by commit, else the
newest version, else an error.

Run tables (``run_params``, ``run_metrics``, slice tables, importances, ...) are
Parquet partitioned by ``run_id``.  A write replaces the run's own partitions and is
followed by a commit marker; a run that is tried again leaves one copy, and readers
(:func:`read_run_table`) see committed runs alone.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = T.StructType([
    T.StructField("commit", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("version", T.LongType()), T.StructField("path", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("alias", T.StringType()), T.StructField("ts", T.TimestampType()),
])
VERSIONS = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("path", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
ALIASES = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("alias", T.StringType()),
    T.StructField("version", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("commit", T.LongType()),
])
#: Times that a writer reads the log anew after another one was faster.
ATTEMPTS = 100


class ConcurrentCommitError(RuntimeError):
    pass


class NoModelError(LookupError):
    pass


def _folder(spark: SparkSession, path: str):
    """(file system, path) of the session's JVM."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole under a name that must not exist; False if it does.

    The content goes to a name of its own first.  On a local file system it gets its
    final name by a hard link, elsewhere by a rename; both fail on an existing name."""
    fs, final = _folder(spark, path)
    fs.mkdirs(final.getParent())
    temp = spark._jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_{uuid.uuid4().hex}.tmp")
    if fs.getScheme() == "file":
        own, name = temp.toUri().getPath(), final.toUri().getPath()
        with open(own, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(own, name)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    out = fs.create(temp, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.exists(final) and fs.rename(temp, final):
        return True
    fs.delete(temp, False)
    return False


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """All actions of the log, or none before the first commit.  Any other failure
    (denied, corrupt) is raised: an unreadable registry is not an empty one."""
    try:
        return spark.read.schema(LOG).option("mode", "FAILFAST").json(f"{root}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def commit(spark: SparkSession, root: str, actions) -> list[dict]:
    """Append one commit.  ``actions(newest)`` gives its actions (dicts) from the
    newest version of each model; it is asked again after a lost race."""
    for _ in range(ATTEMPTS):
        log = read_log(spark, root)
        row = log.agg(F.max("commit").alias("last")).first()
        newest = {r["model_name"]: int(r["v"]) for r in log.where("kind = 'version'").groupBy("model_name")
                  .agg(F.max("version").alias("v")).collect()}
        number = int(row["last"] or 0) + 1
        rows = [dict(a, commit=number) for a in actions(newest)]
        lines = "".join(json.dumps({k: v.isoformat() + "Z" if isinstance(v, dt.datetime) else v for k, v in r.items()}) + "\n" for r in rows)
        if publish(spark, f"{root}/log/{number:020d}.json", lines):
            return rows
    raise ConcurrentCommitError(f"{ATTEMPTS} commits by others came first in {root}")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def versions(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, root).where("kind = 'version'").select(
        "model_name", "version", "path", "run_id", F.col("ts").alias("created_at"))


def alias_events(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, root).where("kind = 'alias'").select("model_name", "alias", "version", "ts", "commit")


def _version_action(newest: dict, model_name: str, path: str, run_id: str) -> dict:
    return {"kind": "version", "model_name": model_name, "version": newest.get(model_name, 0) + 1, "path": path, "run_id": run_id,
            "ts": _now()}


def register_version(spark: SparkSession, root: str, model_name: str, path: str, run_id: str) -> int:
    """G3 (first half): the next version of the model, its own whoever else
    registers at the same time."""
    done = commit(spark, root, lambda newest: [_version_action(newest, model_name, path, run_id)])
    return done[0]["version"]


def set_alias(spark: SparkSession, root: str, model_name: str, alias: str, version: int,
              ts: dt.datetime | None = None) -> None:
    """G3 (second half) / rollback: append an alias event."""
    commit(spark, root, lambda newest: [{"kind": "alias", "model_name": model_name, "alias": alias, "version": int(version),
                                         "ts": ts or _now()}])


def resolution(vers: DataFrame, events: DataFrame, model_name: str, alias: str) -> DataFrame:
    """G4 as a one-row DataFrame: ``(model_name, version, path, source)``."""
    own = vers.filter(F.col("model_name") == model_name).select(
        F.col("version"), F.col("path"), F.lit(None).cast("long").alias("pointed"), F.lit(None).cast("long").alias("commit"))
    moves = events.filter((F.col("model_name") == model_name) & (F.col("alias") == alias)).select(
        F.lit(None).cast("long").alias("version"), F.lit(None).cast("string").alias("path"), F.col("version").alias("pointed"), "commit")
    # one aggregate over both kinds of rows: at most one row for each version is kept
    facts = own.unionByName(moves).agg(
        F.max_by("pointed", "commit").alias("alias_version"), F.max("version").alias("newest"),
        F.map_from_entries(F.array_distinct(F.collect_list(F.when(F.col("version").isNotNull(), F.struct("version", "path"))))).alias("paths"))
    chosen = F.coalesce("alias_version", "newest")
    return facts.select(
        F.lit(model_name).alias("model_name"), chosen.alias("version"), F.element_at("paths", chosen).alias("path"),
        F.when(F.col("alias_version").isNotNull(), "alias").when(F.col("newest").isNotNull(), "newest").alias("source"))


def resolve_champion(spark: SparkSession, root: str, model_name: str, alias: str = "champion") -> tuple[int, str]:
    row = resolution(versions(spark, root), alias_events(spark, root), model_name, alias).first()
    if row is None or row["version"] is None:
        raise NoModelError(f"no registered version of {model_name!r}")
    return int(row["version"]), row["path"]


def promote_if(spark: SparkSession, root: str, decision: DataFrame, model_name: str, path: str,
               run_id: str, alias: str = "champion") -> int | None:
    """Register and move the alias, in one commit, only when the gate says
    promote."""
    if not decision.select("promote").first()[0]:
        return None

    def actions(newest):
        version = _version_action(newest, model_name, path, run_id)
        return [version, {"kind": "alias", "model_name": model_name, "alias": alias, "version": version["version"], "ts": _now()}]

    return commit(spark, root, actions)[0]["version"]


def save_model(pipeline_model, path: str) -> str:
    """One artifact for the fitted transform + model chain."""
    pipeline_model.write().overwrite().save(path)
    return path


# ---------------------------------------------------------------- run tables
def write_run_table(df: DataFrame, root: str, name: str, run_id: str) -> str:
    """A run's result table (slice table, global importance, ...) as
    Parquet partitioned by ``run_id``.  Earlier runs stay; the run's own rows are
    replaced, so writing twice leaves one copy.  The commit marker comes last."""
    path = f"{root}/{name}"
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))
    publish(df.sparkSession, f"{root}/_committed/{name}/{run_id}", f"{_now().isoformat()}\n")
    return path


def read_run_table(spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None,
                   run_id: str | None = None) -> DataFrame:
    """The rows of committed runs (or of one of them)."""
    fs, folder = _folder(spark, f"{root}/_committed/{name}")
    done = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [r for r in done if run_id is None or r == run_id]
    if not done:
        raise NoModelError(f"no committed run in {name}")
    # one folder a run, so nothing is guessed from the name of a run
    parts = [spark.read.schema(schema) if schema else spark.read for _ in done]
    out = None
    for reader, r in zip(parts, sorted(done), strict=True):
        one = reader.parquet(f"{root}/{name}/run_id={r}").withColumn("run_id", F.lit(r))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def log_params(spark: SparkSession, root: str, run_id: str, params: dict) -> None:
    """``(run_id, key, value)`` rows."""
    rows = [(str(k), str(v)) for k, v in params.items()]
    write_run_table(spark.createDataFrame(rows, "key string, value string").coalesce(1), root, "run_params", run_id)


def long_metrics(metrics: DataFrame, model_col: str = "model") -> DataFrame:
    """Wide metric rows -> long ``(model, metric, value)``."""
    vals = [c for c, t in metrics.dtypes if c != model_col and t in ("double", "float", "int", "bigint", "boolean")]
    long = metrics.select(model_col, *[F.col(c).cast("double") for c in vals]).unpivot(model_col, vals, "metric", "value")
    return long.select(F.col(model_col).alias("model"), "metric", "value")


def log_metrics(root: str, run_id: str, *metrics: DataFrame, model_col: str = "model") -> None:
    """All metric rows of a run, written once."""
    rows = None
    for m in metrics:
        rows = long_metrics(m, model_col) if rows is None else rows.unionByName(long_metrics(m, model_col))
    write_run_table(rows, root, "run_metrics", run_id)
