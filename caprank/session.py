"""Session construction and lineage-cut helpers.

Everything in the package takes a ``SparkSession`` from the caller; this
module only offers a sensible default for tests, the bench and the CLI-like
plan functions.  On a cluster the session is built by the platform and the
only thing we read from it is ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "caprank",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set one when unset.

    A private scratch folder is created only for local masters (tests, bench):
    on a cluster the checkpoint folder must be shared storage, so we refuse to
    invent a machine-local one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage on a cluster"
        )
    path = tempfile.mkdtemp(prefix="caprank-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``caprank`` importable in Python workers (``addPyFile`` of a zip
    of the package), once per SparkContext.  Needed only by the operators
    that run Python inside tasks (``mapInPandas``)."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="caprank-pkg-"), "caprank.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


class pinned:
    """Persist a (narrow) frame for the jobs of one operator, then release.

    Multi-pass operators (count, cut, aggregates) read their input several
    times; pinning the projection they need (id, label, score: ~24 bytes a
    row, memory then disk) avoids recomputing upstream joins per pass.  A
    lost executor only costs recomputing its blocks from lineage."""

    def __init__(self, df: DataFrame):
        from pyspark import StorageLevel

        self.df = df.persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *exc) -> None:
        self.df.unpersist()


def small_result(df: DataFrame) -> DataFrame:
    """Materialise a tiny result (a few rows) so it survives the release of
    the pinned input it was computed from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


BROADCAST_ROW_LIMIT = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint only after checking the row count of a (normally tiny,
    aggregated) side; above the bound the join stays a shuffle join."""
    from pyspark.sql import functions as F

    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
