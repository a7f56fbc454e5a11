"""Session helpers.

Library functions never build their own session: they take DataFrames and
return DataFrames. These helpers exist for tests, the bench and the
``spark-submit`` entry points in :mod:`corate.plans.jobs`.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this package relies on. AQE re-plans joins from
# measured stage sizes (broadcast conversion, skew split, partition
# coalescing); it is on by default in Spark 4, stated here so a cluster
# profile that turned it off is corrected.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corate", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CORATE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it this raises, since executors could not see each
    other's files. Only in local mode (tests) a fresh local folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="corate-ckpt-")
    sc.setCheckpointDir(local)
    return local


def run_dir(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, in the checkpoint
    directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/corate-run-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the run's folder."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries that run inside delete their shuffle files when they end, not
    when the driver's garbage collector finds them: what a query has written
    to a table is not read from its shuffles again."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df, label: str):
    """Write ``df`` as Parquet under the run's folder and read it back.

    Cuts the lineage of an intermediate that several later steps scan (it
    is computed once, and a lost executor re-reads files instead of
    recomputing the whole upstream plan). The folder is in the shared
    ``spark.checkpoint.dir``, never a machine-local one on a cluster.
    :func:`discard_run` removes it when a job is done. Its shuffle files go at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def discard_run(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
