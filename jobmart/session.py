"""Spark session defaults and the shared checkpoint / table folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # lets a join on (source, job_id) use tables bucketed by job_id alone
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "jobmart") -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    On a cluster, ``master`` and the partition count come from the launcher;
    locally they default to ``local[*]`` and 8.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    elif not os.environ.get("SPARK_REMOTE") and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        b = b.master("local[*]")
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = b.config("spark.driver.memory", os.environ.get("JOBMART_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local runs, tests) a fresh
    scratch folder is created, so ``checkpoint()`` and written intermediate
    tables land in the same place.
    """
    global _LOCAL_DIR
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a machine-local scratch folder is not visible to other executors)")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="jobmart-ckpt-")
        d = _LOCAL_DIR
    return d


_LOCAL_DIR: str | None = None
