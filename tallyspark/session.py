"""Spark session with the settings every model relies on.

* session time zone UTC, ANSI mode on (bad casts raise, like the source engine);
* AQE on: runtime coalescing, skew-join splitting and size-checked runtime
  broadcast of small join sides;
* dynamic partition overwrite, so an upsert rewrites only touched partitions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size shuffle partitions by bytes (advisoryPartitionSizeInBytes), not by
    # default parallelism: fewer tiny tasks and output files on a busy cluster
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallyspark") -> SparkSession:
    """Build or fetch the session; on a cluster the launcher's settings win."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("TALLY_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared scratch base: ``spark.checkpoint.dir`` as the cluster names it.

    Read from the session; failing that, the context's checkpoint directory.
    Only in local mode with neither set (tests) a temporary local directory is
    registered with ``setCheckpointDir`` (the config key itself cannot be
    changed at runtime); on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not d:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspark-ckpt-"))
        d = sc.getCheckpointDir()
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """Fresh table directory under the shared checkpoint folder.

    Tables written here are visible to every executor (the cluster names a
    shared ``spark.checkpoint.dir``); never a machine-local temp folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
