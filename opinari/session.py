"""Session helpers: building a session for local runs and finding the shared
folder for materialised tables.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
store). Jobs read it from the session; only when it is unset (local tests) is
a scratch folder created and set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "opinari",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No broadcast from plan-time estimates: the estimate of an exploded
        # table ignores the explode's row growth. AQE broadcasts a side only
        # after measuring its materialised shuffle output; tables with a
        # bound of their own are broadcast explicitly after a size check.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). If neither is set and the master is local, as in tests,
    a scratch folder is created and registered; on a cluster that is an
    error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master != "local" and not sc.master.startswith("local["):
        # A machine-local folder would lose the checkpoint with its executor.
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster job needs a shared folder "
                           "(HDFS or object store) for checkpoints and written tables")
    local = tempfile.mkdtemp(prefix="opinari-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
