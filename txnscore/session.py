"""Session construction and cluster-aware helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants; deployment-specific sizes (executor memory,
# shuffle partitions at the 100 TB scale) are left to spark-submit.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "txnscore",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given: on a cluster spark-submit decides.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset and the master is
    local (tests) a scratch folder is created and registered on the SparkContext
    (the session conf cannot be changed for a core setting); on a cluster an
    unset folder is an error, since executors share no local folder.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        # setCheckpointDir makes a fresh sub-folder on every call: register once.
        if current.isEmpty():
            sc.setCheckpointDir(d)
        return d
    if not current.isEmpty():
        return current.get()
    master = sc.master or ""
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master})")
    d = tempfile.mkdtemp(prefix="txnscore-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for stream checkpoints, landed datasets and saved models made by
    queries; never a machine-local folder when a cluster names one.
    """
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
