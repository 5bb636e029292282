"""Session helpers: a tuned local session for tests/bench and checkpoint-dir
resolution that respects whatever the cluster already configured."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "parley", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's own session instead."""
    master = master or os.environ.get("PARLEY_MASTER", "local[8]")
    cores = _cores(master)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(8, cores * 2)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("PARLEY_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cores(master: str) -> int:
    if master.startswith("local[") and master[6:-1].isdigit():
        return int(master[6:-1])
    return os.cpu_count() or 8


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    Uses the directory already set on the context, else ``spark.checkpoint.dir``
    from the session conf (the cluster's shared folder). Only a local-mode
    session with neither set gets a private scratch folder (tests, bench)."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):  # one process: no other machine needs the folder
        d = tempfile.mkdtemp(prefix="parley-ckpt-", dir="/tmp")
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder on the cluster")
