"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here assumes. They are applied only when the session is
# built by us; an existing cluster session keeps its own values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # window top-k (sampling, retrieval) must stay below this to get the
    # partial WindowGroupLimit before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def get_session(master: str | None = None, app: str = "ledgerlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` always wins. Only when nothing is
    configured (local tests) do we create a private folder, and only in
    local mode: a machine-local folder is useless to other executors.
    """
    sc = spark.sparkContext
    current = (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
               or spark.conf.get("spark.checkpoint.dir", None))
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder "
                           "(HDFS/S3/ABFS) before running on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint area for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name) if "://" not in base else base.rstrip("/") + "/" + name
