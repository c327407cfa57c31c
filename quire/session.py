"""Session defaults and the shared checkpoint folder.

Everything in this package is plain DataFrame code; the only session-level
choices are the ones a Spark user would make for this workload: adaptive
execution (partition coalescing, skew-join splitting, runtime broadcast
decisions), UTC, no UI server, and a reliable checkpoint folder for the
iterative operators.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Broadcast threshold used by the adaptive planner. Sides bigger than this are
# joined by shuffle; nothing in the package forces a broadcast of data whose
# size grows with the input.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(DEFAULT_BROADCAST_BYTES),
        "spark.sql.autoBroadcastJoinThreshold": str(DEFAULT_BROADCAST_BYTES),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only where unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; it is read
    from the session. Only a local-mode session (tests, a laptop) gets a fresh
    folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quire-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "folder (HDFS/S3/ABFS) to cut lineage")

