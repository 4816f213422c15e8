"""Session construction and shared working folders.

Nothing in the library creates a session on its own: every operator takes a
``DataFrame`` (or a ``SparkSession``) from the caller.  ``build_session`` is a
convenience for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tabscore", extra: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC time zone and the web UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TABSCORE_DRIVER_MEMORY", "16g"),
        # Broadcast only what the optimizer can prove small; explicit
        # broadcasts in this package are behind their own size checks.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or an already-set
    checkpoint dir).  Only a local-mode session without one gets its own
    folder, as in tests; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    local_dir = tempfile.mkdtemp(prefix="tabscore-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def shared_root(spark: SparkSession) -> str:
    """A folder below the shared checkpoint folder that stays the same from job to job: what ``spark.checkpoint.dir`` names (each
    application's own checkpoints lie in a fresh folder below it).  Only a local session without the setting has one of
    its own."""
    own = ensure_checkpoint_dir(spark).rstrip("/")
    named = spark.conf.get("spark.checkpoint.dir", None)
    return f"{(named or own).rstrip('/')}/tabscore-shared"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tabscore-work/{name}-{uuid.uuid4().hex[:12]}"
