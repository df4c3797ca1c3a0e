"""Session helpers.

The library never creates machine-local scratch space on a cluster: every
folder it needs for state (stream checkpoints, tables written by the demo
queries) lives under the shared folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (unit tests, a
laptop) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tierflow") -> SparkSession:
    """Session for tests / bench.  On a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext in this client (Spark Connect)
        d = None
    if d:
        # SparkContext appends a per-application uuid folder; state we keep
        # across applications (stream checkpoints, tables) goes one level up.
        return d.rsplit("/", 1)[0]
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared root; set a local one only when none is configured."""
    root = checkpoint_root(spark)
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="tierflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # noqa: BLE001 - Spark Connect: the conf entry is enough for our own folders
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/tierflow/{name}-{uuid.uuid4().hex[:12]}"
