"""Session settings and shared-storage locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "editlens",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session for jobs, tests and the bench. On a cluster ``master`` is None
    and everything else comes from spark-submit / spark-defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # State of windowed streams can outgrow the JVM heap at scale.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    base.update(conf)
    for k, v in base.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Every view is defined on UTC wall clock (hour labels, windows)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """Cluster-shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    When neither is set, a private folder is created and registered -- only
    with a ``local`` master, where driver and executors are one process. On a
    cluster that would lose data silently, so it raises instead.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="editlens-ckpt-")
    sc.setCheckpointDir(local)
    return local


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared root for one run; Spark's writers
    create it."""
    return f"{shared_root(spark)}/editlens/{name}-{uuid.uuid4().hex[:12]}"
