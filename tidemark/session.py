"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    # Parquet timestamps carry no zone; casts to timestamp must not add one.
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Join by hash instead of by sorting where the measured partitions are small enough.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # The JVM does not compile methods above this size; a stage that would have one is
    # better off with its projections split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Ids, versions and hashes are hex digits: zstd halves them, snappy leaves them as long as they are.
    "spark.sql.parquet.compression.codec": "zstd",
}

# What the listeners of a query get to let go of its plan.
SETTLE_SECONDS = 0.5

# Read once per Python process: do not capture a call site for every column expression.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(master: str | None = None, app: str = "tidemark", **extra: str) -> SparkSession:
    """Create a session; on a cluster leave ``master`` unset and size shuffles there."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **START_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every query relies on to a session made elsewhere."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more: it does when the driver collects garbage."""
    for _ in range(2):  # the listeners of the last query get a moment to let go of its plan
        gc.collect()
        time.sleep(SETTLE_SECONDS)
        spark.sparkContext._jvm.System.gc()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables and checkpoints that every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix=f"tidemark-{purpose}-")
