"""Session defaults and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Adaptive execution does two jobs the operators rely on: it turns a shuffle join into a
# broadcast join only after it has measured the small side, and it splits hot join keys.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The first hundred thousands of a table come from its sorted partitions, not from all of them.
    "spark.sql.execution.topKSortFallbackThreshold": "50000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The last one of equal keys counts, as in Python's JSON reader.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Rows are whole texts of any length: keep the batches a Python task holds small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def build_session(app_name: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_session_conf(spark: SparkSession) -> SparkSession:
    """Set the run-time options above on a session somebody else built."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    The cluster names it in spark.checkpoint.dir. Where that is unset, it is a folder below
    the warehouse; on a cluster that has to be a store which driver and executors share, so a
    folder of the driver's own disk is refused.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = context.getCheckpointDir()
    if configured is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}/_scratch"
        if warehouse.startswith("file:") and not getattr(context, "master", "local").startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder; {warehouse} is the driver's own")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table written between two stages."""
    return f"{checkpoint_root(spark).rstrip('/')}/corpusloom-{name}-{uuid.uuid4().hex}"
