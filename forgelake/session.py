"""Session settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# What the engine asks of any session, cluster or local. Adaptive execution sizes
# shuffles, splits skewed joins and rebalanced writes; the shuffle partition count is
# left to the cluster.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording a Python call site per column expression costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM never compiles a method of more than 8000 bytes of code. A wide projection fused into one
    # would be interpreted row by row; beyond this size Spark splits it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# For long-running streams: state on disk instead of the executors' heap. The
# shuffle partition count must be chosen before the first start; the checkpoint
# fixes it.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def session(app: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """One-machine session for tests and benchmarks, with a scratch folder of its own."""
    cpus = cpus or min(8, os.cpu_count() or 1)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("forgelake-local")
    for key, value in {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": memory,
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="forgelake-"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
