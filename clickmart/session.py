"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizes follow the input at run time: partitions are coalesced, skewed joins split and joins turned
# into broadcasts by measured size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# For a cluster: enough partitions that one of 100 TB fits an executor; AQE merges the small ones.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cores: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """Session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("clickmart")
    values = SETTINGS | {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": memory,
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
    }
    for name, value in (values | settings).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_session(app: str, **settings: str) -> SparkSession:
    """Session on the cluster that spark-submit names."""
    builder = SparkSession.builder.appName(app)
    for name, value in (SETTINGS | CLUSTER_SETTINGS | settings).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
