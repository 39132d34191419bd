"""Session settings."""

import os

from pyspark.sql import SparkSession

# Adaptive execution merges small partitions, splits the partitions of busy keys in joins, and
# broadcasts a side only after its size is known at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# On a cluster streaming state can outgrow the heap, so it lives in RocksDB.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(name: str, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**CLUSTER_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(name: str, cpus: str | None = None) -> SparkSession:
    """A small session on this machine, for tests and timings."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
