"""Where streaming jobs keep checkpoints and results."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="idwarden-")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of one job."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
