"""Tables, shared intermediate files and size-checked broadcasts of the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.streaming.folders import run_folder

#: A side of a join is broadcast up to so many bytes, measured first; beyond it, it is shuffled.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start from files that all executors see."""
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a saved table), marked for broadcast if its measured bytes allow it."""
    sizes = [
        F.sum(F.length(c) + 16) if kind in ("binary", "string") else F.sum(F.lit(16))
        for c, kind in df.dtypes
    ]
    measured = df.select(F.coalesce(sum((F.coalesce(s, F.lit(0)) for s in sizes), F.lit(0)), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(df) if measured <= limit else df


def tidy(run: Callable) -> Callable:
    """The function of a task, after which the worker gives freed memory back to the system: idle workers stay small."""
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return inner


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
