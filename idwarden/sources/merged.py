"""Reading day folders while ``streaming.compaction`` puts merged folders in the place of small ones.

A merge writes its rows aside, then a list of the folders that they stand for, and then moves: from the list on, its rows count and those
folders do not, wherever either lies.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.plans.sinks import Files

NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def lists(path: str) -> str:
    """The folders that each merge stands for, by name of the merge: they stay, so a reader can tell that one took place."""
    return f"{path}/_merges"


def aside(path: str, name: str) -> str:
    """Where a merge keeps its rows (in ``new``) until they are moved; gone when all are."""
    return f"{path}/_merging-{name}"


def state(files: Files, path: str) -> list[tuple[str, list[str] | None]]:
    """The merges that count, each with its days that are still aside (None: it is through)."""
    return [
        (name, files.names(f"{aside(path, name)}/new") if files.exists(aside(path, name)) else None) for name in files.names(lists(path))
    ]


def read_days(spark: SparkSession, path: str, *, merge_schema: bool = True) -> DataFrame:
    """The Parquet rows of a folder, each once, also while folders are merged or after a merge that broke off.

    Files are listed again if a merge went on in the meantime. A read that began before a merge removed its files fails; it does not
    see rows twice.
    """
    files = Files(spark, path)
    while True:
        before = state(files, path)
        rows = _rows(spark, path, before, merge_schema)
        if state(files, path) == before:
            return rows


def _rows(spark: SparkSession, path: str, merges: list, merge_schema: bool) -> DataFrame:
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    going = [(name, days) for name, days in merges if days is not None]
    try:
        rows = reader.parquet(path)
    except AnalysisException as e:
        # All folders are merged, and none is moved yet.
        if not going or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        rows = None
    for name, days in going:
        if rows is not None:
            merged = spark.read.parquet(f"{lists(path)}/{name}").select(F.col("day").alias("_day"), F.col("batch").alias("_batch"))
            same = (F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DAY)) == F.col("_day")) & (F.col("batch") == F.col("_batch"))
            rows = rows.join(merged, same, "left_anti")
        if days:
            new = reader.parquet(f"{aside(path, name)}/new")
            rows = new if rows is None else rows.unionByName(new, allowMissingColumns=True)
    return rows
