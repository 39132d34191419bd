"""Many small folders of a day into one: ingest adds a folder for each day and batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.constants import MAX_RECORDS_PER_FILE
from idwarden.functions.checks import positive
from idwarden.plans.sinks import Files
from idwarden.sources.merged import aside, lists, state
from idwarden.sources.readers import list_files


def merge_days(
    spark: SparkSession, path: str, *, least_folders: int = 8, full_bytes: int = 1 << 30, days_at_once: int = 50,
    combine: Callable[[DataFrame], DataFrame] | None = None, max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> int:
    """Merge the folders of each day that has ``least_folders`` to merge, and return how many were.

    Folders of ``full_bytes`` stay as they are, so rows are not written over and over. The newest batch of each stream stays too, as it
    may be tried again; other named batches must not be written again once they are merged. ``combine`` may make the rows of a day
    fewer (they have ``event_date``, which it keeps). ``read_days`` sees each row once at any time. Merges that broke off are brought
    to their end first. One merge of a folder may run at a time; ingest may go on. A ledger of files takes merged ones for new: merge
    folders that are read by day or whole.
    """
    positive(least_folders=least_folders, full_bytes=full_bytes, days_at_once=days_at_once)
    finish_merges(spark, path)
    by_day: dict[str, list[str]] = {}
    for day, batch in _folders(spark, path, full_bytes):
        by_day.setdefault(day, []).append(batch)
    days = sorted(day for day, batches in by_day.items() if len(batches) >= least_folders)
    for first in range(0, len(days), days_at_once):
        _merge(spark, path, [(day, batch) for day in days[first:first + days_at_once] for batch in by_day[day]], combine, max_records_per_file)
    return sum(len(by_day[day]) for day in days)


def _folders(spark: SparkSession, path: str, full_bytes: int) -> list[tuple[str, str]]:
    """(day, batch) of the folders that may be merged. Only names, and no more than Spark lists on the driver to read them."""
    def part(number):
        return F.regexp_extract("path", r"/event_date=([^/]+)/batch=([^/]+)/[^/]+$", number)

    sizes = list_files(spark, path).groupBy(part(1).alias("day"), part(2).alias("batch")).agg(F.sum("length").alias("bytes")).where("day <> ''")
    stream = r"^([0-9a-f]{8})-(\d{6,})$"
    sizes = sizes.withColumns({"stream": F.regexp_extract("batch", stream, 1), "number": F.expr(f"try_cast(regexp_extract(batch, r'{stream}', 2) AS BIGINT)")})
    newest = sizes.where("stream <> ''").groupBy("stream").agg(F.max("number").alias("newest"))
    rows = sizes.join(newest, "stream", "left").where((F.col("newest").isNull() | (F.col("number") < F.col("newest"))) & (F.col("bytes") < full_bytes))
    return [(r["day"], r["batch"]) for r in rows.select("day", "batch").collect()]


def _merge(spark: SparkSession, path: str, folders: list[tuple[str, str]], combine, max_records_per_file: int) -> None:
    name = f"merged-{uuid.uuid4().hex}"
    staged, files = aside(path, name), Files(spark, path)
    rows = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*(f"{path}/event_date={d}/batch={b}" for d, b in folders)).drop("batch")
    rows = (combine(rows) if combine is not None else rows).withColumn("batch", F.lit(name)).hint("rebalance", "event_date")
    rows.write.option("maxRecordsPerFile", max_records_per_file).partitionBy("event_date", "batch").parquet(f"{staged}/new")
    spark.createDataFrame(folders, "day string, batch string").coalesce(1).write.parquet(f"{staged}/list")
    files.make(lists(path))
    # From here on the merged rows count.
    files.move(f"{staged}/list", f"{lists(path)}/{name}")
    _move_in(spark, files, path, name)


def _move_in(spark: SparkSession, files: Files, path: str, name: str) -> None:
    """Remove the folders that a merge stands for and move its own in, day by day; a second try goes on where the first ended."""
    staged = aside(path, name)
    for r in spark.read.parquet(f"{lists(path)}/{name}").collect():
        files.delete(f"{path}/event_date={r['day']}/batch={r['batch']}")
    for day in files.names(f"{staged}/new"):
        if day.startswith("event_date="):
            if files.exists(f"{staged}/new/{day}/batch={name}"):
                files.make(f"{path}/{day}")
                files.move(f"{staged}/new/{day}/batch={name}", f"{path}/{day}/batch={name}")
            files.delete(f"{staged}/new/{day}")
    files.delete(staged)


def finish_merges(spark: SparkSession, path: str) -> None:
    """Bring merges that broke off to their end: those with a list move in, what others wrote goes."""
    files = Files(spark, path)
    for name, days in state(files, path):
        if days is not None:
            _move_in(spark, files, path, name)
    for name in files.names(path):
        if name.startswith("_merging-"):
            files.delete(f"{path}/{name}")
