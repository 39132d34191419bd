"""Readers: raw files in, fixed source layout out."""

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden import schemas
from idwarden.constants import CSV_SOURCES
from idwarden.sources.merged import read_days
from idwarden.sources.normalise import normalise, parse_messages, shaped_field


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def is_empty(df: DataFrame) -> bool:
    """Runs a job; meant for the runner, never for a detector."""
    return df.isEmpty()


def empty_source(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame([], schemas.BY_SOURCE[source])


def source_for_file(path: str) -> str | None:
    """Source key of a CSV file by its name, ``None`` for a file that belongs to no source."""
    return CSV_SOURCES.get(posixpath.basename(path))


def _or_empty(spark, source, load):
    """A path that does not exist gives an empty source; every other error is raised."""
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_source(spark, source)


def read_parquet(
    spark: SparkSession, source: str, path: str | list[str], *, merge_schema: bool = True, keep_file: bool = False,
    first_day: str | None = None, last_day: str | None = None, day_folders: list[str | None] | None = None,
) -> DataFrame:
    """A source from one Parquet file, several, a folder or a glob.

    Files may hold typed columns or all-string columns, under current or older names; both end in the fixed layout.
    ``merge_schema`` reads every footer, in a Spark job; it can be left out where all files of a folder have the same columns.
    ``first_day`` and ``last_day`` (``yyyy-MM-dd``) keep the events of those days; where the folder is
    split by ``event_date`` the other days are not read. Events without a time belong to the range without a first day.
    ``day_folders`` names folders to read (None: events without a time), if there are any. Lines that ingest could not parse are left out.
    """
    def load():
        if isinstance(path, str):
            raw = read_days(spark, path, merge_schema=merge_schema)
        else:
            raw = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*path)
        if day_folders is not None and "event_date" in raw.columns:
            named = F.col("event_date").cast("date").isin(*(F.lit(d).cast("date") for d in day_folders if d is not None))
            raw = raw.where(named | F.col("event_date").isNull() if None in day_folders else named)
        return from_raw(raw, source, first_day=first_day, last_day=last_day, keep_file=keep_file)

    return _or_empty(spark, source, load)


def from_raw(
    raw: DataFrame, source: str, *, first_day: str | None = None, last_day: str | None = None, keep_file: bool = False,
) -> DataFrame:
    """The layout of ``source`` from its files' rows, of the days asked for."""
    if "_raw" in raw.columns:
        raw = raw.where(F.col("_raw").isNull())
    if "ts" in schemas.BY_SOURCE[source].fieldNames() and (first_day or last_day):
        day = F.col("event_date").cast("date") if "event_date" in raw.columns else F.to_date(shaped_field(raw, source, "ts"))
        if first_day is not None:
            raw = raw.where(day >= F.lit(first_day).cast("date"))
        if last_day is not None:
            early = day <= F.lit(last_day).cast("date")
            raw = raw.where(early if first_day is not None else early | day.isNull())
    if keep_file:
        raw = raw.select("*", F.col("_metadata.file_path").alias("source_file"))
    return normalise(raw, source, extra=["source_file"] if keep_file else [])


def read_csv(spark: SparkSession, source: str, path: str) -> DataFrame:
    """A source from CSV with a header. Columns are taken by name; undecodable bytes are replaced."""
    def load():
        raw = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", False).csv(path)
        return normalise(raw, source)

    return _or_empty(spark, source, load)


def read_json_lines(spark: SparkSession, source: str, path: str) -> DataFrame:
    """A source from text files with one JSON message per line; bad lines keep their text in ``_raw``."""
    def load():
        messages = spark.read.text(path).withColumnRenamed("value", "payload")
        return normalise(parse_messages(messages, source), source, extra=["_raw"])

    return _or_empty(spark, source, load)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below ``folder`` as (path, modificationTime, length); their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(folder).select("path", "modificationTime", "length")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Paths recorded so far; none when there is no ledger yet."""
    try:
        return spark.read.schema("path string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")


def record_files(files: DataFrame, ledger: str) -> None:
    """Add processed files to the ledger, after their rows are written, so that a failed run is repeated."""
    files.select("path").write.mode("append").parquet(ledger)


def unseen_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not hold; both have a column ``path``.

    All unseen files are returned, so none is skipped when several arrive between two runs.
    """
    return listing.join(ledger.select("path").distinct(), "path", "left_anti")
