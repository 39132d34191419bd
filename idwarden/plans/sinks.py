"""Writers for result tables and source folders."""

import posixpath
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from idwarden.constants import MAX_RECORDS_PER_FILE
from idwarden.functions.checks import positive


def write_table(
    df: DataFrame, table: str, *, path: str | None = None, fmt: str = "parquet", run_id: str | None = None,
    options: dict[str, str] | None = None, max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> int:
    """Add ``df`` to ``table`` and return the number of rows written. Rows are computed once, and counted while they are written.

    Files go to ``<path>/<table>``, by way of a folder that readers pass over: they appear there only when all are written, and not at
    all if there are no rows. With ``run_id`` they are the folder ``run_id=<id>`` of the table, which a rerun replaces (also by
    nothing), so a repeated run adds nothing twice. Without it they are added to those in the table's folder.

    A connector without files takes ``path=None`` and finds the table in its options, where ``{table}`` stands for the name. It gets
    ``run_id`` as a column, by which rows of an earlier try can be told; ``write_catalog_table`` replaces them where a catalog can.
    """
    positive(max_records_per_file=max_records_per_file)
    if path is None:
        counted = Observation()
        rows = df if run_id is None else df.withColumn("run_id", F.lit(run_id))
        writer = rows.observe(counted, F.count(F.lit(1)).alias("n")).write.format(fmt)
        for key, value in (options or {}).items():
            writer = writer.option(key, value.replace("{table}", table))
        writer.mode("append").save()
        return counted.get.get("n", 0)

    target = posixpath.join(path, table)
    staged = posixpath.join(target, f"_staged-{uuid.uuid4().hex}")
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("n")).write.format(fmt).option("maxRecordsPerFile", max_records_per_file)
    for key, value in (options or {}).items():
        writer = writer.option(key, value.replace("{table}", table))
    files = Files(df.sparkSession, target)
    try:
        writer.save(staged)
        n = counted.get.get("n", 0)
        if run_id is not None:
            files.replace(staged if n else None, posixpath.join(target, f"run_id={run_id}"))
        elif n:
            files.add(staged, target)
        return n
    finally:
        files.delete(staged)
        files.delete_if_empty(target)


class Files:
    """Moves of folders on the file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def replace(self, staged: str | None, target: str) -> None:
        """Put ``staged`` (None: nothing) in the place of ``target``; what was there stays aside until then."""
        old = f"{posixpath.dirname(target)}/_old-{uuid.uuid4().hex}"
        kept = self._fs.exists(self._path(target))
        if kept:
            self.move(target, old)
        if staged is not None:
            self.move(staged, target)
        if kept:
            self.delete(old)

    def add(self, staged: str, target: str) -> None:
        """Move the files of ``staged`` into ``target``."""
        for status in self._fs.listStatus(self._path(staged)):
            name = status.getPath().getName()
            if not name.startswith(("_", ".")):
                self.move(f"{staged}/{name}", f"{target}/{name}")

    def names(self, folder: str) -> list[str]:
        """What lies in a folder, in order of names; nothing if there is no such folder."""
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(folder)))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(folder))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def delete_if_empty(self, path: str) -> None:
        if self._fs.exists(self._path(path)) and not self._fs.listStatus(self._path(path)):
            self.delete(path)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def write_catalog_table(df: DataFrame, table: str, run_id: str, *, fmt: str = "parquet") -> int:
    """Make ``df`` the rows of ``run_id`` in a catalog table, and return their number.

    The table is created, split by ``run_id``, if there is none; columns that it lacks are added to it, and are NULL in earlier
    runs. A rerun replaces its rows in one commit: a filter in a catalog of its own, a partition in the session's catalog.
    """
    spark = df.sparkSession
    name, counted = _quoted(table), Observation()
    rows = df.withColumn("run_id", F.lit(run_id)).observe(counted, F.count(F.lit(1)).alias("n"))
    if not spark.catalog.tableExists(name):
        df.limit(0).withColumn("run_id", F.lit(run_id)).write.format(fmt).partitionBy("run_id").saveAsTable(name)
    known = {f.name.lower() for f in spark.table(name).schema}
    if new := [f for f in df.schema if f.name.lower() not in known]:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    columns = [f.name for f in spark.table(name).schema if f.name != "run_id"]
    has = {c.lower() for c in df.columns}
    aligned = [F.col(f"`{c}`") if c.lower() in has else F.lit(None).alias(c) for c in columns]
    if spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Catalog' AND data_type <> 'spark_catalog'").count():
        rows.select(*aligned, "run_id").writeTo(name).overwrite(F.col("run_id") == run_id)
        return counted.get.get("n", 0)
    view = f"rows_{uuid.uuid4().hex}"
    rows.select(*aligned).createOrReplaceTempView(view)
    try:
        literal = run_id.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (run_id = '{literal}') SELECT * FROM {view}")
        n = counted.get.get("n", 0)
        if not n:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (run_id = '{literal}')")
        return n
    finally:
        spark.catalog.dropTempView(view)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A Parquet result table over all its runs; columns added by later runs are NULL in earlier ones."""
    return spark.read.option("mergeSchema", True).parquet(posixpath.join(path, table))


def write_csv(df: DataFrame, path: str, *, header: bool = True) -> None:
    """A CSV folder; Spark makes the folders above it."""
    df.write.option("header", header).mode("overwrite").csv(path)


def write_source(
    df: DataFrame, root: str, source: str, *, batch: str | None = None, max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Add normalised event rows to a source folder, split by day so that reads prune."""
    write_days(df, posixpath.join(root, "source", source), batch=batch, max_records_per_file=max_records_per_file)


def write_days(df: DataFrame, path: str, *, batch: str | None = None, max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Add rows below ``event_date=.../batch=...``; rows without ``ts`` go to ``batch=...`` alone.

    ``batch`` names what is written: writing the same batch again replaces its folders, so a retry adds nothing twice. Rows are
    dealt by day before they are written; a day that is large gets several tasks and files.
    """
    positive(max_records_per_file=max_records_per_file)
    rows, by = df.withColumn("batch", F.lit(batch or uuid.uuid4().hex)), ["batch"]
    if "ts" in df.columns:
        rows, by = rows.withColumn("event_date", F.to_date("ts")).hint("rebalance", "event_date"), ["event_date", "batch"]
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
    out.partitionBy(*by).parquet(path)
