"""Which input files have been processed, by which run.

A ledger is a folder of Parquet rows (path, length, modificationTime, run_id, state) that only grows. A run that takes files writes them
as ``taken`` before it fills its tables, and as ``done`` after. A run that failed in between is thereby known: the next start
repeats it with the same files and run id, so its tables are replaced and not doubled. A file counts as done at the
length and time of change at which it was read: one that was written again since is new.

Rows with a path alone, as older ledgers have them, stand for the file whatever its length. One job per ledger runs at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.sources.readers import list_files

SCHEMA = "path string, length long, modificationTime timestamp, run_id string, state string"
FILE = ("path", "length", "modificationTime")
TAKEN, DONE = "taken", "done"


@dataclass(frozen=True)
class Run:
    run_id: str
    files: list[str]


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def unseen(self, listing: DataFrame) -> DataFrame:
        """Files of ``listing`` (path, length, modificationTime) that no run has done or taken as they are now."""
        known = self.rows().select(*(F.col(c).alias(f"_{c}") for c in FILE)).distinct()
        same = (F.col("path") == F.col("_path")) & (
            F.col("_length").isNull() | ((F.col("length") == F.col("_length")) & (F.col("modificationTime") == F.col("_modificationTime"))))
        return listing.select(*FILE).join(known, same, "left_anti")

    def unfinished(self) -> list[Run]:
        """Runs that took files and did not end."""
        rows = self.rows().where(F.col("state").isNotNull())
        open_runs = rows.groupBy("run_id").agg(F.count_if(F.col("state") == DONE).alias("done"), F.sort_array(F.collect_set("path")).alias("files"))
        return [Run(r["run_id"], r["files"]) for r in open_runs.where("done = 0").orderBy("run_id").collect()]

    def take(self, listing: DataFrame, run_id: str | None = None) -> Run | None:
        """Take the unseen files of ``listing`` for a new run; None if there are none.

        The names of the files pass through the driver, as they do when Spark lists a folder.
        """
        run_id = run_id or uuid.uuid4().hex
        if self.rows().where(F.col("run_id") == run_id).limit(1).count():
            run_id = f"{run_id}-{uuid.uuid4().hex[:8]}"  # rows of the run that bore the name stay
        files = [tuple(r) for r in self.unseen(listing).collect()]
        if not files:
            return None
        self._write([(*f, run_id, TAKEN) for f in files])
        return Run(run_id, sorted(f[0] for f in files))

    def finish(self, run: Run) -> None:
        taken = self.rows().where((F.col("run_id") == run.run_id) & (F.col("state") == TAKEN))
        self._write([(*(r[c] for c in FILE), run.run_id, DONE) for r in taken.distinct().collect()])

    def _write(self, rows: list[tuple]) -> None:
        # One file, so that it is there as a whole or not at all.
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path (as Spark lists it), length and modificationTime of a file, or of the files of a folder."""
    return list_files(spark, path).select(*FILE)
