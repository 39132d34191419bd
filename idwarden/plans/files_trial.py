"""Queries through files: sources written to a folder, read back by the job's own readers and writers."""

import uuid
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.constants import SOURCE_KEYS, TABLES
from idwarden.operators.access import unrequested_escalations
from idwarden.plans import job
from idwarden.plans.ledger import Ledger, listed
from idwarden.plans.partials import FROM_PARTIALS, Store
from idwarden.plans.registry import of_days
from idwarden.plans.sinks import read_table, write_csv, write_source, write_table
from idwarden.sources import Sources, has_column, is_empty, load_sources, read_csv, source_for_file
from idwarden.sources.events_view import read_events, sources_from_events
from idwarden.streaming.folders import run_folder


def _written(src: Sources, folder: str, keys=SOURCE_KEYS) -> None:
    for key in keys:
        write_source(src.get(key), folder, key, batch="first")


def day_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables for the days up to one in the middle and for those after it, as (kind, user, ts, detail)."""
    folder = run_folder(spark, "days")
    src = sources_from_events(read_events(spark, sf_dir))
    _written(src, folder)
    load = partial(load_sources, spark, folder)
    middle = src.hr.agg(F.min("termination_date").cast("string").alias("d")).first()["d"]
    after = str(spark.sql("SELECT CAST(:d AS DATE) + 1 AS d", args={"d": middle}).first()["d"])

    def rows(first, last):
        def of(key, kind, ts, detail):
            return of_days(key, first, last, load).select(F.lit(kind).alias("kind"), "user", F.col(ts).alias("ts"), detail.alias("detail"))

        return (
            of("privilege_escalation_table", "escalation", "ts", F.col("event_id"))
            .unionByName(of("orphan_event_table", "orphan", "ts", F.concat_ws(":", "missing_kind", "event_id")))
            .unionByName(of("mfa_table", "bypass", "mfa_failure_time", F.concat_ws(":", "app_accessed", "seconds_after_failure")))
        )

    return rows(None, middle).unionByName(rows(after, None))


def merged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables without days, merged from partials per day after two deliveries, as (kind, name, detail).

    The second delivery adds new days and late events of some days; only those are read for it.
    """
    folder = run_folder(spark, "partials")
    src = sources_from_events(read_events(spark, sf_dir))
    _written(src, folder, ["hrlifecycle"])
    store = Store(spark, folder, f"{folder}/partials")
    sources = ("okta", "saviynt", "ad", "app_usage")
    middle = src.hr.agg(F.min("termination_date").alias("d")).scalar()
    late = (F.dayofmonth("ts") % 8 == 0) & (F.second("ts") % 2 == 0)
    first = (F.to_date("ts") <= middle) & ~late
    for delivery, chosen in (("first", first), ("second", ~first)):
        for source in sources:
            write_source(src.get(source).where(chosen), folder, source, batch=delivery)
        outcomes = job.run(partial(load_sources, spark, folder), job.Sink(f"{folder}/gold"), keys=list(FROM_PARTIALS), run_id="today", store=store)
        if failed := [o.error for o in outcomes if o.error]:
            raise RuntimeError(failed[0])

    def shown(key, kind, name, *details):
        return read_table(spark, f"{folder}/gold", TABLES[key]).select(
            F.lit(kind).alias("kind"), F.col(name).alias("name"), F.concat_ws(":", *(F.col(c).cast("string") for c in details)).alias("detail"))

    return (
        shown("role_drift_table", "role", "user", "role", "n", "n_roles", "first_role", "last_role", "drift")
        .unionByName(shown("stale_access_table", "stale", "user", "app", "days_idle", "never_used"))
        .unionByName(shown("suspicious_approver_table", "approver", "approver", "decisions", "approvals", "self_approvals", "requesters", "suspicious"))
        .unionByName(shown("ad_churn_table", "churn", "group", "week", "adds", "removes", "escalations", "distinct_users"))
        .unionByName(shown("orphan_user_table", "orphan", "user", "reason", "n_events"))
        .unionByName(shown("risk_table", "risk", "user", "risk_score", "unique_countries", "total_logins", "unexplained_app_usage"))
    )


def two_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App usage of which half the files hold text under older names."""
    folder = run_folder(spark, "generations")
    app = sources_from_events(read_events(spark, sf_dir)).app
    even = F.substring("usage_id", 2, 20).cast("long") % 2 == 0
    texts = app.select(*(F.col(c).cast("string").alias(c) for c in app.columns))
    for part in (texts.where(even), texts.where(~even).withColumnRenamed("ts", "timestamp")):
        part.write.mode("append").parquet(f"{folder}/source/app_usage")
    return load_sources(spark, folder).app


def _filled(load, sink: job.Sink, run_id: str, keys: list[str]) -> None:
    outcomes = job.run(load, sink, keys=keys, run_id=run_id)
    if failed := [o.error for o in outcomes if o.error]:
        raise RuntimeError(failed[0])


def _deliveries(spark: SparkSession, sf_dir: str, folder: str, n: int):
    """Write all sources but app usage; then, for each part of app usage, add it and give its number."""
    src = sources_from_events(read_events(spark, sf_dir))
    _written(src, folder, [k for k in SOURCE_KEYS if k != "app_usage"])
    for part in range(n):
        write_source(src.app.where(F.substring("usage_id", 2, 20).cast("long") % n == part), folder, "app_usage", batch=f"delivery{part}")
        yield part


def job_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, filled from two deliveries of app usage by ledger; the second run is repeated."""
    folder = run_folder(spark, "job")
    ledger, files = Ledger(spark, f"{folder}/ledger"), f"{folder}/source/app_usage"
    for part in _deliveries(spark, sf_dir, folder, 2):
        run = ledger.take(listed(spark, files))
        for _ in range(1 + part):
            _filled(partial(load_sources, spark, folder, "app_usage", run.files, unique=True), job.Sink(f"{folder}/gold"), run.run_id, ["impossible_table"])
        ledger.finish(run)
    if ledger.take(listed(spark, files)) is not None:
        raise RuntimeError("files were not recorded")
    return read_table(spark, f"{folder}/gold", TABLES["impossible_table"]).drop("run_id")


def failed_run_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table from three deliveries by ledger. The run of the second wrote some rows and failed; it is repeated after the third came."""
    folder = run_folder(spark, "ledger")
    ledger, sink, key = Ledger(spark, f"{folder}/ledger"), job.Sink(f"{folder}/gold"), "impossible_table"
    for part in _deliveries(spark, sf_dir, folder, 3):
        todo = [*ledger.unfinished(), ledger.take(listed(spark, f"{folder}/source/app_usage"))]
        if part == 1:
            # The files are taken, half of the rows are in the table, and nothing is finished.
            half = of_days(key, None, None, partial(load_sources, spark, folder, "app_usage", todo[0].files))
            sink.write(half.where(F.hash("user") % 2 == 0), TABLES[key], todo[0].run_id)
            continue
        for run in todo:
            _filled(partial(load_sources, spark, folder, "app_usage", run.files), sink, run.run_id, [key])
            ledger.finish(run)
    return read_table(spark, f"{folder}/gold", TABLES[key]).drop("run_id")


def all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All result tables, filled by the job's command line: their names and numbers of rows."""
    folder = run_folder(spark, "tables")
    _written(sources_from_events(read_events(spark, sf_dir)), folder)
    argv = ["--root", folder, "--source", "okta", "--run_id", "r", "--sink_path", f"{folder}/tables", "--ad_churn_table", "churn", "--parallel", "6"]
    if job.main(argv, spark):
        raise RuntimeError("a table failed")
    counts = []
    for name in {**TABLES, "ad_churn_table": "churn"}.values():
        try:
            rows = read_table(spark, f"{folder}/tables", name)
        except AnalysisException:  # a table without rows has no files
            rows = spark.range(0)
        counts.append(rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, counts)


def _growing(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Escalations of even ids without a column, none at all, and those of odd ids with it."""
    found = unrequested_escalations(sources_from_events(read_events(spark, sf_dir)))
    odd = F.substring("event_id", 2, 20).cast("long") % 2 == 1
    return [found.where(~odd).drop("self_initiated"), found.where(F.lit(False)), found.where(odd)]


def appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table to which rows, no rows, and rows with one more column are added."""
    folder = run_folder(spark, "appended")
    for rows in _growing(spark, sf_dir):
        write_table(rows, "escalations", path=folder)
    return read_table(spark, folder, "escalations")


def catalog_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table of three runs with one more column from the last on, which is repeated after a first try with other rows."""
    schema = f"trial_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{run_folder(spark, 'catalog')}'")
    even, none, odd = _growing(spark, sf_dir)
    sink = job.Sink(catalog=f"spark_catalog.{schema}")
    for run_id, rows in (("a", even), ("b", none), ("c", odd.limit(7).withColumn("event_id", F.lit("lost"))), ("c", odd), ("c", odd), ("b", none)):
        sink.write(rows, "escalations", run_id)
    return spark.table(f"{schema}.escalations").drop("run_id")


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests through a CSV folder, found by the name of the file; the HR file is missing and counts as empty."""
    folder = run_folder(spark, "csv")
    requests = sources_from_events(read_events(spark, sf_dir)).requests
    write_csv(requests.select(*(F.col(c).cast("string").alias(c) for c in requests.columns)), f"{folder}/saviynt_requests.csv")
    frames = {}
    for name in ("saviynt_requests.csv", "hr_lifecycle.csv"):
        source = source_for_file(f"{folder}/{name}")
        frames[source] = read_csv(spark, source, f"{folder}/{name}")
    if not is_empty(frames["hrlifecycle"]) or not has_column(frames["saviynt"], "approver"):
        raise RuntimeError("the missing file is not empty, or a column is missing")
    return frames["saviynt"]
