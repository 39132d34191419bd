"""Streaming jobs run to the end over the test tables, read back as batch results."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from idwarden.constants import MFA_WINDOW_SEC
from idwarden.operators.logins import mfa_bypass_all_apps
from idwarden.sources import Sources
from idwarden.sources.events_view import messages_from_events, read_events, sources_from_events
from idwarden.sources.merged import read_days
from idwarden.sources.readers import list_files
from idwarden.streaming import jobs, late
from idwarden.streaming.folders import run_folder


def _streamed(spark: SparkSession, sf_dir: str) -> Sources:
    layout = read_events(spark, sf_dir).schema
    return sources_from_events(spark.readStream.schema(layout).parquet(f"{sf_dir}/events*.parquet"))


def _finished(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    folder = run_folder(spark, name)
    cores = spark.sparkContext.defaultParallelism
    jobs.append_stream(rows, f"{folder}/out", f"{folder}/checkpoint", state_partitions=cores).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def _in_two_runs(spark: SparkSession, sf_dir: str, folder: str, start: Callable[[Sources], StreamingQuery]) -> None:
    """Run a job twice: on the events of even ids, then, of the same days, on the others."""
    events = read_events(spark, sf_dir)
    for odd in (0, 1):
        events.where(F.col("event_id") % 2 == odd).write.mode("append").parquet(f"{folder}/in")
        start(sources_from_events(spark.readStream.schema(events.schema).parquet(f"{folder}/in"))).awaitTermination()


def ingest_app_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages of three deliveries, the second under older names and the third with broken lines; and how many those were."""
    folder = run_folder(spark, "ingest")
    payload = messages_from_events(read_events(spark, sf_dir), "app_usage").select("payload")
    number = F.regexp_extract("payload", r'"usage_id":"u(\d+)"', 1).cast("long")
    older = F.regexp_replace("payload", '"ts":', '"timestamp":')
    broken = F.explode(F.when(number % 10 == 0, F.array("payload", F.lit("{broken"))).otherwise(F.array("payload")))
    for third, shown in enumerate((F.col("payload"), older, F.explode(F.array("payload")))):
        payload.where(number % 3 == third).select(shown.alias("value")).write.mode("append").text(f"{folder}/in")
        if third == 2:
            payload.select(broken.alias("value")).where("value = '{broken'").write.mode("append").text(f"{folder}/in")
        rows = jobs.source_stream(spark, "app_usage", f"{folder}/in", fmt="json")
        jobs.ingest(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    n_bad = spark.read.parquet(jobs.bad_lines(f"{folder}/out")).count()
    back = spark.read.parquet(f"{folder}/out").drop("batch").withColumn("n_bad", F.lit(n_bad).cast("bigint"))
    return back.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


def distinct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory events of even ids, then all of them, then all again a year on or without a time: each is kept once, as it came first."""
    folder = run_folder(spark, "distinct")
    directory = sources_from_events(read_events(spark, sf_dir)).directory
    number = F.substring("event_id", 2, 20).cast("long")
    moved = directory.withColumn("ts", F.when(number % 3 > 0, F.col("ts") + F.make_dt_interval(days=F.lit(365))))
    for part in (directory.where(number % 2 == 0), directory, moved):
        part.write.mode("append").parquet(f"{folder}/in")
        rows = jobs.source_stream(spark, "ad", f"{folder}/in", fmt="parquet", typed=True)
        jobs.ingest(rows, f"{folder}/out", f"{folder}/checkpoint", event_id="event_id").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(*directory.columns)


def merged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App usage that came in twelve batches, whose folders were merged after the eighth and the twelfth."""
    folder = run_folder(spark, "batches")
    app = sources_from_events(read_events(spark, sf_dir)).app
    number = F.substring("usage_id", 2, 20).cast("long") % 12
    for first, last in ((0, 7), (8, 11)):
        app.where(number.between(first, last)).repartition(last - first + 1).write.mode("append").parquet(f"{folder}/in")
        rows = jobs.source_stream(spark, "app_usage", f"{folder}/in", fmt="parquet", typed=True, files_per_trigger=1)
        jobs.ingest(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        jobs.merge_days(spark, f"{folder}/out", least_folders=2)
    crowded = list_files(spark, f"{folder}/out").groupBy(F.regexp_extract("path", "event_date=([^/]+)", 1)).count().where("count > 2")
    if not crowded.isEmpty():
        raise RuntimeError("a day has more than two files")
    return read_days(spark, f"{folder}/out").select(*app.columns)


def bypass_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _streamed(spark, sf_dir)
    return _finished(spark, jobs.bypass_stream(src.logins, src.app), "bypass")


def late_bypass_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bypass pairs of three deliveries, of which each spans all days, so the later ones come after the watermark; repairs add what the stream dropped."""
    folder = run_folder(spark, "late")
    out, repaired, events = f"{folder}/out", f"{folder}/repaired", read_events(spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    for part in range(3):
        new = events.where(F.col("event_id") % 3 == part)
        new.write.mode("append").parquet(f"{folder}/in")
        src = sources_from_events(spark.readStream.schema(events.schema).parquet(f"{folder}/in"))
        query = jobs.append_stream(jobs.bypass_stream(src.logins, src.app), out, f"{folder}/checkpoint", state_partitions=cores)
        query.awaitTermination()
        src, before = sources_from_events(new), late.watermark(query)
        days = sorted({*late.late_days(src.logins, before), *late.late_days(src.app, before, back_sec=MFA_WINDOW_SEC)})
        whole = mfa_bypass_all_apps(sources_from_events(spark.read.parquet(f"{folder}/in")))
        late.repair(spark.read.schema(whole.schema).parquet(out), whole, "mfa_failure_time", days, repaired, f"delivery{part}")
    return spark.read.schema(whole.schema).parquet(out).unionByName(late.repairs(whole, repaired))


def shadow_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _streamed(spark, sf_dir)
    requests = sources_from_events(read_events(spark, sf_dir)).requests
    return _finished(spark, jobs.shadow_stream(src.directory, requests, src.app), "shadow")


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "daily")
    _in_two_runs(spark, sf_dir, folder, lambda src: jobs.count_days(src.directory, f"{folder}/out", f"{folder}/checkpoint"))
    return jobs.read_day_counts(spark, f"{folder}/out")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "sessions")
    _in_two_runs(spark, sf_dir, folder, lambda src: jobs.collect_sessions(src.app, f"{folder}/out", f"{folder}/checkpoint"))
    return jobs.read_sessions(spark, f"{folder}/out")
