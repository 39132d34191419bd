"""Incremental ingest and the streaming forms of some detectors.

Watermarks need a zoned timestamp, so event times become the instant with the same UTC clock
on the way in, and come back on the way out. The session time zone should be UTC: in another
one, clock times that a switch to summer time skips do not survive the way.
"""

import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from idwarden import schemas
from idwarden.constants import MAX_RECORDS_PER_FILE, MFA_WINDOW_SEC, PRIVILEGED_GROUPS, SESSION_HOURS, SHADOW_WINDOW_SEC
from idwarden.functions import elapsed, is_failure, seconds
from idwarden.functions.checks import one_of, positive
from idwarden.operators.keyed import without_match
from idwarden.operators.temporal import joined_runs, run_parts
from idwarden.plans.sinks import write_days
from idwarden.sources import normalise, parse_messages
from idwarden.sources.merged import read_days
from idwarden.streaming.compaction import merge_days

#: Folders over which the ids of taken events are spread: a small batch reads those that its ids fall in.
ID_BUCKETS = 64


def source_stream(
    spark: SparkSession, source: str, path: str, *, fmt: str = "json", files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = 10 << 30, typed: bool = False,
) -> DataFrame:
    """A source folder as a stream: JSON messages (one per line), CSV or Parquet, under current or older names.

    Parquet columns are text, or with ``typed`` of the layout's types. A CSV file must have the layout's columns in order: one
    with another header stops the stream. A backlog is taken in batches of ``bytes_per_trigger``.
    """
    one_of("fmt", fmt, ("json", "csv", "parquet"))
    reader = spark.readStream
    if files_per_trigger is not None:
        positive(files_per_trigger=files_per_trigger)
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    elif bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if fmt == "json":
        messages = reader.text(path).withColumnRenamed("value", "payload")
        return normalise(parse_messages(messages, source), source, extra=["_raw"])
    layout = schemas.text_schema(source)
    if fmt == "csv":
        return normalise(reader.schema(layout).option("header", True).option("enforceSchema", False).csv(path), source)
    layout = schemas.BY_SOURCE[source] if typed else layout
    older = {old: new for old, new in schemas.ALIASES[source].items() if old not in layout.names}
    layout = T.StructType([*layout.fields, *(T.StructField(old, layout[new].dataType) for old, new in older.items())])
    return normalise(reader.schema(layout).parquet(path), source)


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, *, max_records_per_file: int = MAX_RECORDS_PER_FILE,
    partition_by: str | None = None, state_partitions: int | None = None,
) -> StreamingQuery:
    """Write all input that is there now, exactly once, and stop.

    The file sink commits a batch's files and its input together, so a rerun after a failure
    neither skips nor repeats a file, and a file that arrives late is taken by the next run.
    ``state_partitions`` sets the partitions of joins and aggregations with state, which adaptive
    execution cannot merge; a checkpoint keeps the number of its first run.
    """
    positive(max_records_per_file=max_records_per_file)
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records_per_file)
        .trigger(availableNow=True)
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if state_partitions is None:
        return writer.start(path)
    # A query copies the session's settings when it starts.
    positive(state_partitions=state_partitions)
    conf, setting = rows.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(setting)
    conf.set(setting, str(state_partitions))
    try:
        return writer.start(path)
    finally:
        conf.set(setting, before)


def in_batches(rows: DataFrame, checkpoint: str, write: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Hand all input that is there now to ``write``, batch by batch, and stop.

    ``write`` gets the rows and the batch's name, which is the same when a batch is tried again: what it writes under that
    name it must replace. Plain files result, without a log of their own, to which other jobs may add.
    """
    label = f"{zlib.crc32(checkpoint.encode()):08x}"

    def one(batch: DataFrame, number: int) -> None:
        write(batch, f"{label}-{number:06d}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bad_lines(path: str) -> str:
    """Where lines that are no message go: readers of ``path`` do not look into it."""
    return f"{path}/_bad"


def ingest(
    rows: DataFrame, path: str, checkpoint: str, *, event_id: str | None = None,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> StreamingQuery:
    """Add normalised event rows under ``event_date=...`` folders, each row once.

    Lines that could not be parsed go to ``bad_lines(path)``. With ``event_id`` an event that came before, in this run or
    any other, is left out, also if it comes with another time or none: a batch is held against the index of all ids taken
    so far (``known_ids``) and against the folders of its days, to which other jobs may have added. However late an event
    comes, it is kept if it is new. Of an id that a batch holds several times, the row with the earliest time stays.
    """
    def write(batch: DataFrame, name: str) -> None:
        if "_raw" in batch.columns:
            bad = batch.where(F.col("_raw").isNotNull()).select("_raw")
            write_days(bad, bad_lines(path), batch=name, max_records_per_file=max_records_per_file)
            batch = batch.where(F.col("_raw").isNull()).drop("_raw")
        if event_id is None:
            write_days(batch, path, batch=name, max_records_per_file=max_records_per_file)
            return
        batch = _new_events(batch, path, event_id, name).persist()
        try:
            _write_ids(batch, path, event_id, name)
            write_days(batch, path, batch=name, max_records_per_file=max_records_per_file)
        finally:
            batch.unpersist()

    return in_batches(rows, checkpoint, write)


def known_ids(path: str) -> str:
    """Where the ids of the events in ``path`` are listed, by bucket of their hash: readers of ``path`` do not look into it."""
    return f"{path}/_ids"


def index_events(spark: SparkSession, path: str, event_id: str) -> None:
    """List the ids of all events that are in ``path`` now, also those that other jobs or earlier versions wrote."""
    _write_ids(spark.read.option("mergeSchema", True).parquet(path), path, event_id, "index")


def _with_bucket(ids: DataFrame, event_id: str) -> DataFrame:
    return ids.withColumn("bucket", F.pmod(F.xxhash64(F.col(event_id).cast("string")), F.lit(ID_BUCKETS)).cast("int"))


def _write_ids(rows: DataFrame, path: str, event_id: str, name: str) -> None:
    ids = _with_bucket(rows.where(F.col(event_id).isNotNull()).select(F.col(event_id).cast("string").alias("id")), "id")
    ids.withColumn("batch", F.lit(name)).hint("rebalance", "bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(known_ids(path))


def _without(rows: DataFrame, path: str, name: str, part: str, ids: str, event_id: str) -> DataFrame:
    """``rows`` whose id is not among ``ids`` of the partitions by ``part`` in ``path`` that the rows fall in.

    What an earlier try of the batch wrote does not count.
    """
    try:
        known = read_days(rows.sparkSession, path).where(F.col("batch") != name)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return rows
    parts = rows.select(F.col(part).alias("_part")).distinct()
    known = known.join(parts, known[part].eqNullSafe(parts["_part"]), "left_semi").select(F.col(ids).cast("string").alias("_known")).distinct()
    return rows.join(known, F.col(event_id).cast("string") == F.col("_known"), "left_anti")


def _new_events(batch: DataFrame, path: str, event_id: str, name: str) -> DataFrame:
    """Rows without an id, and of each new id one row."""
    first = F.min(F.struct(F.col("ts").isNull(), "ts", F.struct(*batch.columns).alias("row"))).alias("first")
    named = batch.where(F.col(event_id).isNotNull()).groupBy(F.col(event_id).alias("_id")).agg(first).select("first.row.*")
    named = _without(_with_bucket(named, event_id), known_ids(path), name, "bucket", "id", event_id).drop("bucket")
    # Only folders of the batch's days are read.
    named = _without(named.withColumn("event_date", F.to_date("ts")), path, name, "event_date", event_id, event_id)
    return named.select(*batch.columns).unionByName(batch.where(F.col(event_id).isNull()))


def _event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    instant = F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone())
    return df.withColumn(ts, instant).withWatermark(ts, delay)


def _clock(instant) -> Column:
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def _untimed(df: DataFrame, *columns: str) -> DataFrame:
    """Event times back to the zoneless type of the batch results."""
    return df.withColumns({c: _clock(c) for c in columns})


def _band_stream_join(
    left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, lo: int, hi: int, delay: str, chunk_sec: int,
) -> DataFrame:
    """Stream-stream inner join with ``lo <= right_ts - left_ts <= hi`` seconds.

    Rows meet per (key, chunk of ``chunk_sec``), which spreads the state of a busy key; a left row goes to all chunks of its
    range. The plain range on the event times lets Spark drop state that can no longer match; it is up to a second wider at both
    ends, as times count in whole seconds: a right row earlier in the same second is 0 seconds away. Rows that come later than
    ``delay`` are dropped; the query's progress counts them (``numRowsDroppedByWatermark``).
    """
    positive(chunk_sec=chunk_sec)
    width = min(chunk_sec, hi - lo + 1)

    def chunk(ts: str, shift: int) -> Column:
        return F.floor((seconds(ts) + F.lit(shift)) / F.lit(width))

    near = _event_time(left, left_ts, delay).withColumn("_chunk", F.explode(F.sequence(chunk(left_ts, lo), chunk(left_ts, hi))))
    far = _event_time(right, right_ts, delay).withColumn("_r_chunk", chunk(right_ts, 0)).withColumnRenamed(on, "_r_key")
    alive = (F.col(right_ts) >= F.col(left_ts) + F.make_dt_interval(secs=F.lit(lo - 1))) & (
        F.col(right_ts) <= F.col(left_ts) + F.make_dt_interval(secs=F.lit(hi + 1))
    )
    match = (
        (F.col(on) == F.col("_r_key")) & (F.col("_chunk") == F.col("_r_chunk"))
        & alive & elapsed(right_ts, left_ts).between(lo, hi)
    )
    return _untimed(near.join(far, match).drop("_chunk", "_r_chunk", "_r_key"), left_ts, right_ts)


def bypass_stream(
    logins: DataFrame, app: DataFrame, *, window_sec: int = MFA_WINDOW_SEC, delay: str = "1 hour", chunk_sec: int = 900,
) -> DataFrame:
    """Every app access of a user within the window after a failed login, from two streams."""
    positive(window_sec=window_sec)
    failed = logins.where(is_failure("status")).select(
        "user", F.col("ts").alias("mfa_failure_time"), F.col("status").alias("failure_reason")
    )
    access = app.select(
        "user", F.col("app").alias("app_accessed"), F.col("ts").alias("app_access_time"),
        F.col("session_id").alias("app_session_id"), F.col("duration").alias("app_usage_duration_sec"),
    )
    joined = _band_stream_join(failed, access, "user", "mfa_failure_time", "app_access_time", 1, window_sec, delay, chunk_sec)
    return joined.withColumn("seconds_after_failure", elapsed("app_access_time", "mfa_failure_time"))


def shadow_stream(
    directory: DataFrame, requests: DataFrame, app: DataFrame, *, privileged_groups=PRIVILEGED_GROUPS,
    window_sec: int = SHADOW_WINDOW_SEC, delay: str = "1 hour", chunk_sec: int = 3600,
) -> DataFrame:
    """Shadow access with streaming grants and usage; ``requests`` is a static table."""
    positive(window_sec=window_sec)
    grants = without_match(
        directory.where(F.col("group").isin(*privileged_groups)), requests, {"request_id": "req_id"}
    ).select(
        "user", F.col("group").alias("privileged_group_gained"), F.col("ts").alias("time_of_privilege_grant"),
        F.col("initiator").alias("granted_by"),
    )
    usage = app.select("user", F.col("app").alias("app_accessed"), F.col("ts").alias("time_of_app_access"))
    return _band_stream_join(
        grants, usage, "user", "time_of_privilege_grant", "time_of_app_access", 0, window_sec, delay, chunk_sec
    )


def count_days(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the events per user and day of ``rows`` in ``path``: each batch adds its own counts, however late its events."""
    def write(batch: DataFrame, name: str) -> None:
        write_days(batch.groupBy(F.to_date("ts").cast("timestamp_ntz").alias("ts"), "user").agg(F.count("*").alias("n")), path, batch=name)

    return in_batches(rows.select("user", "ts"), checkpoint, write)


def read_day_counts(spark: SparkSession, path: str) -> DataFrame:
    """Events per user and day so far, days that are not over included. Events without a time count for day NULL."""
    parts = read_days(spark, path)
    return parts.groupBy(F.col("ts").alias("day_start"), "user").agg(F.sum("n").alias("n"))


def merge_day_counts(spark: SparkSession, path: str, **options) -> int:
    """Merge the small folders of ``count_days``: one row per user and day is left of those of many batches."""
    return merge_days(spark, path, combine=lambda parts: parts.groupBy("event_date", "ts", "user").agg(F.sum("n").alias("n")), **options)


def collect_sessions(rows: DataFrame, path: str, checkpoint: str, *, gap_hours: float = SESSION_HOURS) -> StreamingQuery:
    """Keep parts of runs of a user's events in ``path``: each batch adds those of its own events, which ``read_sessions`` joins.

    A part is what a user did in an hour (or in the gap, if that is shorter), so a busy user is no single task.
    """
    def write(batch: DataFrame, name: str) -> None:
        parts = run_parts(batch, ["user"], "ts", int(gap_hours * 3600))
        write_days(parts.select("user", F.col("first").alias("ts"), "last", "n"), path, batch=name)

    return in_batches(rows.select("user", "ts"), checkpoint, write)


def read_sessions(spark: SparkSession, path: str, *, gap_hours: float = SESSION_HOURS) -> DataFrame:
    """Runs of a user's events without a pause of the gap, so far; the parts of all batches in an hour are first made one."""
    gap_sec = int(gap_hours * 3600)
    parts = run_parts(read_days(spark, path), ["user"], "ts", gap_sec, F.col("n"))
    return joined_runs(parts, ["user"], gap_sec).select(
        "user", F.col("first").alias("session_start"), (F.col("last") + F.make_dt_interval(secs=F.lit(gap_sec))).alias("session_end"), "n"
    )
