"""Detectors on links between the systems: unknown keys, unknown users, impossible order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idwarden.functions import elapsed
from idwarden.operators.keyed import without_match
from idwarden.sources import Sources


def orphan_events(src: Sources) -> DataFrame:
    """Events that name a request nobody made or a session nobody opened."""
    app_requests = src.app.where(F.col("request_id").isNotNull()).select(
        F.lit("app").alias("source"), F.col("usage_id").alias("event_id"), "user", "ts",
        F.lit("request").alias("missing_kind"), F.col("request_id").alias("missing_key"),
    )
    directory_requests = src.directory.where(F.col("request_id").isNotNull()).select(
        F.lit("directory").alias("source"), "event_id", "user", "ts",
        F.lit("request").alias("missing_kind"), F.col("request_id").alias("missing_key"),
    )
    app_sessions = src.app.where(F.col("session_id").isNotNull()).select(
        F.lit("app").alias("source"), F.col("usage_id").alias("event_id"), "user", "ts",
        F.lit("session").alias("missing_kind"), F.col("session_id").alias("missing_key"),
    )
    opened = src.logins.where(F.col("status") == "SUCCESS")
    linked = app_requests.unionByName(directory_requests)
    # The keys are set by the filters above, so the joins see no missing key.
    return without_match(linked, src.requests, {"missing_key": "req_id"}).unionByName(
        without_match(app_sessions, opened, {"missing_key": "session_id"})
    )


def daily_activity(events: DataFrame, *by: str) -> DataFrame:
    """Events per user and day; what HR dates can be held against without keeping single events.

    HR dates mark midnights, so a day is wholly before or after one, except that the events after
    midnight of the termination day count as late: they are counted apart.
    """
    past_midnight = F.col("ts") > F.to_date("ts").cast("timestamp_ntz")
    return events.where(F.col("ts").isNotNull()).groupBy(*by, "user", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count_if(past_midnight).alias("n_past_midnight"),
        F.min(F.when(past_midnight, F.col("ts"))).alias("first_past_midnight"),
    )


def employment(hr: DataFrame) -> DataFrame:
    """user, join_date and termination_date, one row for each user, however often HR delivered it.

    Of several rows the one that joined last counts; of these the open one, else the one that ends last.
    """
    latest = F.max(F.struct("join_date", F.col("termination_date").isNull().alias("open"), "termination_date")).alias("_latest")
    return hr.where(F.col("user").isNotNull()).groupBy("user").agg(latest).select(
        "user", "_latest.join_date", "_latest.termination_date")


def against_lifecycle(activity: DataFrame, hr: DataFrame) -> DataFrame:
    """Daily activity that HR does not cover, with a ``reason``.

    ``unknown``: the user has no HR row. ``outside_lifecycle``: the part of the day before the join
    date or after the termination date. The plain join lets Spark broadcast a small HR table and
    otherwise split the days of a busy user over tasks.
    """
    dates = employment(hr).withColumn("known", F.lit(True))
    outside = (F.col("day") < F.col("join_date")) | (F.col("day") > F.col("termination_date"))
    past_last_midnight = (F.col("day") == F.col("termination_date")) & (F.col("n_past_midnight") > 0)
    part = F.col("reason") == "part_of_day"
    return (
        activity.join(dates, "user", "left")
        .withColumn(
            "reason",
            F.when(F.col("known").isNull(), "unknown").when(outside, "outside_lifecycle").when(past_last_midnight, "part_of_day"),
        )
        .where(F.col("reason").isNotNull())
        .withColumn("n", F.when(part, F.col("n_past_midnight")).otherwise(F.col("n")))
        .withColumn("first_ts", F.when(part, F.col("first_past_midnight")).otherwise(F.col("first_ts")))
        .withColumn("reason", F.when(part, "outside_lifecycle").otherwise(F.col("reason")))
        .drop("n_past_midnight", "first_past_midnight", "join_date", "termination_date", "known")
    )


def orphan_users(src: Sources) -> DataFrame:
    """Users active without an HR row, or active outside their employment."""
    return uncovered_users(daily_activity(src.events().where(F.col("user").isNotNull())), src.hr)


def uncovered_users(activity: DataFrame, hr: DataFrame) -> DataFrame:
    return against_lifecycle(activity, hr).groupBy("user", "reason").agg(
        F.sum("n").alias("n_events"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )


def time_warp(src: Sources) -> DataFrame:
    """App use before its session was opened; app or directory events before their request."""
    opened = (
        src.logins.where((F.col("status") == "SUCCESS") & F.col("session_id").isNotNull())
        .groupBy("user", "session_id")
        .agg(F.min("ts").alias("reference_ts"))
    )
    before_login = (
        src.app.select("user", "session_id", F.col("ts").alias("event_ts"), F.col("usage_id").alias("event_id"))
        .join(opened, ["user", "session_id"])
        .withColumn("kind", F.lit("usage_before_login"))
        .drop("session_id")
    )
    requested = (
        src.requests.where(F.col("req_id").isNotNull())
        .groupBy(F.col("req_id").alias("request_id"))
        .agg(F.min("ts").alias("reference_ts"))
    )
    linked = src.app.select(
        "request_id", "user", F.col("ts").alias("event_ts"), F.col("usage_id").alias("event_id"),
        F.lit("usage_before_request").alias("kind"),
    ).unionByName(
        src.directory.select(
            "request_id", "user", F.col("ts").alias("event_ts"), "event_id",
            F.lit("directory_before_request").alias("kind"),
        )
    )
    before_request = linked.join(requested, "request_id").drop("request_id")
    return (
        before_login.unionByName(before_request)
        .where(F.col("event_ts") < F.col("reference_ts"))
        .select(
            "user", "kind", "reference_ts", "event_ts", elapsed("reference_ts", "event_ts").alias("seconds_early"), "event_id"
        )
    )
