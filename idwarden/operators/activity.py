"""Detectors on the volume, spread and timing of activity."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idwarden.constants import SESSION_HOURS
from idwarden.functions import elapsed, within_rate
from idwarden.functions.checks import non_negative, one_of, positive
from idwarden.operators.temporal import asof_join
from idwarden.sources import Sources


def volume_spikes(
    src: Sources, *, entity: str = "user", min_events: int = 2, factor: float = 2.0, baseline_days: int = 7,
) -> DataFrame:
    """Days on which a user (or group) has far more directory events than on its active days before."""
    one_of("entity", entity, ("user", "group"))
    positive(min_events=min_events, factor=factor, baseline_days=baseline_days)
    daily = (
        src.directory.where(F.col("ts").isNotNull())
        .groupBy(F.col(entity).alias("entity"), F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    before = Window.partitionBy("entity").orderBy("day").rowsBetween(-baseline_days, -1)
    return (
        daily.withColumn("baseline", F.avg("n").over(before))
        .where((F.col("n") >= min_events) & (F.col("n") >= F.lit(float(factor)) * F.col("baseline")))
        .select("entity", "day", "n", F.round("baseline", 6).alias("baseline"))
    )


def excessive_data(src: Sources, *, threshold_mb: float = 1000.0, actions=None) -> DataFrame:
    """Users that move more than ``threshold_mb`` on one day."""
    non_negative(threshold_mb=threshold_mb)
    usage = src.app if actions is None else src.app.where(F.col("action").isin(*actions))
    return (
        usage.groupBy("user", F.to_date("ts").alias("day"))
        .agg(F.round(F.sum("data_mb"), 6).alias("total_mb"), F.count("*").alias("n_events"))
        .where(F.col("total_mb") > threshold_mb)
    )


def multi_app_sessions(src: Sources, *, min_apps: int = 3) -> DataFrame:
    """Sessions that touch at least ``min_apps`` different apps."""
    positive(min_apps=min_apps)
    per_app = (
        src.app.where(F.col("session_id").isNotNull())
        .groupBy("user", "session_id", "app")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )
    return (
        per_app.groupBy("user", "session_id")
        .agg(
            F.count("app").alias("n_apps"),
            F.sort_array(F.collect_list("app")).alias("apps"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
        .where(F.col("n_apps") >= min_apps)
    )


def change_counts(directory: DataFrame, *by: str) -> DataFrame:
    """Membership changes of every (group, week, user)."""
    def with_action(name):
        return F.count_if(F.col("action") == name)

    return directory.groupBy(*by, "group", F.trunc(F.to_date("ts"), "week").alias("week"), "user").agg(
        with_action("add_member").alias("adds"),
        with_action("remove_member").alias("removes"),
        with_action("privilege_escalation").alias("escalations"),
    )


def group_churn(src: Sources) -> DataFrame:
    """Membership changes per group and week, relative to the users they touch."""
    return churn_of(change_counts(src.directory))


def churn_of(per_user: DataFrame) -> DataFrame:
    return (
        per_user.groupBy("group", "week")
        .agg(*(F.sum(c).alias(c) for c in ("adds", "removes", "escalations")), F.count("user").alias("distinct_users"))
        .withColumn("churn_rate", within_rate(F.col("adds") + F.col("removes"), "distinct_users"))
    )


def _session_starts(src: Sources) -> DataFrame:
    return (
        src.logins.where(F.col("session_id").isNotNull())
        .groupBy("user", "session_id")
        .agg(F.min("ts").alias("login_ts"))
    )


def long_sessions(src: Sources, *, limit_hours: float = SESSION_HOURS) -> DataFrame:
    """App use more than ``limit_hours`` after the first login of its session."""
    positive(limit_hours=limit_hours)
    used = src.app.select("usage_id", "user", "session_id", "app", "ts")
    return (
        used.join(_session_starts(src), ["user", "session_id"])
        .withColumn("seconds_after_login", elapsed("ts", "login_ts"))
        .where(F.col("seconds_after_login") > F.lit(limit_hours * 3600))
        .select("usage_id", "user", "session_id", "app", "login_ts", "ts", "seconds_after_login")
    )


def _successful_logins(src: Sources) -> DataFrame:
    return src.logins.where(F.col("status") == "SUCCESS").select(
        "user", F.col("req_id").alias("login_id"), F.col("ts").alias("login_ts"), F.col("session_id").alias("login_session"),
    )


def late_directory_events(
    src: Sources, *, limit_hours: float = SESSION_HOURS, max_late_hours: float = 5,
) -> DataFrame:
    """Directory events whose last successful login lies between ``limit_hours`` and
    ``limit_hours + max_late_hours`` back."""
    positive(limit_hours=limit_hours, max_late_hours=max_late_hours)
    events = src.directory.select("event_id", "user", "ts", "group", "action")
    seen = asof_join(events, _successful_logins(src), ["user"], "ts", "login_ts", "login_id", match="login")
    since = elapsed("ts", F.col("login.login_ts"))
    expiry = F.lit(int(limit_hours * 3600))
    return (
        seen.withColumn("seconds_late", since - expiry)
        .where((F.col("seconds_late") > 0) & (F.col("seconds_late") <= int(max_late_hours * 3600)))
        .select(
            "event_id", "user", "ts", "group", "action", F.col("login.login_id").alias("login_id"),
            F.col("login.login_ts").alias("login_ts"), "seconds_late",
        )
    )


def session_attribution(src: Sources) -> DataFrame:
    """Every app event with the user's last successful login before it; NULLs where there is none."""
    usage = src.app.select("usage_id", "user", "ts", "app", "session_id")
    seen = asof_join(usage, _successful_logins(src), ["user"], "ts", "login_ts", "login_id", how="left", match="login")
    return seen.select("usage_id", "user", "ts", "app", "session_id", "login.*")
