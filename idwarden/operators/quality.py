"""Data-quality checks and scoring against labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idwarden.constants import SESSION_HOURS
from idwarden.functions import within_rate
from idwarden.functions.checks import positive
from idwarden.operators.access import unrequested_escalations, unused_approvals
from idwarden.operators.activity import late_directory_events, long_sessions
from idwarden.operators.integrity import against_lifecycle, daily_activity
from idwarden.operators.keyed import without_match
from idwarden.operators.logins import impossible_travel, shared_address_countries
from idwarden.operators.temporal import count_pairs_before
from idwarden.sources import Sources


def volumes(src: Sources) -> DataFrame:
    """Rows per source, and the distinct users seen in logins."""
    def counted(df, name):
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("metric"), "n")

    users = src.logins.agg(F.countDistinct("user").alias("n")).select(F.lit("unique_users").alias("metric"), "n")
    return (
        counted(src.logins, "logins")
        .unionByName(counted(src.requests, "requests"))
        .unionByName(counted(src.directory, "directory"))
        .unionByName(counted(src.app, "app"))
        .unionByName(counted(src.hr, "hr"))
        .unionByName(users)
    )


def _code():
    return F.split_part("anomaly_description", F.lit(":"), F.lit(1))


def anomalies_per_code(src: Sources) -> DataFrame:
    """Labels per code, the text before the first colon."""
    return src.labels.groupBy(_code().alias("code")).agg(
        F.count("*").alias("n"), F.countDistinct("user").alias("users")
    )


def unused_approval_count(src: Sources) -> DataFrame:
    approved = src.requests.where((F.col("status") == "APPROVED") & F.col("req_id").isNotNull()).select("req_id").distinct()
    return without_match(approved, src.app, {"req_id": "request_id"}).agg(F.count("*").alias("n"))


def unknown_session_count(src: Sources) -> DataFrame:
    """Distinct sessions in app use that no successful login opened."""
    used = src.app.where(F.col("session_id").isNotNull()).select("session_id").distinct()
    opened = src.logins.where(F.col("status") == "SUCCESS")
    return without_match(used, opened, {"session_id": "session_id"}).agg(F.count("*").alias("n"))


def directory_linkage(src: Sources) -> DataFrame:
    """Directory events that name a request, out of all."""
    return src.directory.agg(F.count("request_id").alias("linked"), F.count("*").alias("total")).withColumn(
        "rate", within_rate("linked", "total")
    )


def usage_before_login_count(src: Sources) -> DataFrame:
    """Pairs of app use and login of one session where the use comes first."""
    return count_pairs_before(src.logins, src.app, ["session_id"], F.col("ts"), F.col("ts"))


def long_session_count(src: Sources, *, limit_hours: int = SESSION_HOURS) -> DataFrame:
    """Pairs of app use and login of one session more than ``limit_hours`` apart."""
    positive(limit_hours=limit_hours)
    expiry = F.col("ts") + F.make_dt_interval(hours=F.lit(limit_hours))
    return count_pairs_before(src.app, src.logins, ["session_id"], F.col("ts"), expiry)


def lifecycle_violations(src: Sources) -> DataFrame:
    """Events before joining or after termination per source; users without an HR row are skipped."""
    events = src.events().where((F.col("source") != "request") & F.col("user").isNotNull())
    activity = daily_activity(events, "source")
    late = against_lifecycle(activity, src.hr).where(F.col("reason") == "outside_lifecycle")
    # Totals and violations meet in one sum, so a source without violations is reported as zero.
    counts = activity.select("source", F.col("n").alias("events"), F.lit(0).cast("bigint").alias("violations")).unionByName(
        late.select("source", F.lit(0).cast("bigint").alias("events"), F.col("n").alias("violations"))
    )
    return counts.groupBy("source").agg(F.sum("events").alias("events"), F.sum("violations").alias("violations"))


def date_range(src: Sources) -> DataFrame:
    return src.events().agg(F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))


def flagged_users(src: Sources) -> DataFrame:
    """Distinct (user, code) found by the detectors that have a label code."""
    found = {
        "Q1": impossible_travel(src),
        "Q2": unused_approvals(src),
        "Q3": unrequested_escalations(src).where("self_initiated"),
        "Q4": shared_address_countries(src),
        "Q5": long_sessions(src),
        "Q6": late_directory_events(src),
    }
    rows = None
    for code, df in found.items():
        part = df.select("user", F.lit(code).alias("code"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.where(F.col("user").isNotNull()).distinct()


def label_scores(src: Sources) -> DataFrame:
    """Per code: users labelled, users flagged, both, precision and recall."""
    labelled = src.labels.where(F.col("user").isNotNull()).select("user", _code().alias("code"))
    marks = labelled.select("user", "code", F.lit(1).alias("is_label"), F.lit(0).alias("is_flag")).unionByName(
        flagged_users(src).select("user", "code", F.lit(0).alias("is_label"), F.lit(1).alias("is_flag"))
    )
    per_user = marks.groupBy("user", "code").agg(F.max("is_label").alias("is_label"), F.max("is_flag").alias("is_flag"))
    return (
        per_user.groupBy("code")
        .agg(
            F.sum("is_label").alias("labelled"),
            F.sum("is_flag").alias("flagged"),
            F.sum(F.col("is_label") * F.col("is_flag")).alias("true_positives"),
        )
        .withColumn("precision", within_rate("true_positives", "flagged"))
        .withColumn("recall", within_rate("true_positives", "labelled"))
    )
