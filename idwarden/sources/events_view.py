"""The identity sources as views over a general ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` has no identity fields, so each is
derived from the row itself; every row of ``events`` becomes exactly one source row.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden import schemas
from idwarden.sources.bundle import Sources

# Domains of the derived fields that rules read. The others are numbered.
COUNTRIES = ("USA", "UK", "Germany", "Japan", "Singapore", "India", "Brazil", "Australia")
METHODS = ("TOTP", "Push", "SMS", "Email")
APPS = ("Snowflake", "Databricks", "GitHub", "Jira", "Salesforce", "SAP", "Workday")
APP_ACTIONS = ("view", "modify", "upload", "download")
ROLES = ("Reader", "Editor", "Developer", "Admin")
STATUSES = ("APPROVED", "REJECTED", "PENDING")
GROUPS = ("DBA", "DevOps", "Finance", "HR", "Workday", "Contractor")
DIRECTORY_ACTIONS = ("add_member", "remove_member", "privilege_escalation")
SOURCE_OF_TYPE = {
    "signup": "okta",
    "error": "okta",
    "view": "app_usage",
    "purchase": "saviynt",
    "click": "ad",
}


def pick(values, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))


def _tagged(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def sources_from_events(events: DataFrame) -> Sources:
    e, u = F.col("event_id"), F.col("user_id")
    user = _tagged("user", u)
    session = F.concat(F.lit("s"), u.cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
    earlier_request = _tagged("r", e - 1)
    failed = F.col("event_type") == "error"

    logins = events.where(F.col("event_type").isin("signup", "error")).select(
        _tagged("l", e).alias("req_id"), user.alias("user"), "ts", _tagged("device", e % 5).alias("device"),
        F.when(e % 11 == 0, "192.168.1.5")
        .otherwise(F.concat(F.lit("10."), (e % 8).cast("string"), F.lit("."), (u % 250).cast("string"), F.lit(".1")))
        .alias("ip"),
        pick(COUNTRIES, e % 8).alias("country"), pick(METHODS, e % 4).alias("mfa"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(~failed, session).alias("session_id"),
    )
    app = events.where(F.col("event_type") == "view").select(
        _tagged("u", e).alias("usage_id"), "ts", user.alias("user"), pick(APPS, e % 7).alias("app"),
        pick(APP_ACTIONS, e % 4).alias("action"), F.floor(F.col("value") * 10).alias("duration"),
        F.col("value").alias("data_mb"), F.when(e % 5 != 0, session).alias("session_id"),
        F.when(e % 3 != 0, earlier_request).alias("request_id"),
    )
    requests = events.where(F.col("event_type") == "purchase").select(
        _tagged("r", e).alias("req_id"), user.alias("user"), "ts", pick(APPS, e % 7).alias("app"),
        pick(ROLES, e % 4).alias("role"), pick(STATUSES, e % 3).alias("status"),
        _tagged("user", (e * 7) % 20).alias("approver"), _tagged("reason", e % 3).alias("justification"),
    )
    directory = events.where(F.col("event_type") == "click").select(
        _tagged("e", e).alias("event_id"), "ts", user.alias("user"), pick(GROUPS, e % 6).alias("group"),
        pick(DIRECTORY_ACTIONS, F.floor(e / 6) % 3).alias("action"),
        F.when(e % 4 == 0, user).otherwise("svc_saviynt").alias("initiator"),
        _tagged("10.0.0.", e % 250).alias("ip"), F.when(e % 2 != 0, earlier_request).alias("request_id"),
    )
    hr = events.where(u % 10 != 7).select("user_id").distinct().select(
        user.alias("user"), F.lit("2024-01-01").cast("date").alias("join_date"),
        F.when((u % 5).isin(1, 2), F.lit("2024-01-15").cast("date")).alias("move_date1"),
        F.lit(None).cast("date").alias("move_date2"),
        F.when(u % 5 == 0, F.lit("2024-01-20").cast("date")).alias("termination_date"),
        _tagged("department", u % 6).alias("department"), _tagged("job", u % 6).alias("job_role"),
        _tagged("place", u % 5).alias("location"),
    )
    ends = events.groupBy("user_id").agg(F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    labels = ends.select(user.alias("user"), F.explode(F.array("first_id", "last_id")).alias("id")).select(
        "user", F.concat(F.lit("Q"), (F.col("id") % 6 + 1).cast("string"), F.lit(": labelled")).alias("anomaly_description")
    )
    return Sources(logins=logins, requests=requests, directory=directory, app=app, hr=hr, labels=labels)


def messages_from_events(events: DataFrame, source: str) -> DataFrame:
    """The rows of one derived source as JSON messages with attributes."""
    from idwarden.sources.normalise import to_messages

    columns = schemas.BY_SOURCE[source].fieldNames()
    return to_messages(sources_from_events(events).get(source).select(*columns), source)
