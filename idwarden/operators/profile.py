"""Per-user results: scores, timelines, attack sequences."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idwarden.constants import RISK_TOP, WEIGHT_ESCALATION, WEIGHT_FAILED_MFA, WEIGHT_UNEXPLAINED
from idwarden.functions import first_rows, is_failure, labelled
from idwarden.functions.checks import non_negative, positive
from idwarden.operators.keyed import without_match
from idwarden.operators.temporal import asof_join, asof_scan
from idwarden.sources import Sources


def unexplained_usage(src: Sources) -> DataFrame:
    """App events that no request of the same user covers."""
    usage = src.app.select("usage_id", "user", "request_id")
    return without_match(usage, src.requests, {"user": "user", "request_id": "req_id"})


def _one(condition):
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def login_marks(logins: DataFrame, *by: str) -> DataFrame:
    """Counts that a login adds to its user's risk."""
    return logins.select(
        *by, "user", "country", _one(F.col("status") == "FAILED").alias("failed_mfa"),
        _one(F.col("status") == "SUCCESS").alias("success_mfa"), _one(F.lit(True)).alias("total_logins"),
    )


def directory_marks(directory: DataFrame, *by: str) -> DataFrame:
    return directory.select(
        *by, "user", _one(F.col("action") == "privilege_escalation").alias("privilege_escalations"), _one(F.lit(True)).alias("ad_actions"),
    )


def risk_scores(src: Sources, *, top: int | None = RISK_TOP) -> DataFrame:
    """The ``top`` users (None: all) by risk score, among users with at least one login.

    All sources meet in one aggregation by user, so each row is combined on the map side
    and only per-user totals are shuffled.
    """
    yes = _one(F.lit(True))
    return scores_of(
        login_marks(src.logins), src.requests.select("user", yes.alias("access_requests")), directory_marks(src.directory),
        unexplained_usage(src).select("user", yes.alias("unexplained_app_usage")), top=top,
    )


def scores_of(
    logins: DataFrame, requests: DataFrame, directory: DataFrame, unexplained: DataFrame, *, top: int | None = RISK_TOP,
) -> DataFrame:
    """Scores from counts by user, in any number of rows; logins by country too."""
    rows = (
        logins.unionByName(requests, allowMissingColumns=True)
        .unionByName(directory, allowMissingColumns=True)
        .unionByName(unexplained, allowMissingColumns=True)
    )
    counts = (
        "failed_mfa", "success_mfa", "total_logins", "access_requests", "privilege_escalations", "ad_actions",
        "unexplained_app_usage",
    )
    totals = (
        rows.where(F.col("user").isNotNull())
        .groupBy("user")
        .agg(F.countDistinct("country").alias("unique_countries"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
        .where(F.col("total_logins") > 0)
    )
    score = (
        WEIGHT_FAILED_MFA * F.col("failed_mfa")
        + WEIGHT_ESCALATION * F.col("privilege_escalations")
        + WEIGHT_UNEXPLAINED * F.col("unexplained_app_usage")
    )
    return first_rows(totals.withColumn("risk_score", score).orderBy(F.desc("risk_score"), "user"), top)


def timelines(src: Sources, *, ordered: bool = False) -> DataFrame:
    """All events of all users in one shape. ``ordered`` sorts by user and time."""
    def told(df, event_type, *parts):
        return df.select(
            F.col("ts").alias("event_ts"), "user", F.lit(event_type).alias("event_type"),
            F.concat_ws(" | ", *parts).alias("details"),
        )

    # Event types and the wording of the details.
    lines = (
        told(
            src.logins, "Okta Login", labelled("Status", "status"), labelled("Country", "country"), labelled("IP", "ip"),
            labelled("MFA", "mfa"),
        )
        .unionByName(told(src.requests, "SAV Request", "app", "role", "status"))
        .unionByName(told(src.directory, "AD Group Event", "group", "action", "initiator"))
        .unionByName(
            told(
                src.app, "App Usage", "app", "action",
                F.when(F.col("data_mb").isNotNull(), F.format_string("%.2f", "data_mb")),
            )
        )
    )
    return lines.orderBy("user", "event_ts") if ordered else lines


def high_risk_sequences(src: Sources, *, window_sec: int = 86400, transfers=("upload", "download")) -> DataFrame:
    """Failed login, then a privilege escalation, then a data transfer, each within the window.

    Per failed login the first such chain. Escalations with no transfer after them are
    dropped before the failed logins look for theirs, so no chain is formed only to be ranked away.
    """
    positive(window_sec=window_sec)
    failed = src.logins.where(is_failure("status")).select("req_id", "user", F.col("ts").alias("failed_ts"))
    escalations = src.directory.where(F.col("action") == "privilege_escalation").select(
        "event_id", "user", F.col("ts").alias("escalation_ts")
    )
    transfer = src.app.where(F.col("action").isin(*transfers)).select(
        "usage_id", "user", F.col("ts").alias("app_ts"), "app", "action"
    )
    steps = dict(forward=True, whole_seconds=True, within_sec=window_sec)
    # Of the escalations of one moment the one with the lowest id stands for all.
    followed = asof_scan(
        escalations, transfer, ["user"], "escalation_ts", "app_ts", "usage_id", {"transfer": F.lit(True)},
        keep={"event_id": F.col("event_id")}, **steps,
    ).where(F.col("transfer").isNotNull())
    chains = asof_join(failed, followed, ["user"], "failed_ts", "escalation_ts", "event_id", match="step", **steps)
    return chains.select(
        "user", "failed_ts", F.col("step.escalation_ts").alias("escalation_ts"),
        F.col("step.transfer.app_ts").alias("app_ts"), F.col("step.transfer.app").alias("app"),
        F.col("step.transfer.action").alias("action"), "req_id",
    )


def _spread(key: str) -> Column:
    """A key to join by in which rows without one, which match nothing, are spread over many values."""
    return F.when(F.col(key).isNull(), F.concat(F.lit("-"), F.pmod(F.xxhash64("event_id"), F.lit(1024)).cast("string"))).otherwise(_known(key))


def _known(key: str) -> Column:
    return F.concat(F.lit("+"), F.col(key))


def _links(src: Sources) -> DataFrame:
    """App and directory events of users, with the findings of each: what ``unrequested_escalations``, ``unexplained_usage`` and
    ``orphan_events`` say of it, from one look at the event and one at each kind of key."""
    no, none = F.lit(False), F.lit(None).cast("string")
    escalates = F.coalesce(F.col("action") == "privilege_escalation", no)
    events = src.app.select(
        "user", "ts", F.col("usage_id").alias("event_id"), "request_id", "session_id", F.lit(True).alias("is_use"), no.alias("escalates"),
    ).unionByName(src.directory.select(
        "user", "ts", "event_id", "request_id", none.alias("session_id"), no.alias("is_use"), escalates.alias("escalates"),
    )).where(F.col("user").isNotNull())
    named = src.requests.where(F.col("req_id").isNotNull())
    own = named.where(F.col("user").isNotNull()).groupBy(_known("req_id").alias("_own"), F.col("user").alias("_user")).agg(F.min("ts").alias("_first"))
    made = named.select(_known("req_id").alias("_made")).distinct()
    opened = src.logins.where((F.col("status") == "SUCCESS") & F.col("session_id").isNotNull()).select(_known("session_id").alias("_opened")).distinct()
    found = (
        events.withColumns({"_request": _spread("request_id"), "_session": _spread("session_id")})
        .join(own, (F.col("_request") == F.col("_own")) & (F.col("user") == F.col("_user")), "left")
        .join(made, F.col("_request") == F.col("_made"), "left")
        .join(opened, F.col("_session") == F.col("_opened"), "left")
    )
    findings = (
        F.col("escalates") & ~F.coalesce(F.col("_first") <= F.col("ts"), no),
        F.col("is_use") & F.col("_own").isNull(),
        F.col("request_id").isNotNull() & F.col("_made").isNull(),
        F.col("session_id").isNotNull() & F.col("_opened").isNull(),
    )
    return found.select("user", sum((_one(f) for f in findings[1:]), _one(findings[0])).alias("findings"))


def cleanest_users(src: Sources, *, max_findings: int | None = None, top: int | None = None) -> DataFrame:
    """The ``top`` users (None: all) with the fewest findings, the most active first among equals.

    Findings are failed logins, unrequested escalations, unexplained app usage and events of unknown requests or sessions. Each
    event is read once and carries its own findings, so what several detectors look up is looked up once.
    """
    if max_findings is not None:
        non_negative(max_findings=max_findings)
    nothing = F.lit(0).cast("bigint").alias("findings")
    rows = (
        src.logins.select("user", _one(is_failure("status")).alias("findings"))
        .unionByName(src.requests.select("user", nothing))
        .unionByName(_links(src))
    )
    totals = rows.where(F.col("user").isNotNull()).groupBy("user").agg(F.sum("findings").alias("findings"), F.count("*").alias("total_events"))
    if max_findings is not None:
        totals = totals.where(F.col("findings") <= max_findings)
    return first_rows(totals.orderBy("findings", F.desc("total_events"), "user"), top)
