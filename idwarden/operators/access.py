"""Detectors on requests, approvals and privileges."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idwarden.constants import PRIVILEGED_GROUPS, SHADOW_WINDOW_SEC
from idwarden.functions import elapsed, seconds, within_rate
from idwarden.functions.checks import non_negative, positive, rate
from idwarden.operators.keyed import without_match
from idwarden.operators.temporal import band_join
from idwarden.sources import Sources


def shadow_access(
    src: Sources, *, privileged_groups=PRIVILEGED_GROUPS, window_sec: int = SHADOW_WINDOW_SEC, actions=None,
) -> DataFrame:
    """Privileged group events without a known request, followed by app use within the window.

    Any directory action counts unless ``actions`` narrows them.
    """
    positive(window_sec=window_sec)
    events = src.directory.where(F.col("group").isin(*privileged_groups))
    if actions is not None:
        events = events.where(F.col("action").isin(*actions))
    grants = without_match(events, src.requests, {"request_id": "req_id"}).select(
        "user",
        F.col("group").alias("privileged_group_gained"),
        F.col("ts").alias("time_of_privilege_grant"),
        F.col("initiator").alias("granted_by"),
    )
    usage = src.app.select("user", F.col("app").alias("app_accessed"), F.col("ts").alias("time_of_app_access"))
    return band_join(
        grants, usage, ["user"], "time_of_privilege_grant", "time_of_app_access", 0, window_sec
    ).select(
        "user", "privileged_group_gained", "app_accessed", "time_of_privilege_grant", "time_of_app_access", "granted_by"
    )


def unrequested_escalations(src: Sources) -> DataFrame:
    """Privilege escalations without an earlier request of the same id by the same user."""
    first_request = (
        src.requests.groupBy(F.col("req_id").alias("_req"), F.col("user").alias("_requester"))
        .agg(F.min("ts").alias("_requested"))
    )
    escalations = src.directory.where(F.col("action") == "privilege_escalation")
    keyed = escalations.where(F.col("request_id").isNotNull()).join(
        first_request,
        (F.col("request_id") == F.col("_req")) & (F.col("user") == F.col("_requester")) & (F.col("_requested") <= F.col("ts")),
        "left_anti",
    )
    return keyed.unionByName(escalations.where(F.col("request_id").isNull())).select(
        "event_id", "user", "ts", "group", "initiator", "request_id",
        (F.col("initiator").eqNullSafe(F.col("user"))).alias("self_initiated"),
    )


def rejected_but_executed(src: Sources) -> DataFrame:
    """Rejected requests whose id still shows up on an app or directory event."""
    rejected = src.requests.where(F.col("status") == "REJECTED").select(
        "req_id", F.col("user").alias("requester"), "status", F.col("ts").alias("request_ts")
    )
    executed = src.app.select(
        F.col("request_id").alias("req_id"), F.col("user").alias("executor"), F.lit("app").alias("executed_in"),
        F.col("ts").alias("executed_ts"),
    ).unionByName(
        src.directory.select(
            F.col("request_id").alias("req_id"), F.col("user").alias("executor"), F.lit("directory").alias("executed_in"),
            F.col("ts").alias("executed_ts"),
        )
    )
    return rejected.join(executed, "req_id").select(
        "req_id", "requester", "executor", "status", "request_ts", "executed_in", "executed_ts"
    )


def role_counts(requests: DataFrame, *by: str) -> DataFrame:
    """First and last request and number of requests of every (user, role)."""
    return requests.groupBy(*by, "user", "role").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n")
    )


def role_history(src: Sources) -> DataFrame:
    """First and last request of every (user, role), with the user's role drift."""
    return roles_of(role_counts(src.requests))


def roles_of(per_role: DataFrame) -> DataFrame:
    # One row per role is left of each user's requests, so this window stays small.
    of_user = Window.partitionBy("user")
    n_roles = F.count("role").over(of_user)
    return per_role.select(
        "user", "role", "first_seen", "last_seen", "n",
        n_roles.alias("n_roles"),
        F.min(F.struct("first_seen", "role")).over(of_user)["role"].alias("first_role"),
        F.max(F.struct("last_seen", "role")).over(of_user)["role"].alias("last_role"),
        (n_roles > 1).alias("drift"),
    )


def last_grants(requests: DataFrame, *by: str) -> DataFrame:
    """Latest approved request of every (user, app)."""
    return requests.where(F.col("status") == "APPROVED").groupBy(*by, "user", "app").agg(F.max("ts").alias("granted_ts"))


def last_uses(app: DataFrame, *by: str) -> DataFrame:
    """Latest use of every (user, app)."""
    return app.groupBy(*by, "user", "app").agg(F.max("ts").alias("last_used"))


def stale_access(src: Sources, *, stale_days: int = 30, as_of=None) -> DataFrame:
    """Approved (user, app) pairs not used within ``stale_days`` before ``as_of``.

    ``as_of`` is a timestamp or its text; by default the latest event of the four sources.
    """
    if as_of is None:
        now = src.events().agg(F.max("ts").alias("as_of")).scalar()
    else:
        now = F.lit(as_of).cast("timestamp_ntz")
    return idle_grants(last_grants(src.requests), last_uses(src.app), now, stale_days=stale_days)


def idle_grants(granted: DataFrame, used: DataFrame, now, *, stale_days: int = 30) -> DataFrame:
    """Grants not used within ``stale_days`` before ``now``."""
    non_negative(stale_days=stale_days)
    idle_sec = seconds(now) - seconds(F.coalesce("last_used", "granted_ts"))
    return (
        granted.join(used, ["user", "app"], "left")
        .where(F.col("last_used").isNull() | (seconds("last_used") < seconds(now) - F.lit(stale_days * 86400)))
        .select(
            "user", "app", "granted_ts", "last_used",
            F.floor(idle_sec / F.lit(86400)).alias("days_idle"),
            F.col("last_used").isNull().alias("never_used"),
        )
    )


def decision_counts(requests: DataFrame, *by: str) -> DataFrame:
    """Decisions and approvals of every (approver, user)."""
    return (
        requests.where(F.col("approver").isNotNull() & F.col("status").isin("APPROVED", "REJECTED"))
        .groupBy(*by, "approver", "user")
        .agg(F.count("*").alias("decisions"), F.count_if(F.col("status") == "APPROVED").alias("approvals"))
    )


def approver_behaviour(src: Sources, *, min_decisions: int = 5, approval_rate: float = 0.9) -> DataFrame:
    """Decisions per approver; flagged on any self-approval or on approving nearly everything."""
    return approvers_of(decision_counts(src.requests), min_decisions=min_decisions, approval_rate=approval_rate)


def approvers_of(per_user: DataFrame, *, min_decisions: int = 5, approval_rate: float = 0.9) -> DataFrame:
    positive(min_decisions=min_decisions)
    rate(approval_rate=approval_rate)
    per_approver = (
        per_user.groupBy("approver")
        .agg(
            F.sum("decisions").alias("decisions"),
            F.sum("approvals").alias("approvals"),
            F.sum(F.when(F.col("user") == F.col("approver"), F.col("approvals")).otherwise(F.lit(0))).alias("self_approvals"),
            F.count("user").alias("requesters"),
        )
        .withColumn("approval_rate", within_rate("approvals", "decisions"))
    )
    often = (F.col("decisions") >= min_decisions) & (F.col("approval_rate") >= approval_rate)
    return per_approver.select(
        "approver", "decisions", "approvals", "approval_rate", "self_approvals", "requesters",
        ((F.col("self_approvals") > 0) | often).alias("suspicious"),
    )


def unused_approvals(src: Sources) -> DataFrame:
    """Approved requests whose id is on no app event."""
    approved = src.requests.where((F.col("status") == "APPROVED") & F.col("req_id").isNotNull())
    return without_match(approved, src.app, {"req_id": "request_id"}).select("req_id", "user", "ts", "app", "role")
