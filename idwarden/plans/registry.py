"""Result tables: which detector fills them and which sources it reads."""

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idwarden.operators import access, activity, integrity, logins, profile, quality
from idwarden.sources import Sources


@dataclass(frozen=True)
class Detector:
    """day: the column by which a result row belongs to a day. near: sources of which a range of days needs only so many days
    before and after; the others are keys or histories and are read whole."""

    fn: Callable[[Sources], DataFrame]
    reads: tuple[str, ...]
    day: str | None = None
    near: dict[str, tuple[int, int]] = field(default_factory=dict)


def of_days(key: str, first_day: str | None, last_day: str | None, load: Callable[..., Sources]) -> DataFrame:
    """The rows of a table that belong to a range of days: those of the whole, cut, whichever days are read for them.

    ``load`` takes ``days``, by source. Rows without a time belong to the range without a first day, so that ranges that adjoin
    add up to the whole. A table without days is computed and returned whole.
    """
    detector = {**DETECTORS, **CHECKS}[key]
    if detector.day is None or not (first_day or last_day):
        return detector.fn(load(days=None))

    def moved(day, by):
        return None if day is None else str(date.fromisoformat(day) + timedelta(days=by))

    rows = detector.fn(load(days={s: (moved(first_day, -back), moved(last_day, ahead)) for s, (back, ahead) in detector.near.items()}))
    day = F.to_date(detector.day)
    if first_day is not None:
        rows = rows.where(day >= F.lit(first_day).cast("date"))
    if last_day is not None:
        early = day <= F.lit(last_day).cast("date")
        rows = rows.where(early if first_day is not None else early | day.isNull())
    return rows


_EVENTS = ("okta", "saviynt", "ad", "app_usage")

DETECTORS: dict[str, Detector] = {
    "impossible_table": Detector(logins.impossible_login, ("okta", "app_usage"), "time_of_app_access", {"app_usage": (0, 0)}),
    "mfa_table": Detector(logins.mfa_bypass, ("okta", "app_usage"), "mfa_failure_time", {"okta": (0, 0), "app_usage": (0, 1)}),
    "mfa_all_table": Detector(logins.mfa_bypass_all_apps, ("okta", "app_usage"), "mfa_failure_time", {"okta": (0, 0), "app_usage": (0, 1)}),
    "impossible_travel_table": Detector(logins.impossible_travel, ("okta",), "ts", {"okta": (1, 0)}),
    "privilege_escalation_table": Detector(access.unrequested_escalations, ("ad", "saviynt"), "ts", {"ad": (0, 0)}),
    "ad_volume_spike_table": Detector(activity.volume_spikes, ("ad",), "day"),
    "rejected_executed_table": Detector(access.rejected_but_executed, ("saviynt", "app_usage", "ad")),
    "high_risk_seq_table": Detector(profile.high_risk_sequences, ("okta", "ad", "app_usage"), "failed_ts", {"okta": (0, 0), "ad": (0, 1), "app_usage": (0, 2)}),
    "excessive_data_table": Detector(activity.excessive_data, ("app_usage",), "day", {"app_usage": (0, 0)}),
    "role_drift_table": Detector(access.role_history, ("saviynt",)),
    "stale_access_table": Detector(access.stale_access, _EVENTS),
    "multi_app_session_table": Detector(activity.multi_app_sessions, ("app_usage",)),
    "mfa_drift_table": Detector(logins.mfa_drift, ("okta",), "ts"),
    "suspicious_approver_table": Detector(access.approver_behaviour, ("saviynt",)),
    "ad_churn_table": Detector(activity.group_churn, ("ad",)),
    "orphan_event_table": Detector(integrity.orphan_events, _EVENTS, "ts", {"ad": (0, 0), "app_usage": (0, 0)}),
    "orphan_user_table": Detector(integrity.orphan_users, (*_EVENTS, "hrlifecycle")),
    "cleanest_users_table": Detector(profile.cleanest_users, _EVENTS),
    "shadow_table": Detector(access.shadow_access, ("ad", "saviynt", "app_usage"), "time_of_privilege_grant", {"ad": (0, 0), "app_usage": (0, 1)}),
    "risk_table": Detector(profile.risk_scores, _EVENTS),
    "timeline_table": Detector(profile.timelines, _EVENTS, "event_ts", {s: (0, 0) for s in _EVENTS}),
    "time_warp_table": Detector(integrity.time_warp, _EVENTS, "event_ts", {"ad": (0, 0), "app_usage": (0, 0)}),
}

# Data-quality checks, each a table of its own name.
CHECKS: dict[str, Detector] = {
    "quality_volumes": Detector(quality.volumes, (*_EVENTS, "hrlifecycle")),
    "quality_anomalies_per_code": Detector(quality.anomalies_per_code, ("anomaly_key",)),
    "quality_unused_approvals": Detector(quality.unused_approval_count, ("saviynt", "app_usage")),
    "quality_unknown_sessions": Detector(quality.unknown_session_count, ("okta", "app_usage")),
    "quality_directory_linkage": Detector(quality.directory_linkage, ("ad",)),
    "quality_usage_before_login": Detector(quality.usage_before_login_count, ("okta", "app_usage")),
    "quality_long_sessions": Detector(quality.long_session_count, ("okta", "app_usage")),
    "quality_lifecycle": Detector(quality.lifecycle_violations, ("okta", "ad", "app_usage", "hrlifecycle")),
    "quality_date_range": Detector(quality.date_range, _EVENTS),
    "quality_label_scores": Detector(quality.label_scores, (*_EVENTS, "anomaly_key")),
}
