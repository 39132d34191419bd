"""Values that inputs and outputs must carry exactly."""

# Source keys, in the order the job lists them.
SOURCE_KEYS = ("okta", "ad", "saviynt", "app_usage", "hrlifecycle", "anomaly_key")

# CSV file name -> source key.
CSV_SOURCES = {
    "okta_logins.csv": "okta",
    "ad_group_events.csv": "ad",
    "app_usage.csv": "app_usage",
    "saviynt_requests.csv": "saviynt",
    "hr_lifecycle.csv": "hrlifecycle",
    "anomaly_key.csv": "anomaly_key",
}

# Output table key -> default table name.
TABLES = {
    "impossible_table": "impossible_login_anomalies",
    "mfa_table": "mfa_bypass_events",
    "mfa_all_table": "mfa_bypass_events_all_apps",
    "impossible_travel_table": "impossible_travel_events",
    "privilege_escalation_table": "privilege_escalation_without_request",
    "ad_volume_spike_table": "ad_volume_spikes",
    "rejected_executed_table": "rejected_but_executed",
    "high_risk_seq_table": "high_risk_sequence",
    "excessive_data_table": "excessive_data_transferred",
    "role_drift_table": "role_drift",
    "stale_access_table": "stale_access",
    "multi_app_session_table": "multi_app_single_session",
    "mfa_drift_table": "mfa_drift",
    "suspicious_approver_table": "suspicious_approver_behavior",
    "ad_churn_table": "ad_group_churn_rate",
    "orphan_event_table": "orphan_event_detection",
    "orphan_user_table": "orphan_user_detection",
    "cleanest_users_table": "cleanest_users",
    "shadow_table": "shadow_access_events",
    "risk_table": "risk_scores",
    "timeline_table": "identity_timelines",
    "time_warp_table": "suspicious_time_warp",
}

# Groups whose membership counts as a privilege.
PRIVILEGED_GROUPS = ("Security-Admins", "DBA", "DevOps")

# Service account by directory action, then by group, then default.
ACTION_ACCOUNTS = {
    "privilege_escalation": "iam_service",
    "add_member": "svc_saviynt",
    "remove_member": "svc_saviynt",
}
GROUP_ACCOUNTS = {
    "HR": "workday_service",
    "Workday": "workday_service",
    "Finance": "finance_bot",
    "DBA": "dba_automation",
    "DevOps": "devops_automation",
}
DEFAULT_ACCOUNT = "automation_engine"
HUMAN_PREFIX = "user"

# Limits, in seconds unless named otherwise.
SHADOW_WINDOW_SEC = 86400
LOGIN_GRACE_SEC = 1800
LOGIN_BAND_SEC = 7200
MFA_WINDOW_SEC = 3600
SESSION_HOURS = 8
RISK_TOP = 100
MAX_RECORDS_PER_FILE = 20_000_000

# Weights of the risk score.
WEIGHT_FAILED_MFA = 2
WEIGHT_ESCALATION = 3
WEIGHT_UNEXPLAINED = 5
