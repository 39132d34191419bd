"""Column layouts of the six sources."""

from pyspark.sql import types as T

_STR, _TS, _DATE = T.StringType(), T.TimestampNTZType(), T.DateType()


def _layout(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LOGINS = _layout(
    ("req_id", _STR), ("user", _STR), ("ts", _TS), ("device", _STR), ("ip", _STR),
    ("country", _STR), ("mfa", _STR), ("status", _STR), ("session_id", _STR),
)
REQUESTS = _layout(
    ("req_id", _STR), ("user", _STR), ("ts", _TS), ("app", _STR), ("role", _STR),
    ("status", _STR), ("approver", _STR), ("justification", _STR),
)
DIRECTORY = _layout(
    ("event_id", _STR), ("ts", _TS), ("user", _STR), ("group", _STR), ("action", _STR),
    ("initiator", _STR), ("ip", _STR), ("request_id", _STR),
)
APP = _layout(
    ("usage_id", _STR), ("ts", _TS), ("user", _STR), ("app", _STR), ("action", _STR),
    ("duration", T.LongType()), ("data_mb", T.DoubleType()), ("session_id", _STR),
    ("request_id", _STR),
)
HR = _layout(
    ("user", _STR), ("join_date", _DATE), ("move_date1", _DATE), ("move_date2", _DATE),
    ("termination_date", _DATE), ("department", _STR), ("job_role", _STR), ("location", _STR),
)
LABELS = _layout(("user", _STR), ("anomaly_description", _STR))

BY_SOURCE = {
    "okta": LOGINS,
    "saviynt": REQUESTS,
    "ad": DIRECTORY,
    "app_usage": APP,
    "hrlifecycle": HR,
    "anomaly_key": LABELS,
}

# Column that identifies one event of a source.
EVENT_ID = {"okta": "req_id", "saviynt": "req_id", "ad": "event_id", "app_usage": "usage_id"}

# Older names seen in files -> current name.
ALIASES = {
    "okta": {"timestamp": "ts", "login_status": "status"},
    "saviynt": {"timestamp": "ts", "group": "justification"},
    "ad": {"timestamp": "ts"},
    "app_usage": {"timestamp": "ts"},
    "hrlifecycle": {},
    "anomaly_key": {},
}

# Columns where an empty text means "no value".
BLANK_MEANS_NULL = ("session_id", "request_id")


def text_schema(source: str) -> T.StructType:
    """The layout as it travels in messages and CSV files: every field a string."""
    return T.StructType([T.StructField(f.name, _STR, True) for f in BY_SOURCE[source].fields])
