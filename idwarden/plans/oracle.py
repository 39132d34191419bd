"""Plain SQL for every registered query, to be run by another engine on the same tables.

The SQL is written from the rules, by direct joins and windows, and shares nothing with the
DataFrame code but the derived source views.
"""

from idwarden.sources import events_view as ev


def _pick(values, n):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][CAST({n} AS INT) + 1]"


def _sec(ts):
    return f"CAST(FLOOR(EPOCH({ts})) AS BIGINT)"


def _gap(later, earlier):
    return f"({_sec(later)} - {_sec(earlier)})"


_VIEWS = f"""
logins AS (
  SELECT 'l' || event_id AS req_id, 'user' || user_id AS "user", ts, 'device' || (event_id % 5) AS device,
    CASE WHEN event_id % 11 = 0 THEN '192.168.1.5'
         ELSE '10.' || (event_id % 8) || '.' || (user_id % 250) || '.1' END AS ip,
    {_pick(ev.COUNTRIES, "event_id % 8")} AS country, {_pick(ev.METHODS, "event_id % 4")} AS mfa,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN event_type = 'error' THEN NULL ELSE 's' || user_id || '-' || strftime(ts, '%Y%m%d') END AS session_id
  FROM events WHERE event_type IN ('signup', 'error')),
app AS (
  SELECT 'u' || event_id AS usage_id, ts, 'user' || user_id AS "user", {_pick(ev.APPS, "event_id % 7")} AS app,
    {_pick(ev.APP_ACTIONS, "event_id % 4")} AS action, CAST(FLOOR(value * 10) AS BIGINT) AS duration, value AS data_mb,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE 's' || user_id || '-' || strftime(ts, '%Y%m%d') END AS session_id,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'r' || (event_id - 1) END AS request_id
  FROM events WHERE event_type = 'view'),
requests AS (
  SELECT 'r' || event_id AS req_id, 'user' || user_id AS "user", ts, {_pick(ev.APPS, "event_id % 7")} AS app,
    {_pick(ev.ROLES, "event_id % 4")} AS role, {_pick(ev.STATUSES, "event_id % 3")} AS status,
    'user' || ((event_id * 7) % 20) AS approver, 'reason' || (event_id % 3) AS justification
  FROM events WHERE event_type = 'purchase'),
directory AS (
  SELECT 'e' || event_id AS event_id, ts, 'user' || user_id AS "user", {_pick(ev.GROUPS, "event_id % 6")} AS "group",
    {_pick(ev.DIRECTORY_ACTIONS, "(event_id // 6) % 3")} AS action,
    CASE WHEN event_id % 4 = 0 THEN 'user' || user_id ELSE 'svc_saviynt' END AS initiator,
    '10.0.0.' || (event_id % 250) AS ip,
    CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'r' || (event_id - 1) END AS request_id
  FROM events WHERE event_type = 'click'),
hr AS (
  SELECT DISTINCT 'user' || user_id AS "user", DATE '2024-01-01' AS join_date,
    CASE WHEN user_id % 5 = 0 THEN DATE '2024-01-20' END AS termination_date
  FROM events WHERE user_id % 10 <> 7),
label_rows AS (
  SELECT "user", 'Q' || (id % 6 + 1) || ': labelled' AS anomaly_description FROM (
    SELECT 'user' || user_id AS "user", min(event_id) AS id FROM events GROUP BY user_id
    UNION ALL SELECT 'user' || user_id, max(event_id) FROM events GROUP BY user_id)),
all_events AS (
  SELECT 'login' AS source, req_id AS event_id, "user", ts FROM logins
  UNION ALL SELECT 'request', req_id, "user", ts FROM requests
  UNION ALL SELECT 'directory', event_id, "user", ts FROM directory
  UNION ALL SELECT 'app', usage_id, "user", ts FROM app)
"""

_ORPHANS = """
orphans AS (
  SELECT 'app' AS source, usage_id AS event_id, "user", ts, 'request' AS missing_kind, request_id AS missing_key
  FROM app WHERE request_id IS NOT NULL AND request_id NOT IN (SELECT req_id FROM requests)
  UNION ALL
  SELECT 'directory', event_id, "user", ts, 'request', request_id
  FROM directory WHERE request_id IS NOT NULL AND request_id NOT IN (SELECT req_id FROM requests)
  UNION ALL
  SELECT 'app', usage_id, "user", ts, 'session', session_id
  FROM app WHERE session_id IS NOT NULL
    AND session_id NOT IN (SELECT session_id FROM logins WHERE status = 'SUCCESS' AND session_id IS NOT NULL))
"""

_ESCALATIONS = """
escalations AS (
  SELECT event_id, "user", ts, "group", initiator, request_id, initiator = "user" AS self_initiated
  FROM directory d WHERE action = 'privilege_escalation' AND NOT EXISTS (
    SELECT 1 FROM requests r WHERE r.req_id = d.request_id AND r."user" = d."user" AND r.ts <= d.ts))
"""

_UNEXPLAINED = """
unexplained AS (
  SELECT * FROM app a WHERE NOT EXISTS (
    SELECT 1 FROM requests r WHERE r."user" = a."user" AND r.req_id = a.request_id))
"""

_TRAVEL = f"""
travel AS (
  SELECT "user", prev_country, country, prev_ts, ts, gap_sec, prev_ip, ip FROM (
    SELECT *, {_gap("ts", "prev_ts")} AS gap_sec FROM (
      SELECT "user", country, ts, ip, lag(country) OVER w AS prev_country, lag(ts) OVER w AS prev_ts, lag(ip) OVER w AS prev_ip
      FROM logins WHERE status = 'SUCCESS' WINDOW w AS (PARTITION BY "user" ORDER BY ts, req_id)))
  WHERE prev_country <> country AND prev_ip <> ip AND gap_sec <= 3600)
"""

_UNUSED = """
unused AS (
  SELECT req_id, "user", ts, app, role FROM requests r WHERE status = 'APPROVED'
    AND NOT EXISTS (SELECT 1 FROM app a WHERE a.request_id = r.req_id))
"""

_SHARED = """
shared AS (
  SELECT "user", ip, string_agg(DISTINCT country, ',' ORDER BY country) AS countries, count(*) AS n
  FROM logins GROUP BY "user", ip HAVING count(DISTINCT country) > 1)
"""

_LONG = f"""
long_use AS (
  SELECT usage_id, a."user", a.session_id, app, login_ts, ts, {_gap("ts", "login_ts")} AS seconds_after_login
  FROM app a JOIN (
    SELECT "user", session_id, min(ts) AS login_ts FROM logins WHERE session_id IS NOT NULL GROUP BY ALL) l
  ON a."user" = l."user" AND a.session_id = l.session_id
  WHERE {_gap("ts", "login_ts")} > 28800)
"""

_LATE = f"""
late AS (
  SELECT *, {_gap("ts", "login_ts")} - 28800 AS seconds_late FROM (
    SELECT d.event_id, d."user", d.ts, d."group", d.action, l.req_id AS login_id, l.ts AS login_ts
    FROM directory d JOIN logins l ON l."user" = d."user" AND l.status = 'SUCCESS' AND l.ts <= d.ts
    QUALIFY row_number() OVER (PARTITION BY d.event_id ORDER BY l.ts DESC, l.req_id DESC) = 1)
  WHERE {_gap("ts", "login_ts")} > 28800 AND {_gap("ts", "login_ts")} <= 46800)
"""

_IMPOSSIBLE = {
    "a": f"""
  SELECT o."user", o.session_id, a.app AS app_accessed, o.ts AS time_of_login, a.ts AS time_of_app_access,
    {_gap("a.ts", "o.ts")} AS time_diff_sec, a.duration AS app_usage_duration_sec
  FROM logins o JOIN app a ON o.session_id = a.session_id AND o."user" = a."user"
  WHERE {_gap("a.ts", "o.ts")} < 0 OR {_gap("a.ts", "o.ts")} > 1800""",
    "b": f"""
  SELECT a."user", a.session_id, a.app AS app_accessed, o.ts AS time_of_login, a.ts AS time_of_app_access,
    {_gap("a.ts", "o.ts")} AS time_diff_sec, a.duration AS app_usage_duration_sec
  FROM logins o JOIN app a ON o."user" = a."user" AND abs({_gap("a.ts", "o.ts")}) <= 7200
  WHERE a.session_id IS NULL AND ({_gap("a.ts", "o.ts")} < 0 OR {_gap("a.ts", "o.ts")} > 1800)""",
    "c": f"""
  SELECT a."user", a.session_id, a.app AS app_accessed, CAST(NULL AS TIMESTAMP) AS time_of_login,
    a.ts AS time_of_app_access, CAST(NULL AS BIGINT) AS time_diff_sec, a.duration AS app_usage_duration_sec
  FROM app a WHERE a.session_id IS NULL AND NOT EXISTS (
    SELECT 1 FROM logins o WHERE o."user" = a."user" AND abs({_gap("a.ts", "o.ts")}) <= 7200)""",
}

_SOON = f'f."user" = a."user" AND {_gap("a.ts", "f.ts")} > 0 AND {_gap("a.ts", "f.ts")} <= 3600'


def _bypass(where, only_first, session="CAST(NULL AS VARCHAR)"):
    first = 'QUALIFY row_number() OVER (PARTITION BY f."user", f.ts ORDER BY a.ts, a.usage_id, f.req_id) = 1'
    return f"""
  SELECT f."user", f.ts AS mfa_failure_time, f.status AS failure_reason, a.app AS app_accessed, a.ts AS app_access_time,
    {_gap("a.ts", "f.ts")} AS seconds_after_failure, {session} AS app_session_id, a.duration AS app_usage_duration_sec
  FROM logins f JOIN app a ON {_SOON}
  WHERE f.status LIKE '%FAIL%' AND {where} {first if only_first else ""}"""


_SPIKES = """
  SELECT entity, strftime(day, '%Y-%m-%d') AS day, n, round(baseline, 6) AS baseline FROM (
    SELECT *, avg(n) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline
    FROM (SELECT {entity} AS entity, CAST(ts AS DATE) AS day, count(*) AS n FROM directory GROUP BY ALL))
  WHERE n >= 2 AND n >= {factor} * baseline"""

_REWRITTEN = """
rewritten AS (
  SELECT event_id, ts, "user", "group", action,
    CASE WHEN initiator NOT LIKE 'user%' THEN initiator
         WHEN action = 'privilege_escalation' THEN 'iam_service'
         WHEN action IN ('add_member', 'remove_member') THEN 'svc_saviynt'
         WHEN "group" IN ('HR', 'Workday') THEN 'workday_service'
         WHEN "group" = 'Finance' THEN 'finance_bot'
         WHEN "group" = 'DBA' THEN 'dba_automation'
         WHEN "group" = 'DevOps' THEN 'devops_automation'
         ELSE 'automation_engine' END AS initiator,
    ip, request_id
  FROM directory)
"""

_TOP_INITIATORS = """
  SELECT initiator, count(*) AS n, initiator LIKE 'user%' AS is_human FROM {table}
  GROUP BY initiator ORDER BY n DESC, initiator LIMIT 10"""

_OUTSIDE = "(e.ts < h.join_date OR e.ts > h.termination_date)"


def _sql(body, *views):
    return "WITH " + ",".join([_VIEWS, *views]) + body


ORACLE: dict[str, str] = {
    "d01_shadow_access": _sql(f"""
  SELECT d."user", d."group" AS privileged_group_gained, a.app AS app_accessed, d.ts AS time_of_privilege_grant,
    a.ts AS time_of_app_access, d.initiator AS granted_by
  FROM directory d JOIN app a ON a."user" = d."user" AND {_gap("a.ts", "d.ts")} BETWEEN 0 AND 86400
  WHERE d."group" IN ('Security-Admins', 'DBA', 'DevOps')
    AND NOT EXISTS (SELECT 1 FROM requests r WHERE r.req_id = d.request_id)"""),
    "d02_impossible_login": _sql(" UNION ALL ".join(_IMPOSSIBLE.values())),
    "d02a_session_gaps": _sql(_IMPOSSIBLE["a"]),
    "d02b_sessionless_gaps": _sql(_IMPOSSIBLE["b"]),
    "d02c_no_login": _sql(_IMPOSSIBLE["c"]),
    "d03_mfa_bypass": _sql(" UNION ALL ".join([
        _bypass("f.session_id = a.session_id", False, "a.session_id"),
        f"SELECT * FROM ({_bypass('f.session_id IS NULL', True)})",
        f"SELECT * FROM ({_bypass('a.session_id IS NULL', True)})",
    ])),
    "d04_risk_scores": _sql("""
  SELECT *, 2 * failed_mfa + 3 * privilege_escalations + 5 * unexplained_app_usage AS risk_score FROM (
    SELECT l."user", unique_countries, failed_mfa, success_mfa, total_logins,
      coalesce(access_requests, 0) AS access_requests, coalesce(privilege_escalations, 0) AS privilege_escalations,
      coalesce(ad_actions, 0) AS ad_actions, coalesce(unexplained_app_usage, 0) AS unexplained_app_usage
    FROM (SELECT "user", count(DISTINCT country) AS unique_countries, count(*) FILTER (status = 'FAILED') AS failed_mfa,
            count(*) FILTER (status = 'SUCCESS') AS success_mfa, count(*) AS total_logins FROM logins GROUP BY "user") l
    LEFT JOIN (SELECT "user", count(*) AS access_requests FROM requests GROUP BY "user") r ON r."user" = l."user"
    LEFT JOIN (SELECT "user", count(*) FILTER (action = 'privilege_escalation') AS privilege_escalations,
            count(*) AS ad_actions FROM directory GROUP BY "user") d ON d."user" = l."user"
    LEFT JOIN (SELECT "user", count(*) AS unexplained_app_usage FROM unexplained GROUP BY "user") u ON u."user" = l."user")
  ORDER BY risk_score DESC, "user" LIMIT 100""", _UNEXPLAINED),
    "d05_timelines": _sql("""
  SELECT ts AS event_ts, "user", 'Okta Login' AS event_type,
    'Status: ' || status || ' | Country: ' || country || ' | IP: ' || ip || ' | MFA: ' || mfa AS details FROM logins
  UNION ALL SELECT ts, "user", 'SAV Request', app || ' | ' || role || ' | ' || status FROM requests
  UNION ALL SELECT ts, "user", 'AD Group Event', "group" || ' | ' || action || ' | ' || initiator FROM directory
  UNION ALL SELECT ts, "user", 'App Usage', app || ' | ' || action || ' | ' || printf('%.2f', data_mb) FROM app"""),
    "d06_mfa_bypass_all_apps": _sql(_bypass("TRUE", False, "a.session_id")),
    "d07_impossible_travel": _sql("SELECT * FROM travel", _TRAVEL),
    "d08_unrequested_escalation": _sql("SELECT * FROM escalations", _ESCALATIONS),
    "d09_volume_spikes": _sql(_SPIKES.format(entity='"user"', factor="2.0")),
    "d09_volume_spikes_by_group": _sql(_SPIKES.format(entity='"group"', factor="1.5")),
    "d10_rejected_but_executed": _sql("""
  SELECT r.req_id, r."user" AS requester, x."user" AS executor, r.status, r.ts AS request_ts, x.executed_in,
    x.ts AS executed_ts
  FROM requests r JOIN (
    SELECT request_id, "user", ts, 'app' AS executed_in FROM app
    UNION ALL SELECT request_id, "user", ts, 'directory' FROM directory) x ON x.request_id = r.req_id
  WHERE r.status = 'REJECTED'"""),
    "d11_high_risk_sequence": _sql(f"""
  SELECT f."user", f.ts AS failed_ts, d.ts AS escalation_ts, a.ts AS app_ts, a.app, a.action, f.req_id
  FROM logins f
  JOIN directory d ON d."user" = f."user" AND d.action = 'privilege_escalation' AND {_gap("d.ts", "f.ts")} BETWEEN 0 AND 86400
  JOIN app a ON a."user" = d."user" AND a.action IN ('upload', 'download') AND {_gap("a.ts", "d.ts")} BETWEEN 0 AND 86400
  WHERE f.status LIKE '%FAIL%'
  QUALIFY row_number() OVER (PARTITION BY f.req_id ORDER BY d.ts, d.event_id, a.ts, a.usage_id) = 1"""),
    "d12_excessive_data": _sql("""
  SELECT "user", strftime(ts, '%Y-%m-%d') AS day, round(sum(data_mb), 6) AS total_mb, count(*) AS n_events
  FROM app GROUP BY ALL HAVING round(sum(data_mb), 6) > 100"""),
    "d13_role_drift": _sql("""
  SELECT p.*, n_roles, first_role, last_role, n_roles > 1 AS drift
  FROM (SELECT "user", role, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM requests GROUP BY "user", role) p
  JOIN (SELECT "user", count(DISTINCT role) AS n_roles FROM requests GROUP BY "user") u ON u."user" = p."user"
  JOIN (SELECT "user", role AS first_role FROM requests QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY ts, role) = 1) f
    ON f."user" = p."user"
  JOIN (SELECT "user", role AS last_role FROM requests
        QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY ts DESC, role DESC) = 1) z ON z."user" = p."user\""""),
    "d14_stale_access": _sql(f"""
  SELECT g."user", g.app, granted_ts, last_used, {_gap("as_of", "coalesce(last_used, granted_ts)")} // 86400 AS days_idle,
    last_used IS NULL AS never_used
  FROM (SELECT "user", app, max(ts) AS granted_ts FROM requests WHERE status = 'APPROVED' GROUP BY "user", app) g
  LEFT JOIN (SELECT "user", app, max(ts) AS last_used FROM app GROUP BY "user", app) u ON u."user" = g."user" AND u.app = g.app,
  (SELECT max(ts) AS as_of FROM all_events)
  WHERE last_used IS NULL OR {_sec("last_used")} < {_sec("as_of")} - 14 * 86400"""),
    "d15_multi_app_session": _sql("""
  SELECT "user", session_id, count(DISTINCT app) AS n_apps, string_agg(DISTINCT app, ',' ORDER BY app) AS apps,
    min(ts) AS first_ts, max(ts) AS last_ts
  FROM app WHERE session_id IS NOT NULL GROUP BY "user", session_id HAVING count(DISTINCT app) >= 2"""),
    "d16_mfa_drift": _sql("""
  SELECT "user", ts, prev_mfa, mfa, n_methods FROM (
    SELECT "user", ts, mfa, lag(mfa) OVER (PARTITION BY "user" ORDER BY ts, req_id) AS prev_mfa,
      count(DISTINCT mfa) OVER (PARTITION BY "user" ORDER BY ts, req_id ROWS UNBOUNDED PRECEDING) AS n_methods
    FROM logins)
  WHERE prev_mfa <> mfa"""),
    "d17_approver_behaviour": _sql("""
  SELECT *, self_approvals > 0 OR (decisions >= 5 AND approval_rate >= 0.9) AS suspicious FROM (
    SELECT approver, count(*) AS decisions, count(*) FILTER (status = 'APPROVED') AS approvals,
      round(count(*) FILTER (status = 'APPROVED') / count(*), 6) AS approval_rate,
      count(*) FILTER (status = 'APPROVED' AND "user" = approver) AS self_approvals, count(DISTINCT "user") AS requesters
    FROM requests WHERE status <> 'PENDING' GROUP BY approver)"""),
    "d18_group_churn": _sql("""
  SELECT *, round((adds + removes) / distinct_users, 6) AS churn_rate FROM (
    SELECT "group", strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(*) FILTER (action = 'add_member') AS adds,
      count(*) FILTER (action = 'remove_member') AS removes, count(*) FILTER (action = 'privilege_escalation') AS escalations,
      count(DISTINCT "user") AS distinct_users
    FROM directory GROUP BY ALL)"""),
    "d19_orphan_events": _sql("SELECT * FROM orphans", _ORPHANS),
    "d20_orphan_users": _sql(f"""
  SELECT "user", 'unknown' AS reason, count(*) AS n_events, min(ts) AS first_ts, max(ts) AS last_ts
  FROM all_events WHERE "user" NOT IN (SELECT "user" FROM hr) GROUP BY "user"
  UNION ALL
  SELECT e."user", 'outside_lifecycle', count(*), min(e.ts), max(e.ts)
  FROM all_events e JOIN hr h ON h."user" = e."user" WHERE {_OUTSIDE} GROUP BY e."user\""""),
    "d21_cleanest_users": _sql("""
  SELECT u."user", coalesce(f.n, 0) AS findings, u.n AS total_events
  FROM (SELECT "user", count(*) AS n FROM all_events GROUP BY "user") u
  LEFT JOIN (SELECT "user", count(*) AS n FROM (
    SELECT "user" FROM logins WHERE status LIKE '%FAIL%' UNION ALL SELECT "user" FROM escalations
    UNION ALL SELECT "user" FROM unexplained UNION ALL SELECT "user" FROM orphans) GROUP BY "user") f ON f."user" = u."user"
  ORDER BY findings, total_events DESC, u."user" """, _ESCALATIONS, _UNEXPLAINED, _ORPHANS),
    "d21_cleanest_users_top100": _sql("""
  SELECT u."user", coalesce(f.n, 0) AS findings, u.n AS total_events
  FROM (SELECT "user", count(*) AS n FROM all_events GROUP BY "user") u
  LEFT JOIN (SELECT "user", count(*) AS n FROM (
    SELECT "user" FROM logins WHERE status LIKE '%FAIL%' UNION ALL SELECT "user" FROM escalations
    UNION ALL SELECT "user" FROM unexplained UNION ALL SELECT "user" FROM orphans) GROUP BY "user") f ON f."user" = u."user"
  ORDER BY findings, total_events DESC, u."user" LIMIT 100""", _ESCALATIONS, _UNEXPLAINED, _ORPHANS),
    "d22_time_warp": _sql(f"""
  SELECT *, {_gap("reference_ts", "event_ts")} AS seconds_early FROM (
    SELECT a."user", 'usage_before_login' AS kind, l.ts AS reference_ts, a.ts AS event_ts, usage_id AS event_id
    FROM app a JOIN (SELECT "user", session_id, min(ts) AS ts FROM logins WHERE status = 'SUCCESS' GROUP BY ALL) l
      ON l."user" = a."user" AND l.session_id = a.session_id
    UNION ALL
    SELECT a."user", 'usage_before_request', r.ts, a.ts, usage_id FROM app a JOIN requests r ON r.req_id = a.request_id
    UNION ALL
    SELECT d."user", 'directory_before_request', r.ts, d.ts, event_id FROM directory d JOIN requests r ON r.req_id = d.request_id)
  WHERE event_ts < reference_ts"""),
    "q2_unused_approvals": _sql("SELECT * FROM unused", _UNUSED),
    "q3_self_escalation": _sql("SELECT * FROM escalations WHERE self_initiated", _ESCALATIONS),
    "q4_vpn_geo": _sql("SELECT * FROM shared", _SHARED),
    "q5_long_sessions": _sql("SELECT * FROM long_use", _LONG),
    "q6_late_directory_event": _sql("SELECT * FROM late", _LATE),
    "v1_volumes": _sql("""
  SELECT 'logins' AS metric, count(*) AS n FROM logins UNION ALL SELECT 'requests', count(*) FROM requests
  UNION ALL SELECT 'directory', count(*) FROM directory UNION ALL SELECT 'app', count(*) FROM app
  UNION ALL SELECT 'hr', count(*) FROM hr UNION ALL SELECT 'unique_users', count(DISTINCT "user") FROM logins"""),
    "v2_anomalies_per_code": _sql("""
  SELECT split_part(anomaly_description, ':', 1) AS code, count(*) AS n, count(DISTINCT "user") AS users
  FROM label_rows GROUP BY ALL"""),
    "v3_unused_approval_count": _sql("""
  SELECT count(*) AS n FROM (SELECT req_id FROM requests WHERE status = 'APPROVED' EXCEPT SELECT request_id FROM app)"""),
    "v4_unknown_session_count": _sql("""
  SELECT count(*) AS n FROM (
    SELECT session_id FROM app WHERE session_id IS NOT NULL EXCEPT SELECT session_id FROM logins WHERE status = 'SUCCESS')"""),
    "v5_directory_linkage": _sql("""
  SELECT count(request_id) AS linked, count(*) AS total, round(count(request_id) / count(*), 6) AS rate FROM directory"""),
    "v6_usage_before_login": _sql("""
  SELECT count(*) AS n FROM app a JOIN logins l ON l.session_id = a.session_id WHERE a.ts < l.ts"""),
    "v7_long_session_count": _sql("""
  SELECT count(*) AS n FROM app a JOIN logins l ON l.session_id = a.session_id WHERE a.ts > l.ts + INTERVAL 8 HOUR"""),
    "v8_lifecycle_violations": _sql(f"""
  SELECT e.source, count(*) AS events, count(*) FILTER ({_OUTSIDE}) AS violations
  FROM all_events e LEFT JOIN hr h ON h."user" = e."user" WHERE e.source <> 'request' GROUP BY e.source"""),
    "v9_date_range": _sql("SELECT min(ts) AS first_event, max(ts) AS last_event FROM all_events"),
    "l1_label_scores": _sql("""
  SELECT code, count(*) FILTER (l) AS labelled, count(*) FILTER (f) AS flagged, count(*) FILTER (l AND f) AS true_positives,
    round(count(*) FILTER (l AND f) / nullif(count(*) FILTER (f), 0), 6) AS precision,
    round(count(*) FILTER (l AND f) / nullif(count(*) FILTER (l), 0), 6) AS recall
  FROM (
    SELECT coalesce(a."user", b."user") AS "user", coalesce(a.code, b.code) AS code, a.code IS NOT NULL AS l, b.code IS NOT NULL AS f
    FROM (SELECT DISTINCT "user", split_part(anomaly_description, ':', 1) AS code FROM label_rows) a
    FULL JOIN (
      SELECT "user", 'Q1' AS code FROM travel UNION SELECT "user", 'Q2' FROM unused
      UNION SELECT "user", 'Q3' FROM escalations WHERE self_initiated UNION SELECT "user", 'Q4' FROM shared
      UNION SELECT "user", 'Q5' FROM long_use UNION SELECT "user", 'Q6' FROM late) b
    ON a."user" = b."user" AND a.code = b.code)
  GROUP BY code""", _TRAVEL, _UNUSED, _ESCALATIONS, _SHARED, _LONG, _LATE),
    "n1_messages_app": _sql("SELECT *, 'app_usage' AS attr_source, CAST(NULL AS VARCHAR) AS _raw FROM app"),
    "n1_messages_logins": _sql("SELECT *, 'okta' AS attr_source, CAST(NULL AS VARCHAR) AS _raw FROM logins"),
    "n7_service_initiators": _sql("SELECT * FROM rewritten", _REWRITTEN),
    "n8_initiator_top10": _sql(_TOP_INITIATORS.format(table="directory")),
    "n8_initiator_top10_after": _sql(_TOP_INITIATORS.format(table="rewritten"), _REWRITTEN),
    "n9_session_attribution": _sql("""
  SELECT a.usage_id, a."user", a.ts, a.app, a.session_id, l.req_id AS login_id, l.ts AS login_ts, l.session_id AS login_session
  FROM app a LEFT JOIN logins l ON l."user" = a."user" AND l.status = 'SUCCESS' AND l.ts <= a.ts
  QUALIFY row_number() OVER (PARTITION BY a.usage_id ORDER BY l.ts DESC NULLS LAST, l.req_id DESC) = 1"""),
    "n11_unseen_files": _sql("""
  SELECT path, count(*) AS n_rows FROM (
    SELECT 'source/' || source || '/' || strftime(ts, '%Y%m%d') || '-data.parquet' AS path, CAST(ts AS DATE) AS day FROM all_events)
  WHERE day > (SELECT min(termination_date) FROM hr) GROUP BY path"""),
    "n12_drop_repeats": _sql("SELECT * FROM directory"),
    "s1_ingest": _sql("""
  SELECT *, strftime(ts, '%Y-%m-%d') AS event_date, (SELECT count(*) FROM app WHERE CAST(substr(usage_id, 2) AS BIGINT) % 10 = 0) AS n_bad FROM app"""),
    "s1_merged_batches": _sql("SELECT * FROM app"),
    "s2_streaming_repeats": _sql("SELECT * FROM directory"),
    "s3_streaming_bypass": _sql(_bypass("TRUE", False, "a.session_id")),
    "s3_late_rows": _sql(_bypass("TRUE", False, "a.session_id")),
    "s3_streaming_shadow_access": "",
    "s4_daily_counts": _sql("""
  SELECT date_trunc('day', ts) AS day_start, "user", count(*) AS n FROM directory GROUP BY ALL"""),
    "s5_sessions": _sql("""
  SELECT "user", min(ts) AS session_start, max(ts) + INTERVAL 8 HOUR AS session_end, count(*) AS n FROM (
    SELECT "user", ts, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY "user" ORDER BY ts) AS run FROM (
      SELECT "user", ts, coalesce(ts - lag(ts) OVER (PARTITION BY "user" ORDER BY ts) > INTERVAL 8 HOUR, TRUE) AS new FROM app))
  GROUP BY "user", run"""),
}
ORACLE["s3_streaming_shadow_access"] = ORACLE["d01_shadow_access"]
ORACLE["j1_job_twice"] = ORACLE["d02_impossible_login"]
ORACLE["r2_two_generations"] = _sql("SELECT * FROM app")
ORACLE["r2_day_range"] = f"""
  SELECT 'escalation' AS kind, "user", ts, event_id AS detail FROM ({ORACLE["d08_unrequested_escalation"]})
  UNION ALL SELECT 'orphan', "user", ts, missing_kind || ':' || event_id FROM ({ORACLE["d19_orphan_events"]})
  UNION ALL SELECT 'bypass', "user", mfa_failure_time, app_accessed || ':' || seconds_after_failure FROM ({ORACLE["d03_mfa_bypass"]})"""
ORACLE["j1_partials"] = f"""
  SELECT 'role' AS kind, "user" AS name, concat_ws(':', role, n, n_roles, first_role, last_role, drift) AS detail FROM ({ORACLE["d13_role_drift"]})
  UNION ALL SELECT 'stale', "user", concat_ws(':', app, days_idle, never_used) FROM ({ORACLE["d14_stale_access"].replace("14 * 86400", "30 * 86400")})
  UNION ALL SELECT 'approver', approver, concat_ws(':', decisions, approvals, self_approvals, requesters, suspicious)
  FROM ({ORACLE["d17_approver_behaviour"]})
  UNION ALL SELECT 'churn', "group", concat_ws(':', week, adds, removes, escalations, distinct_users) FROM ({ORACLE["d18_group_churn"]})
  UNION ALL SELECT 'orphan', "user", reason || ':' || n_events FROM ({ORACLE["d20_orphan_users"]})
  UNION ALL SELECT 'risk', "user", concat_ws(':', risk_score, unique_countries, total_logins, unexplained_app_usage) FROM ({ORACLE["d04_risk_scores"]})"""
ORACLE["n11_ledger"] = ORACLE["d02_impossible_login"]
ORACLE["r5_csv"] = _sql("SELECT * FROM requests")
ORACLE["w1_append"] = ORACLE["w6_rerun"] = f"""
  SELECT * EXCLUDE self_initiated, CASE WHEN CAST(substr(event_id, 2) AS BIGINT) % 2 = 1 THEN self_initiated END AS self_initiated
  FROM ({ORACLE["d08_unrequested_escalation"]})"""
_DEFAULTS = {
    "excessive_data_transferred": ("d12_excessive_data", "> 100", "> 1000"),
    "stale_access": ("d14_stale_access", "14 * 86400", "30 * 86400"),
    "multi_app_single_session": ("d15_multi_app_session", ">= 2", ">= 3"),
}
_TABLE_QUERIES = {
    "impossible_login_anomalies": "d02_impossible_login", "mfa_bypass_events": "d03_mfa_bypass", "mfa_bypass_events_all_apps": "d06_mfa_bypass_all_apps",
    "impossible_travel_events": "d07_impossible_travel", "privilege_escalation_without_request": "d08_unrequested_escalation",
    "ad_volume_spikes": "d09_volume_spikes", "rejected_but_executed": "d10_rejected_but_executed", "high_risk_sequence": "d11_high_risk_sequence",
    "role_drift": "d13_role_drift", "mfa_drift": "d16_mfa_drift", "suspicious_approver_behavior": "d17_approver_behaviour", "churn": "d18_group_churn",
    "orphan_event_detection": "d19_orphan_events", "orphan_user_detection": "d20_orphan_users", "cleanest_users": "d21_cleanest_users",
    "shadow_access_events": "d01_shadow_access", "risk_scores": "d04_risk_scores", "identity_timelines": "d05_timelines", "suspicious_time_warp": "d22_time_warp",
}
ORACLE["j1_all_tables"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS n FROM ({sql})" for table, sql in {
        **{table: ORACLE[name] for table, name in _TABLE_QUERIES.items()},
        **{table: ORACLE[name].replace(shown, default) for table, (name, shown, default) in _DEFAULTS.items()},
    }.items())
