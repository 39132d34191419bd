"""Every detector at the edges of its rule, on rows made by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from support import at, rows

from idwarden.operators import access, activity, integrity, logins, profile, quality

H = 3600


def login(i, user="u", sec=0.0, status="SUCCESS", session=None, country="UK", ip="1.1.1.1", mfa="TOTP"):
    return dict(req_id=f"l{i}", user=user, ts=None if sec is None else at(sec), status=status, session_id=session,
                country=country, ip=ip, mfa=mfa)


def use(i, user="u", sec=0.0, app="Jira", action="view", session=None, request=None, mb=1.0, duration=60):
    return dict(usage_id=f"u{i}", user=user, ts=None if sec is None else at(sec), app=app, action=action,
                session_id=session, request_id=request, data_mb=mb, duration=duration)


def ask(i, user="u", sec=0.0, app="Jira", role="Reader", status="APPROVED", approver="boss"):
    return dict(req_id=f"r{i}", user=user, ts=at(sec), app=app, role=role, status=status, approver=approver)


def group(i, user="u", sec=0.0, name="DBA", action="add_member", initiator="svc_saviynt", request=None):
    return dict(event_id=f"e{i}", user=user, ts=at(sec), group=name, action=action, initiator=initiator, request_id=request)


def test_shadow_access_window(make):
    apps = [use(i, sec=s, app=f"app{s}") for i, s in enumerate((-1, 0, 86400, 86401))]
    src = make(ad=[group(1)], app_usage=apps)
    assert rows(access.shadow_access(src), "app_accessed") == [("app0",), ("app86400",)]


def test_shadow_access_grants(make):
    grants = [
        group(1, name="Finance"), group(2, name="DevOps"), group(3, name="DBA", request="r1"),
        group(4, name="Security-Admins", request="r9"), group(5, name="DBA", action="remove_member"),
        group(6, name="DBA", user="other"),
    ]
    src = make(ad=grants, app_usage=[use(1, sec=10)], saviynt=[ask(1, user="someone", status="REJECTED")])
    found = rows(access.shadow_access(src), "privileged_group_gained")
    assert found == [("DBA",), ("DevOps",), ("Security-Admins",)]
    narrowed = access.shadow_access(src, actions=["remove_member"])
    assert rows(narrowed, "privileged_group_gained") == [("DBA",)]


def test_impossible_login_sessions(make):
    apps = [use(i, sec=s, session="s", app=str(s)) for i, s in enumerate((-1, 0, 1800, 1801))]
    apps.append(use(9, user="other", sec=9999, session="s"))
    src = make(okta=[login(1, session="s")], app_usage=apps)
    assert rows(logins.impossible_login(src), "app_accessed", "time_diff_sec") == [("-1", -1), ("1801", 1801)]


def test_impossible_login_without_session(make):
    apps = [use(i, sec=s, app=str(s)) for i, s in enumerate((-7201, -7200, 100, 7200, 7201))]
    apps += [use(8, user="nologin", app="alone"), use(9, sec=None, app="undated")]
    src = make(okta=[login(1, status="FAILED")], app_usage=apps)
    assert rows(logins.sessionless_login_gaps(src), "app_accessed") == [("-7200",), ("7200",)]
    none = rows(logins.usage_without_login(src), "app_accessed", "time_of_login", "time_diff_sec")
    assert none == [("-7201", None, None), ("7201", None, None), ("alone", None, None), ("undated", None, None)]


def test_mfa_bypass_window_and_first_access(make):
    apps = [use(i, sec=s, app=str(s), session="x") for i, s in enumerate((0, 1, 3600, 3601))]
    src = make(okta=[login(1, status="MFA_FAILED")], app_usage=apps)
    assert rows(logins.mfa_bypass(src), "app_accessed", "failure_reason") == [("1", "MFA_FAILED")]
    assert rows(logins.mfa_bypass_all_apps(src), "app_accessed", "app_session_id") == [("1", "x"), ("3600", "x")]


def test_mfa_bypass_both_without_session_is_found_twice(make):
    src = make(okta=[login(1, status="FAILED"), login(2, status="SUCCESS")], app_usage=[use(1, sec=5), use(2, sec=5)])
    found = rows(logins.mfa_bypass(src), "mfa_failure_time", "seconds_after_failure", "app_session_id")
    assert found == [(at(0), 5, None)] * 2


def test_mfa_bypass_ties(make):
    two_failures = [login(2, status="FAILED"), login(1, status="MFA_FAILED")]
    apps = [use(2, sec=5, app="later id", session="x"), use(1, sec=5, app="first id", session="x")]
    src = make(okta=two_failures, app_usage=apps)
    assert rows(logins.mfa_bypass(src), "failure_reason", "app_accessed") == [("MFA_FAILED", "first id")]


def test_mfa_bypass_session_of_another_user(make):
    src = make(okta=[login(1, status="FAILED", session="s")], app_usage=[use(1, user="other", sec=5, session="s"), use(2, sec=9, session="s")])
    assert rows(logins.same_session_bypass(src), "user", "seconds_after_failure") == [("u", 9)]
    loose = logins.same_session_bypass(src, match_user=False)
    assert rows(loose, "user", "seconds_after_failure") == [("u", 5), ("u", 9)]


def test_risk_scores(make):
    src = make(
        okta=[login(1, status="FAILED"), login(2, country="USA"), login(3, user="quiet")],
        saviynt=[ask(1), ask(2, user="nologin")],
        ad=[group(1, action="privilege_escalation"), group(2)],
        app_usage=[use(1, request="r1"), use(2, request="r2"), use(3), use(4, request="gone")],
    )
    assert rows(profile.risk_scores(src)) == rows(src.logins.sparkSession.createDataFrame(
        [("quiet", 1, 0, 1, 1, 0, 0, 0, 0, 0), ("u", 2, 1, 1, 2, 1, 1, 2, 3, 2 + 3 + 15)]
    ))


def test_risk_scores_take_the_top(make):
    src = make(okta=[login(i, user=f"user{i:03d}", status="FAILED") for i in range(120)])
    top = [r.user for r in profile.risk_scores(src).collect()]
    assert top == [f"user{i:03d}" for i in range(100)]


def test_timelines(make):
    src = make(
        okta=[login(1, ip=None)], saviynt=[ask(1)], app_usage=[use(1, mb=2.5), use(2, mb=None, sec=1)],
    )
    told = [(r.event_type, r.details) for r in profile.timelines(src, ordered=True).collect()]
    assert sorted(told) == [
        ("App Usage", "Jira | view"), ("App Usage", "Jira | view | 2.50"),
        ("Okta Login", "Status: SUCCESS | Country: UK | IP | MFA: TOTP"), ("SAV Request", "Jira | Reader | APPROVED"),
    ]


def test_impossible_travel(make):
    src = make(okta=[
        login(1, country="UK", ip="1"), login(2, sec=60, country="Japan", status="FAILED", ip="9"),
        login(3, sec=200, country="Japan", ip="2"), login(4, sec=300, country="UK", ip="2"),
        login(5, sec=300 + 3600, country="India", ip="3"), login(6, sec=300 + 3600 + 3601, country="UK", ip="4"),
    ])
    found = rows(logins.impossible_travel(src), "prev_country", "country", "gap_sec")
    assert found == [("UK", "India", 3600), ("UK", "Japan", 200)]
    assert rows(logins.shared_address_countries(src), "ip", "countries", "n") == [("2", ["Japan", "UK"], 2)]


def test_unrequested_escalations(make):
    e = "privilege_escalation"
    src = make(
        saviynt=[ask(1, sec=-5), ask(2, user="other", sec=-5), ask(3, sec=5)],
        ad=[
            group(1, action=e, request="r1"), group(2, action=e, request="r2"), group(3, action=e, request="r3"),
            group(4, action=e, initiator="u"), group(5, action="add_member"), group(6, action=e, initiator=None),
        ],
    )
    found = rows(access.unrequested_escalations(src), "event_id", "self_initiated")
    assert found == [("e2", False), ("e3", False), ("e4", True), ("e6", False)]


def test_volume_spikes(make):
    day = 86400
    counts = {0: 3, 1: 1, 2: 4, 3: 5}
    events = [group(f"{d}-{n}", sec=d * day + n) for d, total in counts.items() for n in range(total)]
    src = make(ad=events)
    # The first day has no baseline; day 2 is exactly twice the mean of 3 and 1.
    assert rows(activity.volume_spikes(src), "day", "n", "baseline") == [(date(2025, 10, 8), 4, 2.0)]
    assert rows(activity.volume_spikes(src, entity="group"), "entity", "n") == [("DBA", 4)]
    with pytest.raises(ValueError):
        activity.volume_spikes(src, entity="app")


def test_rejected_but_executed(make):
    src = make(
        saviynt=[ask(1, status="REJECTED"), ask(2)], app_usage=[use(1, request="r1", user="v"), use(2, request="r2")],
        ad=[group(1, request="r1")],
    )
    assert rows(access.rejected_but_executed(src), "executor", "executed_in") == [("u", "directory"), ("v", "app")]


def test_high_risk_sequences(make):
    day = 86400
    src = make(
        okta=[login(1, status="FAILED"), login(2, sec=day + 50, status="FAILED"), login(3)],
        ad=[
            group(1, sec=10, action="privilege_escalation"), group(2, sec=day, action="privilege_escalation"),
            group(3, sec=60, action="add_member"),
        ],
        app_usage=[
            use(1, sec=5, action="upload"), use(2, sec=day + 11, action="download"), use(3, sec=day + 12, action="upload"),
            use(4, sec=20, action="view"),
        ],
    )
    # The escalation at 10 s has no transfer within a day, the one after a day has.
    found = rows(profile.high_risk_sequences(src), "req_id", "escalation_ts", "app_ts", "action")
    assert found == [("l1", at(day), at(day + 11), "download")]


def test_excessive_data(make):
    src = make(app_usage=[
        use(1, mb=600.0), use(2, mb=400.0), use(3, user="v", mb=700.0, action="upload"), use(4, user="v", mb=300.01),
        use(5, user="w", mb=999.0), use(6, user="w", mb=999.0, sec=86400),
    ])
    assert rows(activity.excessive_data(src), "user", "total_mb", "n_events") == [("v", 1000.01, 2)]
    assert rows(activity.excessive_data(src, threshold_mb=500, actions=["upload"]), "user") == [("v",)]


def test_role_history(make):
    src = make(saviynt=[ask(1), ask(2, sec=5, role="Admin"), ask(3, sec=9), ask(4, user="v")])
    assert rows(access.role_history(src), "user", "role", "n", "n_roles", "first_role", "last_role", "drift") == [
        ("u", "Admin", 1, 2, "Reader", "Reader", True), ("u", "Reader", 2, 2, "Reader", "Reader", True),
        ("v", "Reader", 1, 1, "Reader", "Reader", False),
    ]


def test_stale_access(make):
    day = 86400
    src = make(
        saviynt=[ask(1, app="never"), ask(2, app="old"), ask(3, app="edge"), ask(4, app="fresh"), ask(5, app="no", status="PENDING")],
        app_usage=[use(1, app="old", sec=10 * day - 1), use(2, app="edge", sec=10 * day), use(3, app="fresh", sec=40 * day)],
    )
    found = rows(access.stale_access(src), "app", "days_idle", "never_used")
    assert found == [("never", 40, True), ("old", 30, False)]
    assert rows(access.stale_access(src, as_of=str(at(60 * day))), "app") == [("edge",), ("never",), ("old",)]


def test_multi_app_sessions(make):
    src = make(app_usage=[use(i, app=a, session=s, sec=i) for i, (a, s) in enumerate(
        [("b", "s"), ("a", "s"), ("c", "s"), ("a", "s"), ("a", "t"), ("b", "t"), ("a", None), ("b", None), ("c", None)]
    )])
    assert rows(activity.multi_app_sessions(src)) == [("u", "s", 3, ["a", "b", "c"], at(0), at(3))]


def test_mfa_drift(make):
    src = make(okta=[login(i, sec=i * 5000, mfa=m) for i, m in enumerate(["TOTP", "TOTP", "SMS", "TOTP", "Push", "Push"])])
    assert rows(logins.mfa_drift(src), "ts", "prev_mfa", "mfa", "n_methods") == sorted([
        (at(10000), "TOTP", "SMS", 2), (at(15000), "SMS", "TOTP", 2), (at(20000), "TOTP", "Push", 3),
    ], key=repr)


def test_approver_behaviour(make):
    asks = [ask(f"a{i}", user=f"x{i}", approver="easy") for i in range(9)] + [ask("a9", approver="easy", status="REJECTED")]
    asks += [ask("b", user="me", approver="me")] + [ask(f"c{i}", approver="few") for i in range(4)]
    asks += [ask("d", approver="few", status="PENDING")]
    found = rows(access.approver_behaviour(make(saviynt=asks)), "approver", "decisions", "approval_rate", "self_approvals", "suspicious")
    assert found == [("easy", 10, 0.9, 0, True), ("few", 4, 1.0, 0, False), ("me", 1, 1.0, 1, True)]


def test_group_churn(make):
    src = make(ad=[
        group(1), group(2, user="v"), group(3, action="remove_member"), group(4, action="privilege_escalation"),
        group(5, sec=7 * 86400),
    ])
    assert rows(activity.group_churn(src)) == [
        ("DBA", date(2025, 10, 13), 1, 0, 0, 1, 1.0), ("DBA", date(2025, 10, 6), 2, 1, 1, 2, 1.5),
    ]


def test_orphan_events(make):
    src = make(
        okta=[login(1, session="good"), login(2, status="FAILED", session="bad")], saviynt=[ask(1)],
        app_usage=[use(1, request="r1", session="good"), use(2, request="r2"), use(3, session="bad"), use(4)],
        ad=[group(1, request="r1"), group(2, request="r3"), group(3)],
    )
    assert rows(integrity.orphan_events(src), "event_id", "missing_kind", "missing_key") == [
        ("e2", "request", "r3"), ("u2", "request", "r2"), ("u3", "session", "bad"),
    ]


def hr_row(user="u", join=date(2025, 10, 6), end=None):
    return dict(user=user, join_date=join, termination_date=end)


def test_lifecycle_edges(make):
    def seen(i, when, user="u"):
        return dict(login(i, user=user), ts=when)

    src = make(
        hrlifecycle=[hr_row(end=date(2025, 10, 10)), hr_row("stays")],
        okta=[
            seen(1, datetime(2025, 10, 5, 23, 59, 59)), seen(2, datetime(2025, 10, 6)),
            seen(3, datetime(2025, 10, 10)), seen(4, datetime(2025, 10, 10, 0, 0, 1)), seen(5, datetime(2025, 10, 11)),
            seen(6, datetime(2030, 1, 1), "stays"), seen(7, datetime(2025, 10, 7), "ghost"),
        ],
        saviynt=[dict(ask(1), ts=datetime(2026, 1, 1))],
        app_usage=[use(1)],
    )
    assert rows(integrity.orphan_users(src)) == [
        ("ghost", "unknown", 1, datetime(2025, 10, 7), datetime(2025, 10, 7)),
        ("u", "outside_lifecycle", 4, datetime(2025, 10, 5, 23, 59, 59), datetime(2026, 1, 1)),
    ]
    assert rows(quality.lifecycle_violations(src)) == [("app", 1, 0), ("login", 7, 3)]


def test_cleanest_users(make):
    src = make(
        okta=[login(1, user="bad", status="FAILED"), login(2, user="good"), login(3, user="good"), login(4, user="calm")],
        app_usage=[use(1, user="bad")],
    )
    found = [tuple(r) for r in profile.cleanest_users(src).collect()]
    assert found == [("good", 0, 2), ("calm", 0, 1), ("bad", 2, 2)]
    assert [r.user for r in profile.cleanest_users(src, max_findings=0).collect()] == ["good", "calm"]


def test_time_warp(make):
    src = make(
        okta=[login(1, sec=100, session="s"), login(2, sec=200, session="s"), login(3, session="s", status="FAILED")],
        saviynt=[ask(1, sec=50)],
        app_usage=[use(1, sec=99, session="s"), use(2, sec=100, session="s"), use(3, sec=40, request="r1"), use(4, user="v", sec=1, session="s")],
        ad=[group(1, sec=49, request="r1"), group(2, sec=50, request="r1")],
    )
    assert rows(integrity.time_warp(src), "event_id", "kind", "seconds_early") == [
        ("e1", "directory_before_request", 1), ("u1", "usage_before_login", 1), ("u3", "usage_before_request", 10),
    ]


def test_session_rules(make):
    src = make(
        okta=[login(1, session="s"), login(2, sec=H, session="s"), login(3, user="v", sec=-9 * H, session="t")],
        app_usage=[use(1, sec=8 * H, session="s"), use(2, sec=8 * H + 1, session="s")],
        ad=[group(1, sec=9 * H), group(2, sec=9 * H + 1), group(3, sec=14 * H), group(4, sec=14 * H + 1), group(5, user="w")],
    )
    assert rows(activity.long_sessions(src), "usage_id", "seconds_after_login") == [("u2", 8 * H + 1)]
    assert rows(activity.late_directory_events(src), "event_id", "login_id", "seconds_late") == [("e2", "l2", 1), ("e3", "l2", 5 * H)]
    assert rows(activity.session_attribution(src), "usage_id", "login_id") == [("u1", "l2"), ("u2", "l2")]
    assert rows(quality.long_session_count(src)) == [(1,)]
    assert rows(quality.usage_before_login_count(src)) == [(0,)]


def test_label_scores(make):
    src = make(
        saviynt=[ask(1, user="a"), ask(2, user="b")],
        anomaly_key=[
            dict(user="a", anomaly_description="Q2: ORPHAN REQUEST: r1 approved but unused"),
            dict(user="c", anomaly_description="Q2: ORPHAN REQUEST: r9 approved but unused"),
            dict(user="c", anomaly_description="Q5: LONG SESSION: 9.0h > 8h"),
        ],
    )
    assert rows(quality.label_scores(src)) == [("Q2", 2, 2, 1, 0.5, 0.5), ("Q5", 1, 0, 0, None, 0.0)]
    assert rows(quality.anomalies_per_code(src)) == [("Q2", 2, 2), ("Q5", 1, 1)]


def test_every_detector_runs_without_rows(make):
    from idwarden.plans.registry import DETECTORS

    src = make()
    for detector in DETECTORS.values():
        assert detector.fn(src).count() == 0


@pytest.mark.parametrize("call", [
    lambda s: access.shadow_access(s, window_sec=0), lambda s: logins.impossible_login(s, grace_sec=-1),
    lambda s: logins.mfa_bypass(s, window_sec=-5), lambda s: profile.risk_scores(s, top=0),
    lambda s: access.approver_behaviour(s, approval_rate=1.5), lambda s: activity.multi_app_sessions(s, min_apps=0),
])
def test_parameters_are_checked(make, call):
    with pytest.raises(ValueError):
        call(make())


def test_cleanest_users_add_up_single_findings(spark, make):
    """Rows with and without users, times, requests and sessions; requests of others, later ones, and two of one id."""
    from idwarden.operators.access import unrequested_escalations
    from idwarden.operators.integrity import orphan_events

    users, keys = ("u", "v", "w", None), ("r1", "r2", "r3", "-5", None)
    when = lambda n: None if n % 7 == 0 else at(n)
    src = make(
        okta=[{**login(n, user=users[n % 4], status=("FAILED", "SUCCESS", None)[n % 3], session=("s", "t", None)[n % 5 % 3]), "ts": when(n)} for n in range(30)],
        saviynt=[{**ask(n), "req_id": ("r1", "r2", None)[n % 3], "user": users[n % 4], "ts": when(3 * n)} for n in range(12)],
        app_usage=[{**use(n, user=users[n % 4], request=keys[n % 5], session=("s", "x", None)[n % 3]), "ts": when(n)} for n in range(60)],
        ad=[{**group(n, user=users[n % 4], request=keys[n % 5]), "action": ("privilege_escalation", "add_member", None)[n % 3], "ts": when(n)} for n in range(60)],
    )
    want = {}
    for found in (src.logins.where("status LIKE '%FAIL%'"), unrequested_escalations(src), profile.unexplained_usage(src), orphan_events(src)):
        for r in found.where("user IS NOT NULL").collect():
            want[r.user] = want.get(r.user, 0) + 1
    totals = {r.user: r.n for r in src.events().where("user IS NOT NULL").groupBy("user").agg(F.count("*").alias("n")).collect()}
    got = {r.user: (r.findings, r.total_events) for r in profile.cleanest_users(src).collect()}
    assert got == {u: (want.get(u, 0), n) for u, n in totals.items()}


def test_cleanest_users_reads_each_event_once(spark):
    from idwarden.sources.events_view import read_events, sources_from_events

    found = profile.cleanest_users(sources_from_events(read_events(spark, "/root/testdata/sf0.001")))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 7
