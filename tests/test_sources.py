"""Reading and normalising raw files."""

import json

import pytest
from support import at, rows
from pyspark.errors import AnalysisException

from idwarden import schemas
from idwarden.plans.sinks import read_table, write_csv, write_source, write_table
from idwarden.sources import (
    drop_repeats,
    flatten_messages,
    has_column,
    initiator_counts,
    is_empty,
    list_files,
    load_sources,
    normalise,
    read_csv,
    read_json_lines,
    read_ledger,
    read_parquet,
    record_files,
    service_initiators,
    source_for_file,
    to_messages,
    unseen_files,
)


def test_blank_keys_become_null(spark):
    raw = spark.createDataFrame(
        [("u1", "2025-10-01 10:00:00", "", " "), ("u2", "nonsense", None, "r1"), ("u3", "", "s ", "r2")],
        "usage_id string, ts string, session_id string, request_id string",
    )
    df = normalise(raw, "app_usage")
    assert df.schema == schemas.APP
    assert [(r.ts is None, r.session_id, r.request_id) for r in df.orderBy("usage_id").collect()] == [
        (False, None, None), (True, None, "r1"), (True, "s", "r2"),
    ]


def test_text_columns_are_cast(spark):
    raw = spark.createDataFrame([("u1", "90", "2.50"), ("u2", "", "x")], "usage_id string, duration string, data_mb string")
    assert rows(normalise(raw, "app_usage"), "duration", "data_mb") == [(90, 2.5), (None, None)]


def test_older_names(spark):
    raw = spark.createDataFrame([("r1", "Emergency")], "req_id string, group string")
    assert rows(normalise(raw, "saviynt"), "justification") == [("Emergency",)]
    raw = spark.createDataFrame([("l1", "2025-10-06 12:00:00", "FAILED")], "req_id string, timestamp string, login_status string")
    assert rows(normalise(raw, "okta"), "ts", "status") == [(at(0), "FAILED")]
    # A directory group keeps its name.
    raw = spark.createDataFrame([("e1", "DBA")], "event_id string, group string")
    assert rows(normalise(raw, "ad"), "group") == [("DBA",)]


def test_messages(spark):
    good = json.dumps({"usage_id": "u1", "ts": "2025-10-06 12:00:00", "duration": "5", "session_id": ""})
    payloads = [good, "not json", "5", '{"usage_id": "cut']
    df = spark.createDataFrame([(p, {"source": "app_usage"}) for p in payloads], "payload string, attributes map<string,string>")
    flat = flatten_messages(df, "app_usage")
    assert rows(flat, "usage_id", "ts", "duration", "session_id", "attr_source", "_raw") == sorted([
        ("u1", at(0), 5, None, "app_usage", None), (None, None, None, None, "app_usage", "not json"),
        (None, None, None, None, "app_usage", "5"), (None, None, None, None, "app_usage", '{"usage_id": "cut'),
    ], key=repr)


def test_message_with_older_name(spark):
    payload = json.dumps({"req_id": "r1", "group": "BAU"})
    df = spark.createDataFrame([(payload, {"source": "saviynt"})], "payload string, attributes map<string,string>")
    assert rows(flatten_messages(df, "saviynt"), "req_id", "justification") == [("r1", "BAU")]


def test_messages_round_trip(make):
    src = make(ad=[dict(event_id="e1", ts=at(0.25), user="u", group="DBA")])
    back = flatten_messages(to_messages(src.directory, "ad"), "ad")
    assert rows(back, "event_id", "ts", "user", "group", "request_id", "attr_source") == [("e1", at(0.25), "u", "DBA", None, "ad")]


def test_missing_path_is_an_empty_source(spark, tmp_path):
    df = read_parquet(spark, "okta", f"{tmp_path}/none/*.parquet")
    assert df.schema == schemas.LOGINS and is_empty(df)
    assert has_column(df, "mfa") and not has_column(df, "nothing")


def test_other_read_errors_are_raised(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        read_parquet(spark, "okta", str(tmp_path / "empty"))


def test_csv(spark, tmp_path):
    path = tmp_path / "ad_group_events.csv"
    path.write_bytes(b"event_id,ts,user,group,action,initiator,ip,request_id\ne1,2025-10-06 12:00:00,us\xffer,DBA,add_member,svc,1.1.1.1,\n")
    df = read_csv(spark, source_for_file(str(path)), str(path))
    assert df.schema == schemas.DIRECTORY
    assert rows(df, "ts", "user", "request_id") == [(at(0), "us�er", None)]
    assert source_for_file("/x/other.csv") is None


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"user": "u", "join_date": "2025-10-06", "termination_date": ""}\nbroken\n')
    found = rows(read_json_lines(spark, "hrlifecycle", str(tmp_path)), "user", "termination_date", "_raw")
    assert found == [("u", None, None), (None, None, "broken")] or found == [(None, None, "broken"), ("u", None, None)]


def test_primary_file_stands_in_for_its_folder(spark, make, tmp_path):
    src = make(okta=[dict(req_id="l1"), dict(req_id="l2")], ad=[dict(event_id="e1")])
    write_source(src.logins.where("req_id = 'l1'"), str(tmp_path), "okta")
    src.logins.where("req_id = 'l2'").write.parquet(f"{tmp_path}/source/new")
    write_source(src.directory, str(tmp_path), "ad")
    whole = load_sources(spark, str(tmp_path), "okta")
    assert rows(whole.logins, "req_id") == [("l1",)] and rows(whole.directory, "event_id") == [("e1",)]
    one = load_sources(spark, str(tmp_path), "okta", "source/new")
    assert rows(one.logins, "req_id") == [("l2",)] and rows(one.directory, "event_id") == [("e1",)]
    assert is_empty(one.hr)
    with pytest.raises(ValueError):
        load_sources(spark, str(tmp_path), "payroll")


def test_days_are_pruned(spark, make, tmp_path):
    day = 86400
    src = make(okta=[dict(req_id=f"l{i}", ts=at(i * day)) for i in range(4)])
    write_source(src.logins, str(tmp_path), "okta")
    some = load_sources(spark, str(tmp_path), days={"okta": ("2025-10-07", "2025-10-08")}).logins
    assert rows(some, "req_id") == [("l1",), ("l2",)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    src.logins.write.parquet(f"{tmp_path}/flat")
    assert rows(read_parquet(spark, "okta", f"{tmp_path}/flat", first_day="2025-10-09"), "req_id") == [("l3",)]


def test_file_name_is_kept_on_request(spark, make, tmp_path):
    make(okta=[dict(req_id="l1")]).logins.write.parquet(f"{tmp_path}/okta")
    df = read_parquet(spark, "okta", f"{tmp_path}/okta", keep_file=True)
    assert df.collect()[0].source_file.endswith(".parquet")


def test_unseen_files(spark):
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    ledger = spark.createDataFrame([("b",), ("b",), ("z",)], "path string")
    assert rows(unseen_files(listing, ledger)) == [("a",), ("c",)]


def test_ledger_over_two_runs(spark, make, tmp_path):
    inbox, ledger = f"{tmp_path}/in", f"{tmp_path}/ledger"

    def run():
        new = unseen_files(list_files(spark, inbox), read_ledger(spark, ledger)).select("path").collect()
        record_files(spark.createDataFrame(new, "path string"), ledger)
        return len(new)

    make(okta=[dict(req_id="l1")]).logins.coalesce(1).write.parquet(f"{inbox}/20251006-a.parquet")
    assert run() == 1
    assert run() == 0
    for name in ("20251006-b.parquet", "20251005-late.parquet"):
        make(okta=[dict(req_id="l2")]).logins.coalesce(1).write.parquet(f"{inbox}/{name}")
    assert run() == 2


def test_service_initiators(make):
    def event(i, initiator, action, group):
        return dict(event_id=i, initiator=initiator, action=action, group=group)

    src = make(ad=[
        event("1", "svc_other", "add_member", "HR"), event("2", "user5", "privilege_escalation", "HR"),
        event("3", "user5", "rename", "Finance"), event("4", "user5", "rename", "Contractor"), event("5", "user5", None, None),
    ])
    assert rows(service_initiators(src.directory), "event_id", "initiator") == [
        ("1", "svc_other"), ("2", "iam_service"), ("3", "finance_bot"), ("4", "automation_engine"), ("5", "automation_engine"),
    ]
    assert [tuple(r) for r in initiator_counts(src.directory, top=1).collect()] == [("user5", 4, True)]


def test_drop_repeats_keeps_rows_without_id(make):
    src = make(ad=[dict(event_id="e1"), dict(event_id="e1"), dict(event_id=None), dict(event_id=None)])
    assert rows(drop_repeats(src.directory, "ad"), "event_id") == sorted([("e1",), (None,), (None,)], key=repr)


def test_table_runs_replace_themselves(spark, tmp_path):
    path = str(tmp_path)
    two = spark.createDataFrame([(1,), (2,)], "a int")
    assert write_table(two, "t", path=path, run_id="r1") == 2
    assert write_table(two, "t", path=path, run_id="r1") == 2
    assert write_table(two.limit(1).selectExpr("a", "'x' AS b"), "t", path=path, run_id="r2") == 1
    assert rows(read_table(spark, path, "t").groupBy("run_id").count()) == [("r1", 2), ("r2", 1)]
    assert "b" in read_table(spark, path, "t").columns
    assert write_table(two.where("a > 5"), "t", path=path, run_id="r2") == 0
    assert read_table(spark, path, "t").count() == 2


def test_plain_append_skips_empty_frames(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    assert write_table(df.where("a > 1"), "t", path=str(tmp_path)) == 0
    assert not (tmp_path / "t").exists()
    write_table(df, "t", path=str(tmp_path))
    write_table(df, "t", path=str(tmp_path), fmt="parquet", options={"compression": "none"})
    assert read_table(spark, str(tmp_path), "t").count() == 2


def test_sink_without_files(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert write_table(df, "t", fmt="noop", options={"table": "set.{table}"}) == 1


def test_csv_sink(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, "x")], "a int, b string"), f"{tmp_path}/deep/er")
    assert rows(spark.read.option("header", True).csv(f"{tmp_path}/deep/er")) == [("1", "x")]
