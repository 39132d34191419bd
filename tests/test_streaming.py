"""Incremental jobs over folders that grow between runs."""

import json

import pytest
from pyspark.sql import functions as F
from support import at, rows

from idwarden.operators.access import shadow_access
from idwarden.operators.logins import mfa_bypass_all_apps
from idwarden.plans.sinks import write_days
from idwarden.sources.readers import read_parquet
from idwarden.streaming import jobs
from idwarden.streaming.folders import run_folder, shared_folder


def put(folder, name, *payloads):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(p if isinstance(p, str) else json.dumps(p) for p in payloads) + "\n")


def drained(df, folder):
    jobs.append_stream(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def test_ingest_takes_each_file_once(spark, tmp_path):
    inbox = tmp_path / "in"

    def run():
        stream = jobs.source_stream(spark, "okta", str(inbox), fmt="json")
        jobs.ingest(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/out"), "req_id", "session_id")

    put(inbox, "a.json", {"req_id": "l1", "ts": "2025-10-06 12:00:00", "session_id": ""}, "broken")
    assert run() == [("l1", None)]
    assert rows(spark.read.parquet(jobs.bad_lines(f"{tmp_path}/out")), "_raw") == [("broken",)]
    assert run() == [("l1", None)]
    put(inbox, "late.json", {"req_id": "l2", "ts": "2025-10-01 12:00:00", "session_id": "s"})
    assert run() == [("l1", None), ("l2", "s")]
    days = {r.event_date for r in spark.read.parquet(f"{tmp_path}/out").select("event_date").collect()}
    assert len(days) == 2
    # What another job adds is read too.
    write_days(spark.createDataFrame([("l3", None)], "req_id string, session_id string").withColumn("ts", F.to_timestamp_ntz(F.lit("2025-10-06 13:00:00"))), f"{tmp_path}/out")
    assert rows(read_parquet(spark, "okta", f"{tmp_path}/out"), "req_id") == [("l1",), ("l2",), ("l3",)]


def test_csv_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "hr.csv", "user,join_date,move_date1,move_date2,termination_date,department,job_role,location", "u,2025-10-06,,,,HR,Analyst,UK")
    stream = jobs.source_stream(spark, "hrlifecycle", str(inbox), fmt="csv")
    assert rows(drained(stream, tmp_path), "user", "termination_date", "location") == [("u", None, "UK")]


def test_csv_with_another_header_stops(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "ad.csv", "ts,event_id,user,group,action,initiator,ip,request_id", "2025-10-06 12:00:00,e1,u,g,add,i,ip,r")
    with pytest.raises(Exception, match="(?i)header|STREAM_FAILED"):
        drained(jobs.source_stream(spark, "ad", str(inbox), fmt="csv"), tmp_path)


def test_older_names_stream_in(spark, tmp_path):
    spark.createDataFrame([("l1", "2025-10-06 12:00:00", "FAILED")], "req_id string, timestamp string, login_status string").write.parquet(f"{tmp_path}/in")
    out = drained(jobs.source_stream(spark, "okta", f"{tmp_path}/in", fmt="parquet"), tmp_path)
    assert rows(out, "req_id", "ts", "status") == [("l1", at(0), "FAILED")]


def test_repeats_over_three_runs(spark, tmp_path):
    """A late event that is new is kept, whatever came before it."""
    inbox = tmp_path / "in"
    event = {"event_id": "e1", "ts": "2025-10-10 12:00:00"}
    put(inbox, "a.json", event, {"event_id": "e2", "ts": "2025-10-10 12:00:05"}, event, {"user": "no id"}, {"user": "no id"})

    def run():
        stream = jobs.source_stream(spark, "ad", str(inbox), fmt="json", files_per_trigger=1)
        jobs.ingest(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", event_id="event_id").awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/out"), "event_id")

    assert len(run()) == 4
    put(inbox, "b.json", event, {"event_id": "e3", "ts": "2025-10-05 12:00:09"})
    assert [i for i, in run() if i] == ["e1", "e2", "e3"]
    put(inbox, "c.json", {"event_id": "e3", "ts": "2025-10-05 12:00:09"}, {"event_id": "e4", "ts": "2025-10-01 00:00:00"})
    assert [i for i, in run() if i] == ["e1", "e2", "e3", "e4"]


def test_an_id_with_another_time_is_known(spark, tmp_path):
    inbox = tmp_path / "in"

    def run():
        stream = jobs.source_stream(spark, "ad", str(inbox), fmt="json")
        jobs.ingest(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", event_id="event_id").awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/out"), "event_id", "ts")

    put(inbox, "a.json", {"event_id": "e1", "ts": "2025-10-06 12:00:05"}, {"event_id": "e1", "ts": "2025-10-06 12:00:00"}, {"event_id": "e1"})
    assert run() == [("e1", at(0))]
    put(inbox, "b.json", {"event_id": "e1", "ts": "2025-12-01 12:00:00"}, {"event_id": "e1"}, {"event_id": "e2"})
    assert run() == [("e1", at(0)), ("e2", None)]
    put(inbox, "c.json", {"event_id": "e2", "ts": "2025-10-06 12:00:00"}, {"event_id": "e1", "ts": "2025-10-06 12:00:00"})
    assert run() == [("e1", at(0)), ("e2", None)]
    # An event that another job added is known on its day, and on any other once it is listed.
    other = spark.createDataFrame([("e3", at(0))], "event_id string, ts timestamp_ntz")
    write_days(other, f"{tmp_path}/out")
    jobs.index_events(spark, f"{tmp_path}/out", "event_id")
    put(inbox, "d.json", {"event_id": "e3", "ts": "2025-11-06 12:00:00"}, {"event_id": "e3", "ts": "2025-10-06 12:00:09"})
    assert run() == [("e1", at(0)), ("e2", None), ("e3", at(0))]


def test_a_failed_try_leaves_no_known_ids(spark, tmp_path):
    """Ids that a batch listed before it failed do not count against its next try."""
    batch = spark.createDataFrame([("e1", at(0))], "event_id string, ts timestamp_ntz")
    jobs._write_ids(batch, str(tmp_path), "event_id", "b-000000")
    assert jobs._new_events(batch, str(tmp_path), "event_id", "b-000000").count() == 1
    assert jobs._new_events(batch, str(tmp_path), "event_id", "b-000001").count() == 0


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    df = spark.createDataFrame([("e1",)], "event_id string").withColumn("ts", F.to_timestamp_ntz(F.lit("2025-10-06 13:00:00")))
    for _ in range(2):
        write_days(jobs._new_events(df, f"{tmp_path}/out", "event_id", "b-1"), f"{tmp_path}/out", batch="b-1")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    assert jobs._new_events(df, f"{tmp_path}/out", "event_id", "b-2").count() == 0


def test_bypass_over_two_runs_equals_batch(spark, make, tmp_path):
    src = make(
        okta=[dict(req_id=f"l{i}", user="u", ts=at(i * 700), status="FAILED") for i in range(4)],
        app_usage=[dict(usage_id=f"u{i}", user="u", ts=at(i * 900), app="Jira") for i in range(7)],
    )
    login_in, app_in = tmp_path / "logins", tmp_path / "app"
    for run in range(2):
        src.logins.where(f"cast(substr(req_id, 2) as int) % 2 = {run}").write.mode("append").parquet(str(login_in))
        src.app.where(f"cast(substr(usage_id, 2) as int) % 2 = {run}").write.mode("append").parquet(str(app_in))
        logins = spark.readStream.schema(src.logins.schema).parquet(str(login_in))
        app = spark.readStream.schema(src.app.schema).parquet(str(app_in))
        out = drained(jobs.bypass_stream(logins, app, delay="1 day"), tmp_path)
    columns = ["mfa_failure_time", "app_access_time", "seconds_after_failure"]
    assert rows(out, *columns) == rows(mfa_bypass_all_apps(src), *columns)


def test_shadow_access_earlier_in_the_same_second_equals_batch(spark, make, tmp_path):
    src = make(
        ad=[dict(event_id="e1", user="u", ts=at(0.9), group="DBA", initiator="i")],
        app_usage=[dict(usage_id=f"u{i}", user="u", ts=at(t), app=f"a{i}") for i, t in enumerate((-0.1, 0.2, 0.9, 3600.95, 3601.1))],
    )
    src.directory.write.parquet(f"{tmp_path}/directory")
    src.app.write.parquet(f"{tmp_path}/app")
    streams = [spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}") for name, df in (("directory", src.directory), ("app", src.app))]
    out = drained(jobs.shadow_stream(streams[0], src.requests, streams[1], window_sec=3600), tmp_path)
    columns = ["time_of_privilege_grant", "time_of_app_access", "app_accessed"]
    assert rows(out, *columns) == rows(shadow_access(src, window_sec=3600), *columns)
    assert [r[2] for r in rows(out, *columns)] == ["a1", "a2", "a3"]


class FakeSession:
    """Only what the folder lookup reads; the setting cannot be changed in a running session."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: settings.get(key, default))})


def test_folder_setting_is_read_from_the_session():
    cluster = FakeSession("yarn", **{"spark.checkpoint.dir": "s3://lake/tmp/"})
    assert shared_folder(cluster) == "s3://lake/tmp"
    assert run_folder(cluster, "job") != run_folder(cluster, "job")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        shared_folder(FakeSession("yarn"))
    assert "idwarden-" in shared_folder(FakeSession("local[2]"))


def test_formats_are_checked(spark):
    with pytest.raises(ValueError):
        jobs.source_stream(spark, "okta", "x", fmt="orc")


def test_state_partitions_leave_the_session_as_it_was(spark, make, tmp_path):
    made = make(ad=[dict(event_id="e1", ts=at(0))], app_usage=[dict(usage_id="u1", ts=at(0))])
    made.directory.write.parquet(f"{tmp_path}/in")
    made.app.write.parquet(f"{tmp_path}/app")
    stream = spark.readStream.schema(make().directory.schema).parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    usage = spark.readStream.schema(make().app.schema).parquet(f"{tmp_path}/app")
    query = jobs.append_stream(
        jobs.shadow_stream(stream, make().requests, usage), f"{tmp_path}/out", f"{tmp_path}/checkpoint", state_partitions=3
    )
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
