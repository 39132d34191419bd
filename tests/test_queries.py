"""Registered queries against their SQL at the smallest scale, and the shape of their plans."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from check import TABLES, rows_of
from idwarden.plans.catalog import QUERIES
from idwarden.plans.oracle import ORACLE as SQL

SMALL = "/root/testdata/sf0.001"
STREAMED = {name for name in QUERIES if name.startswith(("s1", "s2", "s3", "s4", "s5", "r2", "r5", "j1", "w1", "w6", "n11_l"))}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    answer = db.execute(SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED))
def test_plan_stays_in_the_engine_and_pairs_by_key(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for node in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
    # Every window is partitioned, so none pulls the table into one task.
    assert "windowspecdefinition(1" not in plan


def test_entry_runs(spark):
    df = registered.entry(spark)
    assert df.count() == 18 and "privileged_group_gained" in df.columns


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["d12_excessive_data"](spark, SMALL))
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_top_k_is_not_a_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["d04_risk_scores"](spark, SMALL))


def test_missing_logins_are_an_anti_join(spark):
    assert "LeftAnti" in plan_of(QUERIES["d02c_no_login"](spark, SMALL))


@pytest.mark.parametrize("name", ["d02_impossible_login", "d06_mfa_bypass_all_apps"])
def test_events_do_not_pass_the_driver(spark, name):
    """Sides of joins that grow with the events are not broadcast, however small their files look."""
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_windows_are_split_by_time(spark):
    for name in ("d03_mfa_bypass", "d07_impossible_travel", "d11_high_risk_sequence", "n9_session_attribution"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert any("Exchange hashpartitioning(user" in line and "_chunk" in line for line in plan.splitlines())


@pytest.mark.parametrize("name,most", [
    ("d03_mfa_bypass", 4), ("d07_impossible_travel", 1), ("d11_high_risk_sequence", 6), ("d16_mfa_drift", 6),
    ("n9_session_attribution", 7), ("q6_late_directory_event", 7),
])
def test_shuffles_of_time_joins(spark, name, most):
    """Without broadcasts, as on large inputs: all targets of a search share one pass."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = plan_of(QUERIES[name](spark, SMALL))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum("Exchange hashpartitioning" in line and "ReusedExchange" not in line for line in plan.splitlines()) <= most


@pytest.fixture(scope="module")
def busy(spark, tmp_path_factory):
    """The smallest tables with a third of all events moved to one user."""
    folder = str(tmp_path_factory.mktemp("busy"))
    user = F.when(F.hash("event_id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("user_id"))
    spark.read.parquet(f"{SMALL}/events.parquet").withColumn("user_id", user).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    return folder, con


@pytest.mark.parametrize("name", [
    "d01_shadow_access", "d02_impossible_login", "d03_mfa_bypass", "d04_risk_scores", "d07_impossible_travel",
    "d11_high_risk_sequence", "d16_mfa_drift", "d20_orphan_users", "d21_cleanest_users", "d22_time_warp",
    "q6_late_directory_event", "v6_usage_before_login", "v7_long_session_count", "v8_lifecycle_violations",
    "n9_session_attribution", "s3_streaming_bypass", "s5_sessions",
])
def test_matches_sql_with_a_busy_user(spark, busy, name):
    folder, con = busy
    df = QUERIES[name](spark, folder)
    answer = con.execute(SQL[name])
    columns = [d[0] for d in answer.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, answer.fetchall())
