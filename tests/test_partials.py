"""Tables merged from partials per day against the same tables from all events."""

from functools import partial

import pytest
from pyspark.sql import functions as F
from support import at, rows

from idwarden.constants import TABLES
from idwarden.plans import job
from idwarden.plans.partials import FROM_PARTIALS, NO_DAY, Store
from idwarden.plans.registry import DETECTORS
from idwarden.plans.sinks import read_table, write_source
from idwarden.sources import load_sources
from idwarden.sources.events_view import read_events, sources_from_events

SMALL = "/root/testdata/sf0.001"
EVENTS = ("okta", "saviynt", "ad", "app_usage")


@pytest.fixture(scope="module")
def src(spark):
    """Sources of six days."""
    return sources_from_events(read_events(spark, SMALL).where(F.dayofmonth("ts").isin(1, 2, 5, 6, 19, 20)))


@pytest.fixture
def folder(src, tmp_path):
    """Day folders of all sources, and some events without a time."""
    for key in (*EVENTS, "hrlifecycle"):
        write_source(src.get(key), str(tmp_path), key, batch="a")
    untimed = F.lit(None).cast("timestamp_ntz")
    write_source(src.app.limit(5).withColumns({"ts": untimed, "usage_id": F.concat(F.lit("x"), "usage_id")}), str(tmp_path), "app_usage", batch="untimed")
    return str(tmp_path)


def same(spark, store, folder):
    for source in EVENTS:
        store.refresh(source)
    whole = load_sources(spark, folder)
    for key in FROM_PARTIALS:
        assert rows(store.table(key, whole.hr)) == rows(DETECTORS[key].fn(whole)), key


def test_only_changed_days_are_made_anew(spark, src, folder):
    store = Store(spark, folder, f"{folder}/partials")
    days = {source: store.refresh(source) for source in EVENTS}
    assert NO_DAY in days["app_usage"] and NO_DAY not in days["ad"] and len(days["ad"]) == 6
    assert all(store.refresh(source) == [] for source in EVENTS)
    same(spark, store, folder)
    # A late event and a new day: two days are read.
    late = spark.createDataFrame([("late", at(0), "user1", "DBA", "privilege_escalation", "user1", None, None)], src.directory.schema)
    some_day = F.to_timestamp_ntz(F.lit(days["ad"][2] + " 10:00:00"))
    write_source(late.unionByName(late.withColumns({"event_id": F.lit("late2"), "ts": some_day})), folder, "ad", batch="b")
    assert store.refresh("ad") == [days["ad"][2], "2025-10-06"]
    same(spark, store, folder)


def test_raw_events_of_other_days_are_not_read(spark, src, folder):
    store = Store(spark, folder, f"{folder}/partials")
    plan = store._rows("ad", ["2024-01-05"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [(event_date" in plan or "event_date#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_a_day_whose_files_are_gone_counts_no_more(spark, src, tmp_path):
    for key in (*EVENTS, "hrlifecycle"):
        write_source(src.get(key), str(tmp_path), key, batch="a")
    store = Store(spark, str(tmp_path), f"{tmp_path}/partials")
    same(spark, store, str(tmp_path))
    # The day is written again without its only batch: an empty replacement.
    gone = rows(src.directory.select(F.to_date("ts").cast("string")).distinct())[0][0]
    for file in (tmp_path / "source" / "ad" / f"event_date={gone}").rglob("*.parquet"):
        file.unlink()
    assert store.refresh("ad") == []
    same(spark, store, str(tmp_path))


def test_a_failed_refresh_leaves_the_last_one(spark, src, folder, monkeypatch):
    store = Store(spark, folder, f"{folder}/partials")
    same(spark, store, folder)
    before = rows(store.table("ad_churn_table", None))
    write_source(src.directory, folder, "ad", batch="again")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", fails)  # the manifest is not written
        with pytest.raises(RuntimeError, match="lost"):
            store.refresh("ad")
    assert rows(store.table("ad_churn_table", None)) == before
    same(spark, store, folder)


def test_copies_of_an_event_count_once_if_asked(spark, src, folder):
    write_source(src.requests, folder, "saviynt", batch="again")
    once, twice = (Store(spark, folder, f"{folder}/{unique}", unique) for unique in (True, False))
    for store in (once, twice):
        store.refresh("saviynt")
    assert rows(once.table("role_drift_table", None)) == rows(DETECTORS["role_drift_table"].fn(src))
    assert once.read("roles").agg(F.sum("n")).first()[0] * 2 == twice.read("roles").agg(F.sum("n")).first()[0]


def test_sources_without_files_are_empty(spark, tmp_path):
    store = Store(spark, str(tmp_path), f"{tmp_path}/partials")
    with pytest.raises(ValueError, match="refresh"):
        store.read("roles")
    same(spark, store, str(tmp_path))


def test_the_job_merges_tables_without_days(spark, folder):
    args = ["--root", folder, "--source", "okta", "--run_id", "r", "--partials", f"{folder}/partials"]
    assert job.main(args, spark) == 0
    whole = load_sources(spark, folder)
    for key in ("role_drift_table", "mfa_table"):
        assert rows(read_table(spark, f"{folder}/gold", TABLES[key]).drop("run_id")) == rows(DETECTORS[key].fn(whole))


def test_ranges_of_days_add_up_with_events_without_a_time(spark, folder):
    """The range without a first day holds what has no time."""
    from idwarden.plans.registry import of_days

    load = partial(load_sources, spark, folder)
    whole = rows(of_days("orphan_event_table", None, None, load))
    parts = rows(of_days("orphan_event_table", None, "2024-01-05", load)) + rows(of_days("orphan_event_table", "2024-01-06", None, load))
    assert sorted(parts, key=repr) == whole and any(r[3] is None for r in whole)
