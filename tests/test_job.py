"""The batch job from files to tables."""

import json

from datetime import datetime
from pathlib import Path

import pytest
from support import at, rows

from idwarden.constants import SOURCE_KEYS, TABLES
from idwarden.operators.access import shadow_access
from idwarden.plans import job
from idwarden.plans.ledger import Ledger, Run, listed
from idwarden.plans.registry import DETECTORS
from idwarden.plans.sinks import read_table, write_source
from idwarden.sources.events_view import read_events, sources_from_events

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    src = sources_from_events(read_events(spark, SMALL))
    for key in SOURCE_KEYS:
        write_source(src.get(key), folder, key)
    return folder


def test_every_table_has_a_detector():
    assert set(DETECTORS) == set(TABLES) and len(TABLES) == 22


def test_run_fills_the_tables(spark, root):
    argv = ["--root", root, "--source", "ad", "--run_id", "first", "--shadow_table", "shadow"]
    assert job.main(argv, spark) == 0
    assert job.main(argv, spark) == 0
    gold = f"{root}/gold"
    want = rows(shadow_access(sources_from_events(read_events(spark, SMALL))))
    assert rows(read_table(spark, gold, "shadow").drop("run_id")) == want
    assert read_table(spark, gold, TABLES["timeline_table"]).count() == 1000
    filled = {p.name for p in (Path(gold)).iterdir()}
    assert filled <= {"shadow" if key == "shadow_table" else name for key, name in TABLES.items()} and len(filled) >= 18
    assert all((Path(gold) / name / "run_id=first").exists() for name in filled)


def test_only_affected_tables(spark, root, tmp_path):
    argv = ["--root", root, "--source", "hrlifecycle", "--sink_path", str(tmp_path), "--only_affected"]
    assert job.main(argv, spark) == 0
    assert [p.name for p in tmp_path.iterdir()] == [TABLES["orphan_user_table"]]


def test_checks_are_written_on_request(spark, root, tmp_path):
    argv = ["--root", root, "--source", "anomaly_key", "--sink_path", str(tmp_path), "--only_affected", "--checks"]
    assert job.main(argv, spark) == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == ["quality_anomalies_per_code", "quality_label_scores"]
    assert read_table(spark, str(tmp_path), "quality_label_scores").count() == 6
    assert set(job.chosen("okta")) == set(TABLES)


def test_one_failing_table_does_not_stop_the_rest(spark, root, tmp_path, monkeypatch):
    def fail(src):
        raise RuntimeError("broken")

    monkeypatch.setitem(DETECTORS, "risk_table", job.DETECTORS["risk_table"].__class__(fail, ("okta",)))
    src = sources_from_events(read_events(spark, SMALL))
    outcomes = job.run(src, job.Sink(str(tmp_path)), run_id="r", keys=["risk_table", "role_drift_table"])
    assert [(o.table, o.error) for o in outcomes] == [("risk_scores", "broken"), ("role_drift", None)]
    assert outcomes[1].rows == 59


def test_settings_from_config(tmp_path):
    path = tmp_path / "dev.json"
    path.write_text(json.dumps({"gcs_bucket": "lake", "tables": {"risk_table": "a", "mfa_table": "b"}}))
    args = job.settings(["--config", str(path), "--source", "okta", "--risk_table", "c"])
    assert args.root == "gs://lake" and args.tables == {"risk_table": "c", "mfa_table": "b"}
    assert args.sink.path == "gs://lake/gold" and args.run_id


def test_warehouse_settings():
    args = job.settings(["--gcs_bucket", "b", "--source", "ad", "--bq_project", "p", "--bq_dataset", "d",
                         "--write_method", "indirect", "--temp_gcs_bucket", "tmp"])
    assert args.sink.fmt == "bigquery" and args.sink.options["table"] == "p:d.{table}"
    assert args.sink.options["temporaryGcsBucket"] == "tmp" and args.run_id


def test_settings_of_an_environment(tmp_path):
    (tmp_path / "prod.json").write_text(json.dumps({"env": "prod", "root": "/lake", "bq_project": "p", "bq_dataset": "d", "write_method": "indirect"}))
    (tmp_path / "all.json").write_text(json.dumps({"dev": {"root": "/a"}, "prod": {"root": "/b"}}))
    args = job.settings(["--env", "prod", "--config", f"{tmp_path}/{{env}}.json", "--source", "ad"])
    assert args.root == "/lake" and args.sink.options["writeMethod"] == "indirect"
    assert job.settings(["--env", "prod", "--config", f"{tmp_path}/all.json", "--source", "ad"]).root == "/b"
    with pytest.raises(ValueError):
        job.settings(["--env", "dev", "--config", f"{tmp_path}/prod.json", "--source", "ad"])


def test_ledger_reads_new_files_once(spark, tmp_path):
    src = sources_from_events(read_events(spark, SMALL))
    folder = str(tmp_path)
    for key in SOURCE_KEYS:
        write_source(src.get(key), folder, key)
    argv = ["--root", folder, "--source", "hrlifecycle", "--only_affected", "--ledger", f"{folder}/ledger", "--run_id", "a"]
    assert job.main(argv, spark) == 0
    ledger = Ledger(spark, f"{folder}/ledger")
    assert ledger.unseen(listed(spark, f"{folder}/source/hrlifecycle")).count() == 0 and ledger.unfinished() == []
    before = rows(read_table(spark, f"{folder}/gold", TABLES["orphan_user_table"]))
    assert job.main(argv, spark) == 0  # nothing new: nothing is done
    assert rows(read_table(spark, f"{folder}/gold", TABLES["orphan_user_table"])) == before
    write_source(src.hr, folder, "hrlifecycle")
    assert ledger.unseen(listed(spark, f"{folder}/source/hrlifecycle")).count() >= 1


def test_ledger_knows_the_file_it_was_given(spark, tmp_path):
    """By the path under which Spark lists it, however it was named."""
    src = sources_from_events(read_events(spark, SMALL))
    folder = str(tmp_path)
    write_source(src.hr, folder, "hrlifecycle")
    file = next((tmp_path / "source" / "hrlifecycle").rglob("*.parquet"))
    argv = ["--root", folder, "--source", "hrlifecycle", "--only_affected", "--ledger", f"{folder}/ledger", "--input_file"]
    assert job.main([*argv, str(file.relative_to(tmp_path))], spark) == 0
    ledger = Ledger(spark, f"{folder}/ledger")
    assert rows(ledger.rows(), "state") == [("done",), ("taken",)]
    everything = listed(spark, f"{folder}/source/hrlifecycle")
    assert ledger.unseen(everything).count() == everything.count() - 1
    assert job.runs_to_do(spark, job.settings([*argv, str(file)])) == []


def test_ledger_of_changed_and_failed_files(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))

    def files(*listed_files):
        return spark.createDataFrame([(p, n, datetime(2025, 1, day)) for p, n, day in listed_files], "path string, length long, modificationTime timestamp")

    first = ledger.take(files(("a", 1, 1), ("b", 2, 1)), "r1")
    assert first == Run("r1", ["a", "b"]) and ledger.unfinished() == [first]
    assert ledger.take(files(("a", 1, 1), ("b", 2, 1))) is None  # taken, if not done
    ledger.finish(first)
    assert ledger.unfinished() == []
    # One file is longer, one was written again, one is new; the name of the run is taken.
    second = ledger.take(files(("a", 1, 1), ("a", 9, 1), ("b", 2, 2), ("c", 1, 1)), "r1")
    assert second.files == ["a", "b", "c"] and second.run_id.startswith("r1-")
    assert ledger.unfinished() == [second]


def test_ledger_of_paths_alone(spark, tmp_path):
    spark.createDataFrame([("a",)], "path string").write.parquet(str(tmp_path / "ledger"))
    files = spark.createDataFrame([("a", 1, datetime(2025, 1, 1)), ("b", 1, datetime(2025, 1, 1))], "path string, length long, modificationTime timestamp")
    assert Ledger(spark, str(tmp_path / "ledger")).take(files, "r").files == ["b"]


def test_a_run_that_failed_is_repeated_first(spark, tmp_path, monkeypatch):
    src = sources_from_events(read_events(spark, SMALL))
    folder = str(tmp_path)
    write_source(src.hr, folder, "hrlifecycle")
    argv = ["--root", folder, "--source", "hrlifecycle", "--only_affected", "--ledger", f"{folder}/ledger", "--run_id"]

    def fails(src):
        raise RuntimeError("broken")

    with monkeypatch.context() as m:
        m.setitem(DETECTORS, "orphan_user_table", job.DETECTORS["orphan_user_table"].__class__(fails, ("hrlifecycle",)))
        assert job.main([*argv, "one"], spark) == 1
    assert [r.run_id for r in Ledger(spark, f"{folder}/ledger").unfinished()] == ["one"]
    assert job.main([*argv, "two"], spark) == 0
    assert Ledger(spark, f"{folder}/ledger").unfinished() == []


def test_a_rerun_without_rows_takes_the_run_away(spark, tmp_path):
    from idwarden.plans.sinks import write_table

    df = spark.range(3)
    assert write_table(df, "t", path=str(tmp_path), run_id="r") == 3
    assert write_table(df.where("id > 5"), "t", path=str(tmp_path), run_id="r") == 0
    assert not (tmp_path / "t").exists()


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    from idwarden.plans.sinks import write_table

    write_table(spark.range(3), "t", path=str(tmp_path), run_id="r")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|divi"):
        write_table(spark.range(5).selectExpr("1 DIV (id - 4) AS id"), "t", path=str(tmp_path), run_id="r")
    assert read_table(spark, str(tmp_path), "t").count() == 3
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["run_id=r"]


def test_a_table_is_one_write(spark, tmp_path):
    """Without a test for emptiness before it: the rows are computed once."""
    from idwarden.plans.sinks import write_table

    seen = spark.sparkContext.accumulator(0)
    once = spark.createDataFrame([(i,) for i in range(10)], "a long").rdd.map(lambda r: (seen.add(1), r)[1]).toDF("a long")
    assert write_table(once, "t", path=str(tmp_path), run_id="r") == 10
    assert seen.value == 10


def test_bad_settings():
    with pytest.raises(ValueError):
        job.settings(["--source", "okta"])
    with pytest.raises(SystemExit):
        job.settings(["--root", "x", "--source", "payroll"])
    with pytest.raises(ValueError):
        job.run(None, job.Sink("x"), tables={"no_table": "x"})


def test_tables_share_one_load(make, tmp_path):
    """The files of the sources are listed, and their footers read, once for each range of days; a load that failed is tried again."""
    src, asked = make(okta=[dict(req_id="l1", user="u", ts=at(0), status="FAILED")]), []

    def load(days=None):
        asked.append(days)
        if len(asked) == 1:
            raise OSError("not there yet")
        return src

    keys = ["risk_table", "role_drift_table", "ad_churn_table", "mfa_drift_table"]
    outcomes = job.run(load, job.Sink(str(tmp_path)), run_id="r", keys=keys)
    assert asked == [None, None] and sum(o.error is not None for o in outcomes) == 1
    asked.append("a load")
    job.run(load, job.Sink(str(tmp_path)), run_id="s", keys=["mfa_table", "risk_table", "mfa_all_table"], first_day="2025-10-06", last_day="2025-10-06")
    assert len(asked) == 3 + 2
