"""Rows that come after the watermark of a stream join."""

from pyspark.sql import functions as F
from support import at, rows

from idwarden.streaming import jobs, late


def test_late_days(spark):
    df = spark.createDataFrame([(at(0),), (at(86400),), (None,), (at(3 * 86400),)], "ts timestamp_ntz")
    assert late.late_days(df, at(2 * 86400)) == ["2025-10-06", "2025-10-07"]
    assert late.late_days(df, at(2 * 86400), back_sec=13 * 3600) == ["2025-10-05", "2025-10-06", "2025-10-07"]
    assert late.late_days(df, None) == [] and late.late_days(df, at(0)) == []


def test_repair_adds_what_lacks(spark, tmp_path):
    whole = spark.createDataFrame([("a", at(0)), ("a", at(0)), ("b", at(0)), ("c", at(86400))], "user string, mfa_failure_time timestamp_ntz")
    found, path = whole.where("user = 'a'").limit(1), f"{tmp_path}/repaired"
    for _ in range(2):  # the second is a try again
        late.repair(found, whole, "mfa_failure_time", ["2025-10-06"], path, "first")
        assert rows(late.repairs(whole, path), "user") == [("a",), ("b",)]
    late.repair(found, whole, "mfa_failure_time", ["2025-10-06", "2025-10-07"], path, "second")
    assert rows(late.repairs(whole, path), "user") == [("a",), ("b",), ("c",)]
    late.repair(found, whole, "mfa_failure_time", [], path, "third")
    assert late.repairs(whole, path).count() == 3


def test_watermark_of_a_run(spark, tmp_path):
    def run(*times):
        for name, kind, sec in times:
            spark.createDataFrame([(name, at(sec), kind)], "user string, ts timestamp_ntz, status string").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("user string, ts timestamp_ntz, status string").parquet(f"{tmp_path}/in")
        use = stream.select("user", "ts", F.lit("Jira").alias("app"), F.lit("s").alias("session_id"), F.lit(1).cast("long").alias("duration"))
        query = jobs.append_stream(jobs.bypass_stream(stream, use, delay="1 hour"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", state_partitions=2)
        query.awaitTermination()
        return late.watermark(query)

    assert run(("u", "FAILED", 86400)) == at(86400 - 3600)
    assert run() in (None, at(86400 - 3600))
