"""Merges of day folders, also ones that break off."""

import pytest
from pyspark.sql import functions as F
from support import rows

from idwarden.plans.sinks import Files, write_days
from idwarden.sources.merged import read_days
from idwarden.sources.readers import list_files, read_parquet
from idwarden.streaming import compaction, jobs


def fill(spark, path, batches, per_batch=10):
    """Rows of four days and of none, of a stream's batches."""
    n = spark.range(batches * per_batch)
    ts = F.when(F.col("id") % 5 < 4, F.to_timestamp_ntz(F.lit("2025-10-06 12:00:00")) + F.make_dt_interval(days=(F.col("id") % 5).cast("int")))
    n = n.select(F.concat(F.lit("e"), "id").alias("event_id"), ts.alias("ts"), F.to_date(ts).alias("event_date"),
                 F.format_string("0123abcd-%06d", F.floor(F.col("id") / per_batch)).alias("batch"))
    n.repartition(1).write.mode("append").partitionBy("event_date", "batch").parquet(path)
    return batches * per_batch


def ids(df):
    found = sorted(int(r.event_id[1:]) for r in df.select("event_id").collect())
    return len(found), len(set(found))


def files_a_day(spark, path):
    day = F.regexp_extract("path", "event_date=([^/]+)", 1)
    return {r.day: r.n for r in list_files(spark, path).groupBy(day.alias("day")).agg(F.count("*").alias("n")).collect()}


def test_two_hundred_batches(spark, tmp_path):
    path = f"{tmp_path}/ad"
    n = fill(spark, path, 200)
    assert compaction.merge_days(spark, path) == 199 * 5
    assert files_a_day(spark, path) == {d: 2 for d in ("2025-10-06", "2025-10-07", "2025-10-08", "2025-10-09", "__HIVE_DEFAULT_PARTITION__")}
    assert ids(read_days(spark, path)) == ids(spark.read.parquet(path)) == ids(read_parquet(spark, "ad", path)) == (n, n)
    days = read_days(spark, path).where("ts IS NOT NULL AND event_date <> to_date(ts) OR ts IS NULL AND event_date IS NOT NULL")
    assert days.isEmpty()
    assert compaction.merge_days(spark, path) == 0


@pytest.mark.parametrize("done", [0, 1, 3])
def test_merge_that_breaks_off(spark, tmp_path, monkeypatch, done):
    path = f"{tmp_path}/ad"
    n = fill(spark, path, 12)
    left, move = [done], Files.move

    def breaks(self, source, target):
        if "/new/" in source or done == 0:
            if left[0] == 0:
                raise OSError("lost")
            left[0] -= 1
        move(self, source, target)

    monkeypatch.setattr(Files, "move", breaks)
    with pytest.raises(OSError, match="lost"):
        compaction.merge_days(spark, path)
    monkeypatch.undo()
    assert ids(read_days(spark, path)) == (n, n)
    assert ids(read_parquet(spark, "ad", path)) == (n, n)
    compaction.finish_merges(spark, path)
    assert ids(read_days(spark, path)) == ids(spark.read.parquet(path)) == (n, n)
    assert not [name for name in Files(spark, path).names(path) if name.startswith("_merging-")]


def test_merge_while_read(spark, tmp_path, monkeypatch):
    """A merge between a reader's look at the lists and its look at the files."""
    path = f"{tmp_path}/ad"
    n = fill(spark, path, 12)
    from idwarden.sources import merged

    plain, once = merged._rows, []

    def late(*args):
        if not once:
            once.append(compaction.merge_days(spark, path))
        return plain(*args)

    monkeypatch.setattr(merged, "_rows", late)
    assert ids(merged.read_days(spark, path)) == (n, n) and once == [55]


def test_full_folders_stay(spark, tmp_path):
    path = f"{tmp_path}/ad"
    fill(spark, path, 12)
    assert compaction.merge_days(spark, path, full_bytes=1) == 0


def test_counts_are_added_up(spark, tmp_path):
    path = f"{tmp_path}/counts"
    for number in range(4):
        day = spark.createDataFrame([("u", 2), ("v", 3)], "user string, n long").withColumn("ts", F.to_timestamp_ntz(F.lit("2025-10-06 00:00:00")))
        write_days(day, path, batch=f"0123abcd-{number:06d}")
    assert jobs.merge_day_counts(spark, path, least_folders=2) == 3
    assert spark.read.parquet(path).count() == 4
    assert rows(jobs.read_day_counts(spark, path), "user", "n") == [("u", 8), ("v", 12)]


def test_events_of_merged_batches_are_known(spark, tmp_path):
    source, path = f"{tmp_path}/in", f"{tmp_path}/out"

    def ingest(*names):
        for name in names:
            event = spark.createDataFrame([(name, "2025-10-06 12:00:00")], "event_id string, ts string")
            event.coalesce(1).write.mode("append").parquet(source)
        stream = jobs.source_stream(spark, "ad", source, fmt="parquet", files_per_trigger=1)
        jobs.ingest(stream, path, f"{tmp_path}/checkpoint", event_id="event_id").awaitTermination()

    ingest("a", "b", "c")
    assert compaction.merge_days(spark, path, least_folders=2) == 2
    ingest("a", "d")
    assert rows(read_parquet(spark, "ad", path), "event_id") == [("a",), ("b",), ("c",), ("d",)]
