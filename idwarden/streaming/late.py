"""Pairs that a stream join missed, because a row came after the watermark had passed it.

The join counts such rows and drops them. The stored sources still have them: ``repair`` holds the batch result of the days that may be
touched against what is there, and adds what lacks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from idwarden.functions.checks import non_negative
from idwarden.plans.sinks import Files, write_days


def watermark(query: StreamingQuery) -> datetime | None:
    """The event time, as a UTC clock, before which a run that has ended dropped rows; None if it saw none."""
    told = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p.get("eventTime", {})]
    return datetime.fromisoformat(told[-1].replace("Z", "+00:00")).replace(tzinfo=None) if told else None


def late_days(rows: DataFrame, before: datetime | None, *, back_sec: int = 0) -> list[str]:
    """Days of the new rows of a run that are older than its watermark ``before``: all that it dropped are among them.

    A row that can match rows up to ``back_sec`` earlier touches their days too. The result is a list of days, not of rows.
    """
    non_negative(back_sec=back_sec)
    if before is None:
        return []
    old = rows.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    ends = F.sequence(F.to_date(F.col("ts") - F.make_dt_interval(secs=F.lit(back_sec))), F.to_date("ts"))
    return sorted(str(r["day"]) for r in old.select(F.explode(ends).alias("day")).distinct().collect())


def of_days(pairs: DataFrame, ts: str, days: list[str]) -> DataFrame:
    return pairs.where(F.to_date(ts).isin(*(F.lit(d).cast("date") for d in days))) if days else pairs.limit(0)


def repairs(like: DataFrame, path: str, *, but: str | None = None) -> DataFrame:
    """The rows that repairs added so far, in the columns of ``like``; ``but`` leaves out those of one name. There may be none."""
    spark = like.sparkSession
    if not Files(spark, path).exists(path):
        return like.limit(0)
    rows = spark.read.schema(T.StructType([*like.schema.fields, T.StructField("batch", T.StringType())])).parquet(path)
    return (rows if but is None else rows.where(F.col("batch") != but)).select(*like.columns)


def repair(found: DataFrame, whole: DataFrame, ts: str, days: list[str], path: str, name: str) -> None:
    """Write the rows of ``whole`` on ``days`` (by ``ts``) that ``found`` lacks below ``path``, repeated rows by their number.

    ``found`` is what the stream wrote; what repairs of other names added counts too. ``whole`` may be of these days alone; on the other
    days nothing is compared. A repair of the same name that is tried again replaces what it wrote.
    """
    there = found.select(*whole.columns).unionByName(repairs(whole, path, but=name))
    lacking = of_days(whole, ts, days).exceptAll(of_days(there, ts, days))
    write_days(lacking.withColumn("ts", F.col(ts)), path, batch=name)
