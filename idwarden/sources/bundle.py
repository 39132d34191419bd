"""The set of sources a detector works on."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.constants import SOURCE_KEYS
from idwarden.functions.checks import one_of
from idwarden.schemas import EVENT_ID
from idwarden.sources.normalise import drop_repeats
from idwarden.sources.readers import empty_source, read_parquet

_SLOTS = {
    "okta": "logins",
    "saviynt": "requests",
    "ad": "directory",
    "app_usage": "app",
    "hrlifecycle": "hr",
    "anomaly_key": "labels",
}


@dataclass(frozen=True)
class Sources:
    logins: DataFrame
    requests: DataFrame
    directory: DataFrame
    app: DataFrame
    hr: DataFrame
    labels: DataFrame

    def with_source(self, source: str, df: DataFrame) -> "Sources":
        one_of("source", source, SOURCE_KEYS)
        return replace(self, **{_SLOTS[source]: df})

    def get(self, source: str) -> DataFrame:
        one_of("source", source, SOURCE_KEYS)
        return getattr(self, _SLOTS[source])

    @classmethod
    def of(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> "Sources":
        """Sources from normalised frames by key; keys not given are empty."""
        for key in frames:
            one_of("source", key, SOURCE_KEYS)
        return cls(**{_SLOTS[k]: frames[k] if k in frames else empty_source(spark, k) for k in SOURCE_KEYS})

    def events(self) -> DataFrame:
        """All events of the four event sources as (source, event_id, user, ts)."""
        parts = [
            self.logins.select(F.lit("login").alias("source"), F.col("req_id").alias("event_id"), "user", "ts"),
            self.requests.select(F.lit("request").alias("source"), F.col("req_id").alias("event_id"), "user", "ts"),
            self.directory.select(F.lit("directory").alias("source"), "event_id", "user", "ts"),
            self.app.select(F.lit("app").alias("source"), F.col("usage_id").alias("event_id"), "user", "ts"),
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def load_sources(
    spark: SparkSession, root: str, source: str | None = None, input_file: str | list[str] | None = None,
    *, days: dict[str, tuple[str | None, str | None]] | None = None, merge_schema: bool = True, unique: bool = False,
) -> Sources:
    """Read ``<root>/source/<key>`` for every key.

    With ``source`` and ``input_file`` that file, or those (relative to ``root``, or with a scheme), stand in for the folder of
    ``source``; the other sources keep their whole history, or of ``days`` the first and last day given for them.
    ``unique`` keeps one row for each event id.
    """
    for key in [*(days or {}), *([source] if source is not None else [])]:
        one_of("source", key, SOURCE_KEYS)
    frames = {}
    for key in SOURCE_KEYS:
        first, last = (days or {}).get(key, (None, None))
        where = f"{root}/source/{key}"
        if key == source and input_file:
            files = [input_file] if isinstance(input_file, str) else input_file
            where = [f if ":" in f or f.startswith("/") else f"{root}/{f}" for f in files]
        frame = read_parquet(spark, key, where, first_day=first, last_day=last, merge_schema=merge_schema)
        frames[key] = drop_repeats(frame, key) if unique and key in EVENT_ID else frame
    return Sources.of(spark, frames)
