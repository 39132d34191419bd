"""Tables without days, from partial results per day.

A table such as the role history needs the whole past, but what a day adds to it is a small aggregate that can be merged: counts add
up, times have a minimum or maximum, and distinct values are keys of their own. ``refresh`` keeps such partials for each day folder of a
source: a day whose files changed is read again and its partials are replaced, all other days are left alone. ``Store.table`` merges
the partials of all days, so a daily run reads one day of raw events and not the history.

Files of a store: ``<partial>/version=<id>/day=<day>/``, never changed once written, and ``_manifest/<source>/number=<n>/`` with one row per
day: the version that holds its partials and a fingerprint of the files it was made from. A refresh writes its partials first and the
manifest last, as one file, so a refresh that fails leaves all as it was, and readers see the days of one manifest only. One refresh
of a source runs at a time. Versions that no manifest in use names may be deleted.

Events without a time form a day of their own, and so do files outside of day folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idwarden.functions.checks import one_of
from idwarden.operators import access, activity, integrity, profile
from idwarden.operators.keyed import without_match
from idwarden.schemas import EVENT_ID
from idwarden.sources import drop_repeats, read_parquet
from idwarden.sources.readers import empty_source, list_files

#: The day of events without a time, and of files that are in no day folder.
NO_DAY = "none"


@dataclass(frozen=True)
class Partial:
    """``of(rows, "day")`` gives a day's rows; rows of several days with the same ``keys`` are merged by ``sum``, ``min`` or ``max``."""

    source: str
    of: Callable[..., DataFrame]
    keys: tuple[str, ...] = ()
    merge: dict[str, str] = field(default_factory=dict)

    def merged(self, rows: DataFrame) -> DataFrame:
        # An aggregate by no key gives a row for no rows too.
        return rows.groupBy(*self.keys).agg(*(getattr(F, how)(c).alias(c) for c, how in self.merge.items()))


def _summed(marks: Callable[..., DataFrame], *keys: str) -> Callable[..., DataFrame]:
    """The sums of ``marks`` by ``keys``."""
    def of(rows: DataFrame, by: str) -> DataFrame:
        marked = marks(rows, by)
        return marked.groupBy(by, *keys).agg(*(F.sum(c).alias(c) for c in marked.columns if c not in (*keys, by)))

    return of


def _numbered(*keys: str) -> Callable[..., DataFrame]:
    return lambda rows, by: rows.groupBy(by, *keys).agg(F.count("*").alias("n"))


def _latest(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.max("ts").alias("latest"))


def _activity(rows: DataFrame, by: str) -> DataFrame:
    # The day of a partial is a text; the lifecycle rule has its own.
    return integrity.daily_activity(rows.where(F.col("user").isNotNull()).withColumnRenamed(by, "_part"), "_part").select(
        F.col("_part").alias(by), F.col("day").alias("on_day"), "user", "n", "first_ts", "last_ts", "n_past_midnight", "first_past_midnight")


_ACTIVITY = dict(
    of=_activity, keys=("user", "on_day"),
    merge={"n": "sum", "first_ts": "min", "last_ts": "max", "n_past_midnight": "sum", "first_past_midnight": "min"},
)
_EVENTS = {"okta": "login", "saviynt": "request", "ad": "directory", "app_usage": "app"}

PARTIALS: dict[str, Partial] = {
    "roles": Partial("saviynt", access.role_counts, ("user", "role"), {"first_seen": "min", "last_seen": "max", "n": "sum"}),
    "grants": Partial("saviynt", access.last_grants, ("user", "app"), {"granted_ts": "max"}),
    "decisions": Partial("saviynt", access.decision_counts, ("approver", "user"), {"decisions": "sum", "approvals": "sum"}),
    "requests": Partial("saviynt", _numbered("user", "req_id"), ("user", "req_id"), {"n": "sum"}),
    "uses": Partial("app_usage", access.last_uses, ("user", "app"), {"last_used": "max"}),
    "links": Partial("app_usage", _numbered("user", "request_id"), ("user", "request_id"), {"n": "sum"}),
    "changes": Partial("ad", activity.change_counts, ("group", "week", "user"), {"adds": "sum", "removes": "sum", "escalations": "sum"}),
    "directory_marks": Partial("ad", _summed(profile.directory_marks, "user"), ("user",), {"privilege_escalations": "sum", "ad_actions": "sum"}),
    "login_marks": Partial(
        "okta", _summed(profile.login_marks, "user", "country"), ("user", "country"), {"failed_mfa": "sum", "success_mfa": "sum", "total_logins": "sum"}),
    **{f"{name}_activity": Partial(source, **_ACTIVITY) for source, name in _EVENTS.items()},
    **{f"{name}_latest": Partial(source, _latest, (), {"latest": "max"}) for source, name in _EVENTS.items()},
}


def _day_of(path) -> F.Column:
    """The day folder that a path lies in."""
    day = F.regexp_extract(path, "/event_date=([^/]+)/", 1)
    return F.when(day.isin("", "__HIVE_DEFAULT_PARTITION__"), F.lit(NO_DAY)).otherwise(day)


@dataclass(frozen=True)
class Store:
    """Partials of the sources below ``root``, kept in ``path``."""

    spark: SparkSession
    root: str
    path: str
    unique: bool = False

    def _manifest(self, source: str) -> DataFrame | None:
        """day, fingerprint and version of the last refresh, and its number."""
        try:
            all_numbers = self.spark.read.schema("day string, fingerprint long, version string, number long").parquet(f"{self.path}/_manifest/{source}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return all_numbers.where(F.col("number") == all_numbers.agg(F.max("number").alias("n")).scalar())

    def _days(self, source: str) -> DataFrame:
        """Each day folder with a fingerprint of its files: names, lengths and times of change."""
        try:
            files = list_files(self.spark, f"{self.root}/source/{source}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "day string, fingerprint long")
        one = F.xxhash64("path", "length", "modificationTime")
        return files.groupBy(_day_of(F.col("path")).alias("day")).agg(F.bit_xor(one).bitwiseXOR(F.count("*")).alias("fingerprint"))

    def refresh(self, source: str) -> list[str]:
        """Bring the partials of a source up to date; the days that were read for it. Days without files are dropped."""
        one_of("source", source, EVENT_ID)
        known = self._manifest(source)
        # One row for each day: days are few.
        now = {r["day"]: r["fingerprint"] for r in self._days(source).collect()}
        before = {r["day"]: r for r in known.collect()} if known is not None else {}
        changed = sorted(day for day, mark in now.items() if day not in before or before[day]["fingerprint"] != mark)
        if known is not None and not changed and len(now) == len(before):
            return []
        version = f"v{uuid.uuid4().hex}"
        if changed:
            rows = self._rows(source, changed)

            def write(name: str) -> None:
                parts = PARTIALS[name].of(rows, "day").hint("rebalance", "day")
                parts.write.partitionBy("day").parquet(f"{self.path}/{name}/version={version}")

            # Small jobs, each over its own columns: side by side.
            with ThreadPoolExecutor(4) as pool:
                list(pool.map(write, [name for name, partial in PARTIALS.items() if partial.source == source]))
        manifest = [(day, mark, version if day in changed else before[day]["version"]) for day, mark in now.items()]
        number = 1 + max((r["number"] for r in before.values()), default=0)
        self.spark.createDataFrame(manifest, "day string, fingerprint long, version string").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/_manifest/{source}/number={number}")
        return changed

    def _rows(self, source: str, days: list[str]) -> DataFrame:
        """The events of some day folders, with their day. Other folders are not read."""
        folders = [None if day == NO_DAY else day for day in days]
        rows = read_parquet(self.spark, source, f"{self.root}/source/{source}", keep_file=True, day_folders=folders)
        rows = rows.withColumn("day", _day_of(F.col("source_file"))).drop("source_file").where(F.col("day").isin(days))
        # Copies of an event have its time, and so its day.
        return drop_repeats(rows, source) if self.unique else rows

    def read(self, name: str) -> DataFrame:
        """A partial, merged over all days."""
        one_of("partial", name, PARTIALS)
        partial = PARTIALS[name]
        manifest = self._manifest(partial.source)
        if manifest is None:
            raise ValueError(f"no partials of {partial.source} yet: refresh them first")
        try:
            parts = self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return partial.merged(partial.of(empty_source(self.spark, partial.source).withColumn("day", F.lit(NO_DAY)), "day"))
        days = F.broadcast(manifest.select("version", F.col("day").alias("of_day")))  # one row for each day
        current = (parts["version"] == days["version"]) & (parts["day"].cast("string") == days["of_day"])
        return partial.merged(parts.join(days, current, "left_semi"))

    def table(self, key: str, hr: DataFrame, **params) -> DataFrame:
        """A table of ``FROM_PARTIALS``, as its detector computes it from all events."""
        one_of("table key", key, FROM_PARTIALS)
        return FROM_PARTIALS[key][1](self.read, hr, **params)


def _stale(read, hr, **params):
    latest = [read(f"{name}_latest") for name in _EVENTS.values()]
    now = latest[0].unionByName(latest[1]).unionByName(latest[2]).unionByName(latest[3]).agg(F.max("latest").alias("as_of")).scalar()
    return access.idle_grants(read("grants"), read("uses"), now, **params)


def _orphans(read, hr):
    parts = [read(f"{name}_activity") for name in _EVENTS.values()]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return integrity.uncovered_users(together.withColumnRenamed("on_day", "day"), hr)


def _risk(read, hr, **params):
    requests = read("requests")
    usage = without_match(read("links"), requests, {"user": "user", "request_id": "req_id"})
    return profile.scores_of(
        read("login_marks"), requests.select("user", F.col("n").alias("access_requests")), read("directory_marks"),
        usage.select("user", F.col("n").alias("unexplained_app_usage")), **params,
    )


#: Result table -> the sources that have to be refreshed, and how its rows follow from merged partials and HR.
FROM_PARTIALS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "role_drift_table": (("saviynt",), lambda read, hr: access.roles_of(read("roles"))),
    "stale_access_table": (tuple(_EVENTS), _stale),
    "suspicious_approver_table": (("saviynt",), lambda read, hr, **params: access.approvers_of(read("decisions"), **params)),
    "ad_churn_table": (("ad",), lambda read, hr: activity.churn_of(read("changes"))),
    "orphan_user_table": (tuple(_EVENTS), _orphans),
    "risk_table": (tuple(_EVENTS), _risk),
}
