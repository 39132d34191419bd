"""Detectors on logins and the app use around them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idwarden.constants import LOGIN_BAND_SEC, LOGIN_GRACE_SEC, MFA_WINDOW_SEC
from idwarden.functions import elapsed, is_failure
from idwarden.functions.checks import non_negative, positive
from idwarden.operators.keyed import shuffled
from idwarden.operators.temporal import asof_scan, band_join, with_previous, without_band_match
from idwarden.sources import Sources

_IMPOSSIBLE = (
    "user", "session_id", "app_accessed", "time_of_login", "time_of_app_access", "time_diff_sec", "app_usage_duration_sec",
)
_BYPASS = (
    "user", "mfa_failure_time", "failure_reason", "app_accessed", "app_access_time", "seconds_after_failure",
    "app_session_id", "app_usage_duration_sec",
)


def _usage(src: Sources) -> DataFrame:
    return src.app.select(
        "user", "session_id", F.col("app").alias("app_accessed"), F.col("ts").alias("time_of_app_access"),
        F.col("duration").alias("app_usage_duration_sec"),
    )


def _outside_grace(df: DataFrame, grace_sec: int) -> DataFrame:
    df = df.withColumn("time_diff_sec", elapsed("time_of_app_access", "time_of_login"))
    return df.where((F.col("time_diff_sec") < 0) | (F.col("time_diff_sec") > grace_sec)).select(*_IMPOSSIBLE)


def session_login_gaps(src: Sources, *, grace_sec: int = LOGIN_GRACE_SEC) -> DataFrame:
    """App use before, or too long after, a login of its own session."""
    non_negative(grace_sec=grace_sec)
    logins = src.logins.select("user", "session_id", F.col("ts").alias("time_of_login"))
    return _outside_grace(logins.join(shuffled(_usage(src)), ["user", "session_id"]), grace_sec)


def sessionless_login_gaps(
    src: Sources, *, grace_sec: int = LOGIN_GRACE_SEC, band_sec: int = LOGIN_BAND_SEC,
) -> DataFrame:
    """App use without a session, against every login of the user within the band."""
    non_negative(grace_sec=grace_sec, band_sec=band_sec)
    usage = _usage(src).where(F.col("session_id").isNull())
    logins = src.logins.select("user", F.col("ts").alias("time_of_login"))
    pairs = band_join(usage, logins, ["user"], "time_of_app_access", "time_of_login", -band_sec, band_sec)
    return _outside_grace(pairs, grace_sec)


def usage_without_login(src: Sources, *, band_sec: int = LOGIN_BAND_SEC) -> DataFrame:
    """App use without a session and with no login of the user within the band."""
    non_negative(band_sec=band_sec)
    usage = _usage(src).where(F.col("session_id").isNull())
    logins = src.logins.select("user", F.col("ts").alias("time_of_login"))
    alone = without_band_match(usage, logins, ["user"], "time_of_app_access", "time_of_login", -band_sec, band_sec)
    return (
        alone.withColumn("time_of_login", F.lit(None).cast("timestamp_ntz"))
        .withColumn("time_diff_sec", F.lit(None).cast("bigint"))
        .select(*_IMPOSSIBLE)
    )


def impossible_login(
    src: Sources, *, grace_sec: int = LOGIN_GRACE_SEC, band_sec: int = LOGIN_BAND_SEC,
) -> DataFrame:
    """App use that no login explains: the three rules above, all rows kept."""
    return (
        session_login_gaps(src, grace_sec=grace_sec)
        .unionByName(sessionless_login_gaps(src, grace_sec=grace_sec, band_sec=band_sec))
        .unionByName(usage_without_login(src, band_sec=band_sec))
    )


def _failures(src: Sources) -> DataFrame:
    return src.logins.where(is_failure("status")).select(
        "req_id", "user", "session_id", F.col("ts").alias("mfa_failure_time"), F.col("status").alias("failure_reason"),
    )


def _accesses(src: Sources) -> DataFrame:
    return src.app.select(
        "user", F.col("session_id").alias("app_session_id"), F.col("app").alias("app_accessed"), "usage_id",
        F.col("ts").alias("app_access_time"), F.col("duration").alias("app_usage_duration_sec"),
    )


def _after_failure(df: DataFrame) -> DataFrame:
    return df.withColumn("seconds_after_failure", elapsed("app_access_time", "mfa_failure_time"))


def same_session_bypass(src: Sources, *, window_sec: int = MFA_WINDOW_SEC, match_user: bool = True) -> DataFrame:
    """Every app access in the session of a failed login within the window."""
    positive(window_sec=window_sec)
    failed = _failures(src).where(F.col("session_id").isNotNull())
    access = _accesses(src).withColumn("session_id", F.col("app_session_id"))
    on = ["session_id"]
    if match_user:
        on.append("user")
    else:
        access = access.drop("user")
    joined = band_join(failed, access, on, "mfa_failure_time", "app_access_time", 1, window_sec)
    return _after_failure(joined).select(*_BYPASS)


def _first_accesses(src: Sources, window_sec: int, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """For each rule, a condition on failures and one on accesses: the first such access after each distinct (user, failure time).

    All rules share one pass. Failures of one moment share their next access; the one with the lowest id stands for them.
    """
    positive(window_sec=window_sec)
    access = _accesses(src).select("user", "app_access_time", "usage_id", "app_accessed", "app_usage_duration_sec", "app_session_id")
    told = F.struct("req_id", "failure_reason")
    nearest = asof_scan(
        _failures(src), access, ["user"], "mfa_failure_time", "app_access_time", "usage_id",
        {f"next_{rule}": accesses for rule, (_, accesses) in rules.items()},
        keep={f"of_{rule}": F.when(failures, told) for rule, (failures, _) in rules.items()},
        forward=True, strict=True, whole_seconds=True, within_sec=window_sec,
    )
    found = F.explode(F.array(*(F.struct(F.col(f"of_{rule}").alias("of"), F.col(f"next_{rule}").alias("next")) for rule in rules)))
    flat = nearest.select("user", "mfa_failure_time", found.alias("f")).where("f.of IS NOT NULL AND f.next IS NOT NULL").select(
        "user", "mfa_failure_time", "f.of.failure_reason", "f.next.app_accessed", "f.next.app_access_time", "f.next.app_usage_duration_sec",
        F.lit(None).cast("string").alias("app_session_id"),
    )
    return _after_failure(flat).select(*_BYPASS)


def _sessionless_failure() -> dict[str, tuple[Column, Column]]:
    return {"failure": (F.col("session_id").isNull(), F.lit(True))}


def _sessionless_access() -> dict[str, tuple[Column, Column]]:
    return {"access": (F.lit(True), F.col("app_session_id").isNull())}


def sessionless_failure_bypass(src: Sources, *, window_sec: int = MFA_WINDOW_SEC) -> DataFrame:
    """First app access of the user after a failed login that has no session."""
    return _first_accesses(src, window_sec, _sessionless_failure())


def sessionless_access_bypass(src: Sources, *, window_sec: int = MFA_WINDOW_SEC) -> DataFrame:
    """First app access without a session after any failed login of the user."""
    return _first_accesses(src, window_sec, _sessionless_access())


def mfa_bypass(
    src: Sources, *, window_sec: int = MFA_WINDOW_SEC, match_user: bool = True, ordered: bool = False,
) -> DataFrame:
    """App access soon after a failed login: the three rules above, all rows kept.

    One access can be found by two rules. ``ordered`` sorts by the seconds after the failure.
    """
    found = same_session_bypass(src, window_sec=window_sec, match_user=match_user).unionByName(
        _first_accesses(src, window_sec, {**_sessionless_failure(), **_sessionless_access()})
    )
    return found.orderBy("seconds_after_failure") if ordered else found


def mfa_bypass_all_apps(src: Sources, *, window_sec: int = MFA_WINDOW_SEC) -> DataFrame:
    """Every app access of the user within the window after a failed login."""
    positive(window_sec=window_sec)
    failed = _failures(src).drop("session_id")
    joined = band_join(failed, _accesses(src), ["user"], "mfa_failure_time", "app_access_time", 1, window_sec)
    return _after_failure(joined).select(*_BYPASS)


def impossible_travel(src: Sources, *, max_gap_sec: int = 3600) -> DataFrame:
    """Successive successful logins from another country and address within the gap."""
    positive(max_gap_sec=max_gap_sec)
    # Copies of a login follow each other and change nothing.
    logins = src.logins.where(F.col("status") == "SUCCESS").select("req_id", "user", "ts", "country", "ip")
    steps = with_previous(logins, ["user"], "ts", "req_id", ["ts", "country", "ip"], within_sec=max_gap_sec)
    return (
        steps.withColumn("gap_sec", elapsed("ts", F.col("prev.ts")))
        .where(
            (F.col("prev.country") != F.col("country")) & (F.col("prev.ip") != F.col("ip"))
            & (F.col("gap_sec") <= max_gap_sec)
        )
        .select(
            "user", F.col("prev.country").alias("prev_country"), "country", F.col("prev.ts").alias("prev_ts"), "ts",
            "gap_sec", F.col("prev.ip").alias("prev_ip"), "ip",
        )
    )


def mfa_drift(src: Sources) -> DataFrame:
    """Logins whose MFA method differs from the user's login before, with the methods used so far."""
    # Copies of a login follow each other and change nothing.
    logins = src.logins.where(F.col("mfa").isNotNull()).select("req_id", "user", "ts", "mfa")
    changed = with_previous(logins, ["user"], "ts", "req_id", ["mfa"]).where(F.col("prev.mfa") != F.col("mfa"))
    # A method counts from its first login on; one entry per method is left of each user's logins.
    firsts = (
        logins.where(F.col("ts").isNotNull())
        .groupBy("user", "mfa")
        .agg(F.min(F.struct("ts", "req_id")).alias("first"))
        .groupBy("user")
        .agg(F.collect_list("first").alias("firsts"))
    )
    here = F.struct("ts", "req_id")
    return changed.join(firsts, "user").select(
        "user", "ts", F.col("prev.mfa").alias("prev_mfa"), "mfa",
        F.size(F.filter("firsts", lambda f: f <= here)).cast("bigint").alias("n_methods"),
    )


def shared_address_countries(src: Sources) -> DataFrame:
    """A user's address seen from more than one country, as behind a VPN."""
    per_country = (
        src.logins.where(F.col("ip").isNotNull() & F.col("country").isNotNull())
        .groupBy("user", "ip", "country")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_country.groupBy("user", "ip")
        .agg(F.sort_array(F.collect_list("country")).alias("countries"), F.sum("n").alias("n"))
        .where(F.size("countries") > 1)
    )
