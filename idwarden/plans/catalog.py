"""Queries over the test tables: one per operator, each on the whole ``events`` table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idwarden.operators import access, activity, integrity, logins, profile, quality
from idwarden.plans import files_trial
from idwarden.sources import (
    Sources,
    drop_repeats,
    flatten_messages,
    initiator_counts,
    service_initiators,
    unseen_files,
)
from idwarden.sources.events_view import messages_from_events, read_events, sources_from_events
from idwarden.streaming import trial

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Dates and arrays as text, so that two engines print the same values."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _on_sources(fn: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf_dir: plain(fn(sources_from_events(read_events(spark, sf_dir)), **params))


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every directory event delivered twice, then freed of repeats."""
    directory = sources_from_events(read_events(spark, sf_dir)).directory
    return drop_repeats(directory.unionByName(directory), "ad")


def _messages(source: str) -> Query:
    def run(spark, sf_dir):
        flat = flatten_messages(messages_from_events(read_events(spark, sf_dir), source), source)
        return plain(flat)

    return run


def _batch_files(src: Sources) -> DataFrame:
    events = src.events()
    name = F.concat(F.lit("source/"), "source", F.lit("/"), F.date_format("ts", "yyyyMMdd"), F.lit("-data.parquet"))
    return events.select(name.alias("path"), "ts")


def _unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per source and day; the ledger holds the days up to the first termination date in HR."""
    src = sources_from_events(read_events(spark, sf_dir))
    files = _batch_files(src)
    listing = files.groupBy("path").agg(F.count("*").alias("n_rows"))
    known_until = src.hr.agg(F.min("termination_date").alias("d")).scalar()
    return unseen_files(listing, files.where(F.to_date("ts") <= known_until).select("path"))


def _initiators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service_initiators(sources_from_events(read_events(spark, sf_dir)).directory)


QUERIES: dict[str, Query] = {
    "d01_shadow_access": _on_sources(access.shadow_access),
    "d02_impossible_login": _on_sources(logins.impossible_login),
    "d02a_session_gaps": _on_sources(logins.session_login_gaps),
    "d02b_sessionless_gaps": _on_sources(logins.sessionless_login_gaps),
    "d02c_no_login": _on_sources(logins.usage_without_login),
    "d03_mfa_bypass": _on_sources(logins.mfa_bypass),
    "d04_risk_scores": _on_sources(profile.risk_scores),
    "d05_timelines": _on_sources(profile.timelines),
    "d06_mfa_bypass_all_apps": _on_sources(logins.mfa_bypass_all_apps),
    "d07_impossible_travel": _on_sources(logins.impossible_travel),
    "d08_unrequested_escalation": _on_sources(access.unrequested_escalations),
    "d09_volume_spikes": _on_sources(activity.volume_spikes),
    "d09_volume_spikes_by_group": _on_sources(activity.volume_spikes, entity="group", factor=1.5),
    "d10_rejected_but_executed": _on_sources(access.rejected_but_executed),
    "d11_high_risk_sequence": _on_sources(profile.high_risk_sequences),
    "d12_excessive_data": _on_sources(activity.excessive_data, threshold_mb=100.0),
    "d13_role_drift": _on_sources(access.role_history),
    "d14_stale_access": _on_sources(access.stale_access, stale_days=14),
    "d15_multi_app_session": _on_sources(activity.multi_app_sessions, min_apps=2),
    "d16_mfa_drift": _on_sources(logins.mfa_drift),
    "d17_approver_behaviour": _on_sources(access.approver_behaviour),
    "d18_group_churn": _on_sources(activity.group_churn),
    "d19_orphan_events": _on_sources(integrity.orphan_events),
    "d20_orphan_users": _on_sources(integrity.orphan_users),
    "d21_cleanest_users": _on_sources(profile.cleanest_users),
    "d21_cleanest_users_top100": _on_sources(profile.cleanest_users, top=100),
    "d22_time_warp": _on_sources(integrity.time_warp),
    "q2_unused_approvals": _on_sources(access.unused_approvals),
    "q3_self_escalation": _on_sources(lambda src: access.unrequested_escalations(src).where("self_initiated")),
    "q4_vpn_geo": _on_sources(logins.shared_address_countries),
    "q5_long_sessions": _on_sources(activity.long_sessions),
    "q6_late_directory_event": _on_sources(activity.late_directory_events),
    "v1_volumes": _on_sources(quality.volumes),
    "v2_anomalies_per_code": _on_sources(quality.anomalies_per_code),
    "v3_unused_approval_count": _on_sources(quality.unused_approval_count),
    "v4_unknown_session_count": _on_sources(quality.unknown_session_count),
    "v5_directory_linkage": _on_sources(quality.directory_linkage),
    "v6_usage_before_login": _on_sources(quality.usage_before_login_count),
    "v7_long_session_count": _on_sources(quality.long_session_count),
    "v8_lifecycle_violations": _on_sources(quality.lifecycle_violations),
    "v9_date_range": _on_sources(quality.date_range),
    "l1_label_scores": _on_sources(quality.label_scores),
    "n1_messages_app": _messages("app_usage"),
    "n1_messages_logins": _messages("okta"),
    "n7_service_initiators": _initiators,
    "n8_initiator_top10": lambda spark, sf_dir: initiator_counts(sources_from_events(read_events(spark, sf_dir)).directory),
    "n8_initiator_top10_after": lambda spark, sf_dir: initiator_counts(_initiators(spark, sf_dir)),
    "n9_session_attribution": _on_sources(activity.session_attribution),
    "n11_unseen_files": _unseen,
    "n12_drop_repeats": _redelivered,
    "r2_day_range": files_trial.day_ranges,
    "r2_two_generations": files_trial.two_generations,
    "j1_job_twice": files_trial.job_twice,
    "j1_partials": files_trial.merged_tables,
    "j1_all_tables": files_trial.all_tables,
    "n11_ledger": files_trial.failed_run_repeated,
    "r5_csv": files_trial.csv_round_trip,
    "w1_append": files_trial.appended,
    "w6_rerun": files_trial.catalog_reruns,
    "s1_ingest": trial.ingest_app_messages,
    "s1_merged_batches": trial.merged_batches,
    "s2_streaming_repeats": trial.distinct_events,
    "s3_streaming_bypass": trial.bypass_pairs,
    "s3_late_rows": trial.late_bypass_pairs,
    "s3_streaming_shadow_access": trial.shadow_pairs,
    "s4_daily_counts": trial.daily_counts,
    "s5_sessions": trial.sessions,
}
