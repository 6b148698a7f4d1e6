"""Ledgers, jobs and readiness: is a source usable, and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
GROUP = ["source_id", "aoi_no"]


def ledger_days(events: DataFrame) -> DataFrame:
    """Fold ledger updates into one row per (source, AOI, provider day).

    Scene and processed counts only grow; the first start survives; everything
    else comes from the newest update. A day is complete when its search was
    exhausted, nothing failed, and every scene is processed (in full mode, or
    because the day is empty).
    """
    newest = F.max(F.struct("event_id", "failed_count", "search_complete", "last_error", "heartbeat_at", "full_mode")).alias("n")
    folded = events.groupBy(*GROUP, "provider_date").agg(
        F.max("scene_count").alias("scene_count"),
        F.max("processed_count").alias("processed_count"),
        F.min("heartbeat_at").alias("started_at"),
        newest,
    )
    done = (
        c("n.search_complete") & (c("n.failed_count") == 0) & (c("processed_count") >= c("scene_count"))
        & (c("n.full_mode") | (c("scene_count") == 0))
    )
    return folded.select(
        *GROUP, "provider_date", "scene_count", "processed_count", "started_at",
        c("n.failed_count").alias("failed_count"), c("n.search_complete").alias("search_complete"),
        c("n.last_error").alias("last_error"), c("n.heartbeat_at").alias("heartbeat_at"),
        c("n.event_id").alias("event_id"),
        F.when(done, "complete").otherwise("partial").alias("status"),
    )


def ledger_monitor(days: DataFrame) -> DataFrame:
    """Incomplete days, latest searched day, backlog, last error, heartbeat."""
    backlog = F.greatest(c("scene_count") - c("processed_count"), F.lit(0))
    return days.groupBy(*GROUP).agg(
        F.count_if(c("status") != "complete").alias("incomplete_days"),
        F.max(F.when(c("search_complete"), c("provider_date"))).alias("latest_searched_day"),
        F.sum(backlog).alias("backlog"),
        F.max_by("last_error", F.when(c("last_error").isNotNull(), c("provider_date"))).alias("last_error"),
        F.max("heartbeat_at").alias("heartbeat_at"),
    )


def missing_days(days: DataFrame, *, end: Column, window_days: int) -> DataFrame:
    """Calendar days of the seed window that have no ledger row."""
    wanted = days.select(*GROUP).distinct().select(
        *GROUP, F.explode(F.sequence(F.date_sub(end, window_days - 1), end)).alias("provider_date")
    )
    return wanted.join(days.select(*GROUP, "provider_date"), [*GROUP, "provider_date"], "left_anti")


def sync_window(days: DataFrame, *, end: Column, window_days: int, refresh_days: int) -> DataFrame:
    """Date range to search again: overlap, missing days and incomplete days."""
    gaps = missing_days(days, end=end, window_days=window_days).groupBy(*GROUP).agg(
        F.min("provider_date").alias("first_missing")
    )
    open_days = days.groupBy(*GROUP).agg(
        F.min(F.when((c("status") != "complete") & (c("provider_date") <= end), c("provider_date"))).alias("first_open")
    )
    start = F.least(F.date_sub(end, refresh_days - 1), "first_missing", "first_open")
    return open_days.join(gaps, GROUP, "left").select(*GROUP, start.alias("start_date"), end.alias("end_date"))


def last_success(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """Newest completed full-pipeline job that produced output without failures."""
    good = (c("status") == "completed") & (c("mode_no") == 3) & (c("processed_count") > 0) & (c("failed_count") == 0)
    return jobs.where(good).groupBy(*keys).agg(F.max("completed_at").alias("last_success_at"))


def readiness(
    groups: DataFrame, scenes: DataFrame, outputs: DataFrame, successes: DataFrame, *,
    keys: list[str], required: DataFrame, now: Column, max_age_hours: int,
) -> DataFrame:
    """Status of each (source, AOI): dates, coverage per index, freshness, reasons.

    Dates that exist for every required index are counted by (date, index)
    rows rather than collected as sets, so state per group stays small.
    ``outputs``: keys, acq_date, index_name, created_at.
    """
    wanted = required.groupBy("source_no").agg(F.count("*").alias("wanted"))
    scene_dates = scenes.groupBy(*keys).agg(F.count_distinct("acq_date").alias("scene_dates"))
    dated = outputs.select(*keys, "acq_date", "index_name").distinct()
    per_date = dated.groupBy(*keys, "acq_date").agg(F.count("*").alias("have")).join(wanted, "source_no")
    full = per_date.groupBy(*keys).agg(
        F.count_if(c("have") == c("wanted")).alias("available_dates"),
        F.max(F.when(c("have") == c("wanted"), c("acq_date"))).alias("latest_date"),
    )
    lowest = dated.groupBy(*keys, "index_name").agg(F.count("*").alias("d")).groupBy(*keys).agg(
        F.min("d").alias("min_index_dates"), F.count("*").alias("indices")
    )
    made = outputs.groupBy(*keys).agg(F.max("created_at").alias("latest_output_at"))
    joined = groups
    for part in (scene_dates, full, lowest, made, successes):
        joined = joined.join(part, keys, "left")
    joined = joined.join(wanted, "source_no", "left")
    dates = F.coalesce(c("available_dates"), F.lit(0))
    fresh = F.greatest("latest_output_at", "last_success_at")
    reasons = F.array_compact(F.array(
        F.when(c("last_success_at").isNull() & (dates > 0), "NO_SUCCESSFUL_JOB"),
        F.when(c("last_success_at").isNull() & (dates == 0), "NO_SUCCESSFUL_JOB"),
        F.when((dates == 0) & c("latest_output_at").isNull(), "NO_OUTPUTS"),
        F.when((dates == 0) & c("latest_output_at").isNotNull(), "MISSING_INDEX_COVERAGE"),
    ))
    stale_after = fresh + F.make_interval(hours=F.lit(max_age_hours))
    status = (
        F.when((dates == 0) | fresh.isNull() | (F.size(reasons) > 0), "UNAVAILABLE")
        .when(now > stale_after, "STALE")
        .otherwise("AVAILABLE")
    )
    out_reasons = F.when(status == "STALE", F.array(F.lit("STALE_OUTPUTS"))).otherwise(reasons)
    complete = c("indices") == c("wanted")
    lowest_share = F.when(
        c("scene_dates") > 0,
        F.when(complete, F.bround(c("min_index_dates") * 100.0 / F.greatest("scene_dates", "min_index_dates"), 2)).otherwise(0.0),
    ).otherwise(0.0)
    return joined.select(
        *keys, status.alias("status"), dates.alias("available_dates"), "latest_date",
        lowest_share.alias("min_index_coverage"), F.array_join(out_reasons, ",").alias("reasons"),
    )


def due_plan(sources: DataFrame, successes: DataFrame, *, keys: list[str], now: Column, include_manual: bool = False) -> DataFrame:
    """Report which (source, AOI) pairs are due, not due or disabled."""
    next_due = c("last_success_at") + F.make_interval(days=c("refresh_days"))
    manual = (c("schedule_state") == "manual") & F.lit(not include_manual)
    decision = (
        F.when(c("schedule_state") == "disabled", "disabled")
        .when(manual, "not_due")
        .when(c("last_success_at").isNotNull() & (now < next_due), "not_due")
        .otherwise("due")
    )
    reason = (
        F.when(c("schedule_state") == "disabled", "source schedule is disabled")
        .when(manual, "source is manual-only")
        .when(c("last_success_at").isNotNull() & (now < next_due), "next run is not due yet")
        .when(c("schedule_state") == "scheduled", "scheduled source is due")
        .otherwise("manual run")
    )
    return sources.join(successes, keys, "left").select(
        *keys, decision.alias("decision"), reason.alias("reason"),
        F.date_sub(now.cast("date"), c("window_days")).alias("date_start"), now.cast("date").alias("date_end"),
    )


def stage_attempts(stages: DataFrame) -> DataFrame:
    """Attempt number of each stage run.

    Attempts are numbered inside (job, stage, day) and offset by the runs of
    earlier days, so one job with very many runs is not a single group.
    """
    day = stages.withColumn("day", F.to_date("started_at"))
    per_day = day.groupBy("job_id", "stage_name", "day").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("job_id", "stage_name").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select("job_id", "stage_name", "day", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("job_id", "stage_name", "day").orderBy("started_at", "event_id")
    numbered = day.withColumn("position", F.row_number().over(inside))
    return numbered.join(offsets, ["job_id", "stage_name", "day"]).select(
        "event_id", "job_id", "stage_name", "status", (c("position") + c("before")).alias("attempt")
    )


def stage_counts(stages: DataFrame, *, key: str) -> DataFrame:
    """Runs and failures per job and stage, for whatever stages the rows name."""
    return stages.groupBy(key, "stage_name").agg(
        F.count("*").alias("runs"), F.count_if(c("status") == "failed").alias("failures")
    )


def source_dates(scenes: DataFrame, keys: list[str]) -> DataFrame:
    """Scenes per acquisition date, newest dates usable as a single tile or not."""
    return scenes.groupBy(*keys, "acq_date").agg(
        F.count("*").alias("scene_count"), F.min_by("scene_id", "created_no").alias("first_scene_id")
    ).withColumn("tile_available", c("scene_count") == 1)
