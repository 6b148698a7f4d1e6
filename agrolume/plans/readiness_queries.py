"""Registered queries: ledgers, jobs, readiness and due reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.operators import readiness
from agrolume.plans.catalog_queries import assets, rasters
from agrolume.operators.catalog import display_assets
from agrolume.plans.registry import query
from agrolume.plans.world import World, add_table

c = F.col

add_table(
    "ledger_days",
    "ledger_events",
    "select source_id, aoi_no, provider_date, scene_count, processed_count, failed_count, search_complete, last_error, heartbeat_at, event_id, "
    "case when search_complete and failed_count = 0 and processed_count >= scene_count and (full_mode or scene_count = 0) then 'complete' else 'partial' end as status from "
    "(select source_id, aoi_no, provider_date, max(scene_count) as scene_count, max(processed_count) as processed_count, arg_max(failed_count, event_id) as failed_count, "
    "arg_max(search_complete, event_id) as search_complete, arg_max(coalesce(last_error, ''), event_id) as last_error, arg_max(heartbeat_at, event_id) as heartbeat_at, max(event_id) as event_id, "
    "arg_max(event_id % 4 <> 2, event_id) as full_mode from ledger_events group by source_id, aoi_no, provider_date) s",
)


def ledger_rows(w: World) -> DataFrame:
    return readiness.ledger_days(w.ledger_events.withColumn("full_mode", c("event_id") % 4 != 2))


@query(
    "upsert_ledger",
    "select source_id, aoi_no, provider_date, scene_count, processed_count, failed_count, search_complete, nullif(last_error, '') as last_error, "
    "strftime(heartbeat_at, '%Y-%m-%d %H:%M:%S') as heartbeat, status from ledger_days",
    tables="ledger_days",
)
def upsert_ledger(w: World) -> DataFrame:
    return ledger_rows(w).select(
        "source_id", "aoi_no", "provider_date", "scene_count", "processed_count", "failed_count", "search_complete", "last_error",
        F.date_format("heartbeat_at", "yyyy-MM-dd HH:mm:ss").alias("heartbeat"), "status",
    )


@query(
    "ledger_monitor",
    "select source_id, aoi_no, count(case when status <> 'complete' then 1 end) as incomplete_days, max(case when search_complete then provider_date end) as latest_searched_day, "
    "cast(sum(greatest(scene_count - processed_count, 0)) as bigint) as backlog, arg_max(last_error, provider_date) filter (last_error <> '') as last_error, "
    "strftime(max(heartbeat_at), '%Y-%m-%d %H:%M:%S') as heartbeat from ledger_days group by source_id, aoi_no",
    tables="ledger_days",
)
def ledger_monitor(w: World) -> DataFrame:
    return readiness.ledger_monitor(ledger_rows(w)).withColumn(
        "heartbeat", F.date_format("heartbeat_at", "yyyy-MM-dd HH:mm:ss")
    ).drop("heartbeat_at")


_END = "2024-01-31"
add_table(
    "gaps",
    "ledger_days",
    f"select w.* from (select source_id, aoi_no, date '{_END}' - cast(unnest(range(40)) as integer) as provider_date from (select distinct source_id, aoi_no from ledger_days) g) w "
    "anti join ledger_days d on d.source_id = w.source_id and d.aoi_no = w.aoi_no and d.provider_date = w.provider_date",
)


@query("missing_sync_days", "select source_id, aoi_no, provider_date from gaps", tables="gaps")
def missing_sync_days(w: World) -> DataFrame:
    return readiness.missing_days(ledger_rows(w), end=F.to_date(F.lit(_END)), window_days=40)


@query(
    "sync_window",
    f"select d.source_id, d.aoi_no, least(date '{_END}' - 6, g.first_missing, min(case when d.status <> 'complete' then d.provider_date end)) as start_date, date '{_END}' as end_date "
    "from ledger_days d left join (select source_id, aoi_no, min(provider_date) as first_missing from gaps group by 1, 2) g on g.source_id = d.source_id and g.aoi_no = d.aoi_no "
    "group by d.source_id, d.aoi_no, g.first_missing",
    tables="ledger_days gaps",
)
def sync_window(w: World) -> DataFrame:
    return readiness.sync_window(ledger_rows(w), end=F.to_date(F.lit(_END)), window_days=40, refresh_days=7)


# --- jobs --------------------------------------------------------------------


def finished_jobs(w: World) -> DataFrame:
    return w.job_events.select(
        "event_id", "job_id", "status", "mode_no", "processed_count", "failed_count",
        (c("job_id") % 7).alias("source_no"), F.floor(c("job_id") / 15).alias("aoi_no"), c("started_at").alias("completed_at"),
    )


add_table(
    "success",
    "job_events",
    "select job_id % 7 as source_no, cast(floor(job_id/15) as bigint) as aoi_no, max(started_at) as last_success_at from job_events where status = 'completed' and mode_no = 3 "
    "and processed_count > 0 and failed_count = 0 group by 1, 2",
)


@query(
    "last_success",
    "select source_no, aoi_no, strftime(last_success_at, '%Y-%m-%d %H:%M:%S') as last_success from success",
    tables="success",
)
def last_success(w: World) -> DataFrame:
    return readiness.last_success(finished_jobs(w), ["source_no", "aoi_no"]).select(
        "source_no", "aoi_no", F.date_format("last_success_at", "yyyy-MM-dd HH:mm:ss").alias("last_success")
    )


_DUE_NOW = "2024-02-05 00:00:00"
add_table(
    "pairs_aoi",
    "catalog",
    "select distinct source_no, aoi_no, case when source_no = 6 then 'disabled' when (source_no + aoi_no) % 5 = 0 then 'manual' else 'scheduled' end as schedule_state, "
    "7 + source_no*2 as refresh_days, 30 as window_days from catalog",
)


def scheduled_pairs(w: World) -> DataFrame:
    return w.catalog.selectExpr(
        "source_no", "aoi_no",
        "case when source_no = 6 then 'disabled' when (source_no + aoi_no) % 5 = 0 then 'manual' else 'scheduled' end as schedule_state",
        "cast(7 + source_no*2 as int) as refresh_days", "30 as window_days",
    ).distinct()


@query(
    "plan_due_sources",
    f"select source_no, aoi_no, case when schedule_state = 'disabled' then 'disabled' when schedule_state = 'manual' then 'not_due' when timestamp '{_DUE_NOW}' < due then 'not_due' else 'due' end as decision, "
    f"case when schedule_state = 'disabled' then 'source schedule is disabled' when schedule_state = 'manual' then 'source is manual-only' when timestamp '{_DUE_NOW}' < due then 'next run is not due yet' "
    f"else 'scheduled source is due' end as reason, cast(timestamp '{_DUE_NOW}' as date) - 30 as date_start, cast(timestamp '{_DUE_NOW}' as date) as date_end from "
    "(select p.*, s.last_success_at + to_days(cast(p.refresh_days as integer)) as due from pairs_aoi p left join success s on s.source_no = p.source_no and s.aoi_no = p.aoi_no) q",
    tables="pairs_aoi success",
)
def plan_due_sources(w: World) -> DataFrame:
    """Report of the (source, AOI) pairs that are due for another search."""
    done = readiness.last_success(finished_jobs(w), ["source_no", "aoi_no"])
    return readiness.due_plan(
        scheduled_pairs(w), done, keys=["source_no", "aoi_no"], now=F.lit(_DUE_NOW).cast("timestamp_ntz")
    )


_REQUIRED = "case source_no when 0 then 6 when 3 then 3 else 4 end"
_READY_NOW = "2024-02-02 00:00:00"


@query(
    "readiness_status",
    "select source_no, aoi_no, case when dates = 0 or reasons <> '' then 'UNAVAILABLE' "
    f"when timestamp '{_READY_NOW}' > greatest(made, last_success_at) + interval 168 hour then 'STALE' else 'AVAILABLE' end as status, dates as available_dates, latest_date, "
    "min_index_coverage, case when not (dates = 0 or reasons <> '') and "
    f"timestamp '{_READY_NOW}' > greatest(made, last_success_at) + interval 168 hour then 'STALE_OUTPUTS' else reasons end as reasons from "
    "(select *, concat_ws(',', case when last_success_at is null then 'NO_SUCCESSFUL_JOB' end, case when dates = 0 then case when made is null then 'NO_OUTPUTS' else 'MISSING_INDEX_COVERAGE' end end) as reasons from "
    "(select p.source_no, p.aoi_no, coalesce(f.dates, 0) as dates, f.latest_date, m.made, s.last_success_at, "
    f"case when coalesce(n.scene_dates, 0) > 0 then case when l.indices = (case p.source_no when 0 then 6 when 3 then 3 else 4 end) then round_even(l.low*100e0/greatest(n.scene_dates, l.low), 2) else 0e0 end else 0e0 end as min_index_coverage "
    "from (select distinct source_no, aoi_no from catalog where source_no <= 4) p "
    "left join (select source_no, aoi_no, count(distinct acq_date) as scene_dates from catalog group by 1, 2) n on n.source_no = p.source_no and n.aoi_no = p.aoi_no "
    f"left join (select source_no, aoi_no, count(*) as dates, max(acq_date) as latest_date from (select source_no, aoi_no, acq_date, count(distinct index_name) as have from rasters group by 1, 2, 3) x where have = {_REQUIRED} group by 1, 2) f "
    "on f.source_no = p.source_no and f.aoi_no = p.aoi_no "
    "left join (select source_no, aoi_no, min(d) as low, count(*) as indices from (select source_no, aoi_no, index_name, count(distinct acq_date) as d from rasters group by 1, 2, 3) y group by 1, 2) l on l.source_no = p.source_no and l.aoi_no = p.aoi_no "
    "left join (select source_no, aoi_no, max(cast(created_on as timestamp)) as made from rasters group by 1, 2) m on m.source_no = p.source_no and m.aoi_no = p.aoi_no "
    "left join success s on s.source_no = p.source_no and s.aoi_no = p.aoi_no) q) r",
    tables="rasters success",
)
def readiness_status(w: World) -> DataFrame:
    keys = ["source_no", "aoi_no"]
    optical = w.catalog.where("source_no <= 4")
    outputs = rasters(w).withColumn("created_at", c("created_on").cast("timestamp_ntz"))
    done = readiness.last_success(finished_jobs(w), keys)
    return readiness.readiness(
        optical.select(*keys).distinct(), optical, outputs, done, keys=keys,
        required=dims.index_role_dim(w.spark), now=F.lit(_READY_NOW).cast("timestamp_ntz"), max_age_hours=168,
    )


@query(
    "backfill_summary",
    "select s.*, f.item, f.error from (select job_id, count(*) as runs, cast(sum(processed_count) as bigint) as processed, cast(sum(failed_count) as bigint) as failed, "
    "case when sum(failed_count) = 0 then 'completed' else 'partial' end as status from job_events group by job_id) s left join "
    "(select job_id, stage_name as item, 'E' || max(event_id) as error from job_events where failed_count > 0 group by job_id, stage_name) f on f.job_id = s.job_id",
    tables="job_events",
)
def backfill_summary(w: World) -> DataFrame:
    """Summed counters per job and its failed items, the newest error of each.

    The items stay rows instead of growing one list per job.
    """
    totals = w.job_events.groupBy("job_id").agg(
        F.count("*").alias("runs"), F.sum("processed_count").alias("processed"), F.sum("failed_count").alias("failed"),
        F.when(F.sum("failed_count") == 0, "completed").otherwise("partial").alias("status"),
    )
    failed = w.job_events.where("failed_count > 0").groupBy("job_id", c("stage_name").alias("item")).agg(
        F.concat(F.lit("E"), F.max("event_id")).alias("error")
    )
    return totals.join(failed, "job_id", "left")


@query(
    "stage_counts",
    "select job_id, stage_name, count(*) as runs, count(case when status = 'failed' then 1 end) as failures from job_events group by job_id, stage_name",
    tables="job_events",
)
def stage_counts(w: World) -> DataFrame:
    return readiness.stage_counts(w.job_events, key="job_id")


@query(
    "stage_attempts",
    "select event_id, job_id, stage_name, status, row_number() over (partition by job_id, stage_name order by started_at, event_id) as attempt from job_events",
    tables="job_events",
)
def stage_attempts(w: World) -> DataFrame:
    return readiness.stage_attempts(w.job_events)


@query(
    "source_dates",
    "select c.source_no, c.aoi_no, c.acq_date, count(*) as scene_count, arg_min(c.scene_id, c.created_no) as first_scene_id, count(*) = 1 as tile_available from catalog c join "
    "(select scene_id, count(case when asset_key in ('red','green','blue') and mirror_status = 'mirrored' and mirror_path is not null then 1 end) = 3 or "
    "count(case when asset_key = 'analytic' and asset_kind = 'prepared' then 1 end) > 0 as shown from assets group by scene_id) a on a.scene_id = c.scene_id "
    "where c.status = 'accepted' and a.shown group by c.source_no, c.aoi_no, c.acq_date",
    tables="catalog assets",
)
def source_dates(w: World) -> DataFrame:
    """Accepted, displayable scenes per date; a lone scene can serve tiles."""
    shown = display_assets(assets(w)).where("display is not null").select("scene_id")
    accepted = w.catalog.where("status = 'accepted'").join(shown, "scene_id", "left_semi")
    return readiness.source_dates(accepted, ["source_no", "aoi_no"])
