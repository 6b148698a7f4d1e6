"""Registered queries: finite runs of the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.operators import raster
from agrolume.plans.registry import query
from agrolume.plans.world import LEDGER_EVENTS, World, _alias
from agrolume.plans.zonal_queries import INDEX_MOMENTS, field_spans
from agrolume.session import shared_folder, stored
from agrolume.sources import pixels as pixel_source
from agrolume.streaming import files, ledger, state

c = F.col


def event_stream(w: World) -> DataFrame:
    """The events file as a stream; its zone-less time becomes a timestamp."""
    schema = w.table("events").schema
    raw = files.read_files(w.spark, w.sf_dir, schema, only="events.parquet")
    return raw.withColumn("ts", c("ts").cast("timestamp"))


def ledger_stream(w: World) -> DataFrame:
    return event_stream(w).selectExpr(*_alias(LEDGER_EVENTS), "event_id % 4 <> 2 as full_mode")


@query(
    "stream_dedup_scenes",
    "select distinct event_type as provider, user_id*7 + event_id % 5 as product_no from events",
)
def stream_dedup_scenes(w: World) -> DataFrame:
    scenes = event_stream(w).selectExpr("event_type as provider", "user_id*7 + event_id % 5 as product_no", "ts")
    return ledger.first_sights(scenes, time="ts", keys=["provider", "product_no"]).drop("ts")


@query(
    "stream_daily_ledger",
    "select source_id, provider_date, count(*) as events, cast(sum(scene_count) as bigint) as scene_count, cast(sum(failed_count) as bigint) as failed_count "
    "from ledger_events group by source_id, provider_date",
    tables="ledger_events",
)
def stream_daily_ledger(w: World) -> DataFrame:
    """Daily counts of all events, folded from a partial count per micro-batch."""
    return ledger.all_daily_counts(ledger_stream(w), time="heartbeat_at", keys=["source_id"])


@query(
    "stream_upsert_ledger",
    "select source_id, aoi_no, provider_date, scene_count, processed_count, case when search_complete and failed_count = 0 and processed_count >= scene_count "
    "and (full_mode or scene_count = 0) then 'complete' else 'partial' end as status from (select source_id, aoi_no, provider_date, max(scene_count) as scene_count, "
    "max(processed_count) as processed_count, arg_max(failed_count, event_id) as failed_count, arg_max(search_complete, event_id) as search_complete, "
    "arg_max(event_id % 4 <> 2, event_id) as full_mode from ledger_events group by 1, 2, 3) s",
    tables="ledger_events",
)
def stream_upsert_ledger(w: World) -> DataFrame:
    return ledger.upsert_ledger(ledger_stream(w))


#: Hours after which a worker is lost and a cached value is old; the clock of both jobs runs an hour behind the newest event.
SILENT_HOURS, HELD_HOURS = 6, 24
HOUR_MS = 3_600_000


@query(
    "stream_heartbeat_timeout",
    "select user_id as job_id, epoch_us(max(ts)) // 1000 as last_ms from events group by user_id "
    f"having epoch_us(max(ts)) // 1000 + {SILENT_HOURS * HOUR_MS} < (select epoch_us(max(ts)) // 1000 - {HOUR_MS} from events)",
)
def stream_heartbeat_timeout(w: World) -> DataFrame:
    """Workers without a heartbeat for six hours of event time."""
    beats = event_stream(w).selectExpr("user_id as job_id", "ts")
    lost = state.heartbeat_timeouts(beats, key="job_id", time="ts", timeout_ms=SILENT_HOURS * HOUR_MS, delay="1 hour")
    return files.collect_batches(lost, mode="append", label="heartbeat").drop("batch_id")


@query(
    "stream_ttl_cache",
    "select user_id as scene_no, epoch_us(ts) // 1000 as at_ms, max(value) as value from (select *, rank() over (partition by user_id order by epoch_us(ts) // 1000 desc) as age from events "
    "where ts is not null and value is not null) e "
    f"where age = 1 and epoch_us(ts) // 1000 >= (select epoch_us(max(ts)) // 1000 - {(1 + HELD_HOURS) * HOUR_MS} from events where value is not null) group by user_id, epoch_us(ts) // 1000",
)
def stream_ttl_cache(w: World) -> DataFrame:
    """Newest value per scene that is not older than a day of event time."""
    values = event_stream(w).selectExpr("user_id as scene_no", "ts", "value as stat")
    held = state.ttl_cache(values, key="scene_no", time="ts", value="stat", ttl_ms=HELD_HOURS * HOUR_MS, delay_ms=HOUR_MS)
    return state.still_held(files.collect_batches(held, mode="append", label="ttl"), "scene_no")


@query(
    "stream_zonal_stats",
    f"select field_id, scene_id, index_name, {INDEX_MOMENTS}, round(count(code)*100e0/count(*), 6) as usable_percent from fpi group by field_id, scene_id, index_name",
    tables="fpi",
)
def stream_zonal_stats(w: World) -> DataFrame:
    """Zonal statistics of every index, fed by a pixel table that arrives file by file."""
    folder = shared_folder(w.spark, "pixels")
    pixel_source.write_stream_files(raster.coded(w.pixels), f"{folder}/codes")
    schema = w.spark.read.parquet(f"{folder}/codes").schema
    arriving = files.read_files(w.spark, f"{folder}/codes", schema, files_per_batch=4)
    # Every batch reads the spans: they are cut once.
    return ledger.zonal_updates(arriving, stored(field_spans(w), "spans"))
