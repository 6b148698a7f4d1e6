"""Streams whose files come out of order leave no event out and give no key twice."""

from __future__ import annotations

import pytest
from agrolume.plans import stream_queries
from agrolume.plans.world import LEDGER_EVENTS, World, _alias
from agrolume.streaming import files
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_streaming import SF


@pytest.fixture
def backwards(spark, tmp_path, monkeypatch):
    """The events as five micro-batches, the newest first, then the newest ones again and 200, 400 and 600 days later; and all rows as a table."""
    w = World(spark, SF)
    events = w.table("events")
    turns = events.withColumn("turn", F.ntile(5).over(Window.orderBy(F.desc("ts")))).persist()
    for turn in (1, 2, 3, 4, 5, 1):
        turns.where(F.col("turn") == turn).drop("turn").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    for days in (200, 400, 600):
        later = turns.where("turn = 1").drop("turn").withColumn("ts", F.expr(f"ts + interval {days} days"))
        later.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    turns.unpersist()
    stream = files.read_files(spark, f"{tmp_path}/events", events.schema, files_per_batch=1)
    monkeypatch.setattr(stream_queries, "event_stream", lambda w: stream.withColumn("ts", F.col("ts").cast("timestamp")))
    return w, spark.read.parquet(f"{tmp_path}/events")


def test_daily_counts_have_all_events(backwards):
    w, events = backwards
    got = stream_queries.stream_daily_ledger(w)
    keys = ["source_id", "provider_date"]
    want = events.selectExpr(*_alias(LEDGER_EVENTS)).groupBy(*keys).agg(F.count("*"), F.sum("scene_count"), F.sum("failed_count"))
    assert sorted(map(tuple, got.select(*keys, "events", "scene_count", "failed_count").collect())) == sorted(map(tuple, want.collect()))


def test_each_scene_once(backwards):
    w, events = backwards
    got = stream_queries.stream_dedup_scenes(w).select("provider", "product_no").collect()
    want = events.selectExpr("event_type", "user_id*7 + event_id % 5").distinct().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
