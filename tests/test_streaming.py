"""Multi-batch streams give the answers of one batch."""

from __future__ import annotations

import time

import pytest
from agrolume.plans.world import LEDGER_EVENTS, World, _alias
from agrolume.streaming import files, ledger, state
from pyspark.sql import functions as F

c = F.col
SF = "/root/testdata/sf0.001"


def split_events(spark, tmp_path, parts):
    w = World(spark, SF)
    folder = f"{tmp_path}/events"
    w.table("events").repartitionByRange(parts, "ts").write.parquet(folder)
    stream = files.read_files(spark, folder, w.table("events").schema, files_per_batch=1)
    return w, stream.withColumn("ts", c("ts").cast("timestamp"))


def test_ledger_from_many_batches_equals_one_batch(spark, tmp_path):
    w, stream = split_events(spark, tmp_path, 4)
    exprs = [*_alias(LEDGER_EVENTS), "event_id % 4 <> 2 as full_mode"]
    got = ledger.upsert_ledger(stream.selectExpr(*exprs))
    static = ledger.ledger_status(ledger.newest_ledger(ledger.ledger_rows(w.table("events").selectExpr(*exprs))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, static.collect()))


def test_replayed_batch_replaces_itself(spark, tmp_path):
    store = files.BatchStore(spark, "replay", f"{tmp_path}/store")
    rows = spark.createDataFrame([(1, 5)], "k long, n long")
    store.save(rows, 0)
    store.save(rows, 0)
    store.save(rows, 1)
    assert store.read(rows.schema).agg(F.sum("n")).first()[0] == 10


def counting_store(spark, path):
    def fold(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    return files.KeyedStore(spark, "counts", schema=spark.createDataFrame([], "k long, n long").schema, fold=fold, path=path, fan=3)


def counts(rows):
    return {r.k: r.n for r in rows.collect()}


def test_keyed_store_is_compact_and_a_replay_is_harmless(spark, tmp_path):
    store = counting_store(spark, f"{tmp_path}/keyed")
    assert counts(store.read()) == {}
    for b in range(7):
        rows = spark.createDataFrame([(k, 1) for k in (1, 2, 2, b)], "k long, n long")
        store.merge(rows, b)
        store.merge(rows, b)
    assert counts(store.read()) == {0: 1, 1: 8, 2: 15, 3: 1, 4: 1, 5: 1, 6: 1}
    # Three runs of a level become one of the next; two manifests and their runs are kept, nothing else.
    assert [level for level, _ in store.manifest()] == [1, 1, 0] and len(store.batches()) == 2
    folders = {d.name for d in (tmp_path / "keyed" / "runs").iterdir() if d.is_dir()}
    assert folders == {f for b in store.batches() for _, f in store.manifest(b)}
    for b in (7, 8):
        store.merge(spark.createDataFrame([(1, 1)], "k long, n long"), b)
    assert [level for level, _ in store.manifest()] == [2] and counts(store.read())[1] == 10


def test_keyed_store_survives_a_batch_killed_before_its_manifest(spark, tmp_path, monkeypatch):
    store = counting_store(spark, f"{tmp_path}/keyed")
    rows = spark.createDataFrame([(1, 1), (2, 5)], "k long, n long")
    store.merge(rows, 0)

    def killed(folders, batch_id):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            store.merge(rows, 1)
    again = counting_store(spark, store.path)
    assert counts(again.read()) == {1: 1, 2: 5}
    again.merge(rows, 1)
    assert counts(again.read()) == {1: 2, 2: 10}


def test_empty_batch_and_null_keys_in_the_keyed_store(spark, tmp_path):
    store = counting_store(spark, f"{tmp_path}/keyed")
    store.merge(spark.createDataFrame([], "k long, n long"), 0)
    assert counts(store.read()) == {}
    store.merge(spark.createDataFrame([(None, 1), (None, 2)], "k long, n long"), 1)
    assert counts(store.read()) == {None: 3}


def test_cached_value_expires_and_comes_back(spark, tmp_path):
    batches = (
        [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:00:00", 3.0), (2, "2024-01-01 00:00:00", 2.0)],
        [(2, "2024-01-02 12:00:00", 5.0)],
        [(3, "2024-01-03 00:00:00", None), (2, "2024-01-02 13:00:00", 6.0)],
        [(1, "2024-01-02 20:00:00", 4.0), (2, "2024-01-02 11:00:00", 9.0)],
    )
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "scene_no long, at string, stat double").select("scene_no", c("at").cast("timestamp").alias("ts"), "stat")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/values")
        time.sleep(1.1 if i < 3 else 0)  # files are taken in the order of their times
    stream = files.read_files(spark, f"{tmp_path}/values", frame.schema, files_per_batch=1)
    held = state.ttl_cache(stream, key="scene_no", time="ts", value="stat", ttl_ms=86_400_000, delay_ms=3_600_000)
    rows = files.collect_batches(held, mode="append", label="values").persist()
    first = [(r.at_ms // 3_600_000 % 24, r.value) for r in rows.where("scene_no = 1").orderBy("batch_id").collect()]
    assert first == [(0, 3.0), (0, None), (20, 4.0)]
    assert {r.scene_no: r.value for r in state.still_held(rows, "scene_no").collect()} == {1: 4.0, 2: 6.0}


def test_heartbeat_timeout_reports_silent_workers(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"), (1, "2024-01-03 00:00:00"), (3, "2024-01-03 01:00:00")]
    frame = spark.createDataFrame(rows, "job_id long, at string").select("job_id", c("at").cast("timestamp").alias("ts"))
    frame.coalesce(1).write.parquet(f"{tmp_path}/beats")
    stream = files.read_files(spark, f"{tmp_path}/beats", frame.schema)
    lost = state.heartbeat_timeouts(stream, key="job_id", time="ts", timeout_ms=86_400_000, delay="1 hour")
    got = files.collect_batches(lost, mode="append", label="beats").collect()
    assert [r.job_id for r in got] == [2]
