"""Continuous ingest: scene dedup, daily counts, ledger upserts, zonal updates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume.operators import georef, raster, zonal
from agrolume.streaming import files

c = F.col


def folded(
    stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], fold: Callable[[DataFrame], DataFrame], *, label: str, placed: bool = False
) -> DataFrame:
    """Run a finite stream into a keyed store and return its rows: no event is late, no key forgotten.

    ``prepare`` gives rows that ``fold`` brings down to one per key, within a batch and with those of the batches before.
    ``placed``: rows are returned where ``fold`` puts them.
    """
    store = files.KeyedStore(stream.sparkSession, label, schema=fold(prepare(stream)).schema, fold=fold)

    def each(batch: DataFrame, batch_id: int) -> None:
        store.merge(prepare(batch), batch_id)

    files.run_to_end(stream, mode="append", each_batch=each, checkpoint=f"{store.path}/checkpoint")
    return store.read(placed=placed)


def first_sights(stream: DataFrame, *, time: str, keys: list[str], label: str = "dedup") -> DataFrame:
    """Each (provider, product) of a finite stream once, with its earliest time."""

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min(time).alias(time))

    return folded(stream, lambda batch: batch.select(*keys, time), fold, label=label)


def all_daily_counts(stream: DataFrame, *, time: str, keys: list[str], label: str = "daily") -> DataFrame:
    """Scenes per day and key of a finite stream, however late they come."""
    day = ["provider_date", *keys]
    counts = ["events", "scene_count", "failed_count"]

    def prepare(batch: DataFrame) -> DataFrame:
        each = batch.withColumn("provider_date", F.to_date(time)).withColumn("events", F.lit(1).cast("bigint"))
        return each.select(*day, *[c(n).cast("bigint").alias(n) for n in counts])

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*day).agg(*[F.sum(n).alias(n) for n in counts])

    return folded(stream, prepare, fold, label=label)


LEDGER_KEYS = ["source_id", "aoi_no", "provider_date"]
_NEWEST = ("event_id", "failed_count", "search_complete", "full_mode")


def ledger_rows(events: DataFrame) -> DataFrame:
    return events.select(*LEDGER_KEYS, "scene_count", "processed_count", F.struct(*_NEWEST).alias("newest"))


def newest_ledger(rows: DataFrame) -> DataFrame:
    """One row per ledger key: the largest counts and the newest event; folding folded rows again gives the same."""
    return rows.groupBy(*LEDGER_KEYS).agg(*[F.max(n).alias(n) for n in ("scene_count", "processed_count", "newest")])


def ledger_status(rows: DataFrame) -> DataFrame:
    """Monotone ledger rows: complete once everything found is processed and nothing failed."""
    n = c("newest")
    done = (
        n["search_complete"] & (n["failed_count"] == 0) & (c("processed_count") >= c("scene_count"))
        & (n["full_mode"] | (c("scene_count") == 0))
    )
    return rows.select(
        *LEDGER_KEYS, "scene_count", "processed_count", F.when(done, "complete").otherwise("partial").alias("status")
    )


def upsert_ledger(stream: DataFrame, *, label: str = "ledger") -> DataFrame:
    """Run a finite event stream into a keyed store of ledger rows."""
    return ledger_status(folded(stream, ledger_rows, newest_ledger, label=label))


def zonal_updates(pixel_stream: DataFrame, spans: DataFrame, *, label: str = "zonal") -> DataFrame:
    """Zonal statistics of every index kept current as scenes arrive.

    Each micro-batch of coded pixels joins the static field spans. The keyed store counts pixels that have all their
    codes alike, one row with a code per index; these become rows per index only when they are read, where one
    shuffle has gathered them, so statistics over all batches are exact.
    """
    keys = (*zonal.PAIR, "index_name")
    codes = [n for n in pixel_stream.columns if n.startswith("code_")]
    alike = [*zonal.PAIR, "source_no", *codes]

    def prepare(batch: DataFrame) -> DataFrame:
        inside = georef.join_pixels(batch.select("scene_id", "grid_no", "source_no", "rw", "cl", *codes), spans)
        return inside.select(*alike, F.lit(1).cast("bigint").alias("n"))

    def fold(rows: DataFrame) -> DataFrame:
        return zonal.gathered(rows).groupBy(*alike).agg(F.sum("n").alias("n"))

    rows = raster.by_index(folded(pixel_stream, prepare, fold, label=label, placed=True))
    hist = rows.groupBy(*keys, c("code").cast("long").alias("code")).agg(F.sum("n").alias("n"))
    return zonal.stats_from_histogram(hist, keys=keys, unit=raster.scale_of(c("index_name")))
