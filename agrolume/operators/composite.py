"""Best-available composites and their metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.functions import masks
from agrolume.functions.rounding import percent, r6

c = F.col

# Minimum coverage percent and standing warning per sensor.
POLICY = (
    (2, "LISS-3", 95.0, None),
    (3, "LISS-4", 0.0, "partial_aoi_coverage_expected"),
    (4, "AWiFS", 95.0, "coarse_regional_source"),
)
ALLOWED_CLASSES = (0, 1, 2, 3, 4)


def best_available(pixels: DataFrame, *, keys: list[str], bands: list[str]) -> DataFrame:
    """Per cell the latest valid pixel, else the earliest covered one.

    ``pixels`` carries acq_date, scene_id, mask and the bands. Ties in time go
    to the later scene id for valid pixels and to the earlier one for covered
    pixels, as a stable pass in time order gives. Both picks are ordinary
    max/min over a struct, so Spark combines them before the shuffle and a cell
    with very many scenes never has to be sorted as one group.
    """
    payload = F.struct("acq_date", "scene_id", "mask", *bands)
    valid, covered = masks.clear_or_water(c("mask")), c("mask") != masks.NODATA
    picked = pixels.groupBy(*keys).agg(
        F.max(F.when(valid, payload)).alias("latest_valid"),
        F.min(F.when(covered, payload)).alias("earliest_covered"),
    )
    best = F.coalesce("latest_valid", "earliest_covered")
    return picked.select(
        *keys,
        F.coalesce(best["mask"], F.lit(masks.NODATA)).alias("mask"),
        best["scene_id"].alias("scene_id"),
        best["acq_date"].alias("acq_date"),
        *[F.coalesce(best[b], F.lit(0)).alias(b) for b in bands],
    )


def metrics(composite: DataFrame, *, keys: list[str]) -> DataFrame:
    """Covered, usable and cloud-masked shares of a composite."""
    mask = c("mask")
    counted = composite.groupBy(*keys).agg(
        F.count("*").alias("aoi_px"),
        F.count_if(mask != 0).alias("covered_px"),
        F.count_if(masks.clear_or_water(mask)).alias("usable_px"),
        F.count_if(mask.isin(masks.CLOUD, masks.SHADOW)).alias("cloud_masked_px"),
    )
    return counted.select(
        "*",
        r6(percent(c("covered_px"), c("aoi_px"))).alias("coverage_percent"),
        r6(percent(c("usable_px"), c("aoi_px"))).alias("usable_percent"),
        r6(percent(c("cloud_masked_px"), c("aoi_px"))).alias("cloud_masked_percent"),
    )


def contributors(pixels: DataFrame, *, keys: list[str]) -> DataFrame:
    """The scenes behind each composite, one row each, with their date."""
    return pixels.select(*keys, "scene_id", "acq_date").distinct()


def policy_warnings(measured: DataFrame, source_no: Column) -> DataFrame:
    """Standing and coverage warnings of each composite, comma separated."""
    minimum, standing = F.lit(None), F.lit(None)
    for number, _, floor, warning in POLICY:
        minimum = F.when(source_no == number, floor).otherwise(minimum)
        standing = F.when(source_no == number, F.lit(warning)).otherwise(standing)
    low = F.when(c("coverage_percent") < minimum, "coverage_below_threshold")
    return measured.withColumn("min_coverage_percent", minimum).withColumn(
        "warnings", F.array_join(F.array_compact(F.array(standing, low)), ",")
    )


def verify(declared: DataFrame, measured: DataFrame, *, keys: list[str], expected_res: Column,
           tolerance: Column) -> DataFrame:
    """Problems of each declared composite against the recomputed metrics.

    ``measured`` carries coverage_percent, usable_percent and bad_class_px;
    ``declared`` the manifest's own figures, resolution and band count.
    """
    recomputed = measured.select(
        *keys, c("coverage_percent").alias("m_coverage"), c("usable_percent").alias("m_usable"), "bad_class_px"
    )
    joined = declared.join(recomputed, keys, "left")
    checks = (
        (c("schema_version").isNull(), "composite manifest missing fields: schema_version"),
        (~F.coalesce(c("composite"), F.lit(False)), "composite manifest must set composite=true"),
        (F.abs(c("resolution") - expected_res) > tolerance, "composite resolution differs from expected"),
        (c("bad_class_px") > 0, "unexpected mask classes"),
        (F.abs(c("coverage_percent") - c("m_coverage")) > 0.01, "manifest coverage does not match mask coverage"),
        (F.abs(c("usable_percent") - c("m_usable")) > 0.01, "manifest usable coverage does not match mask usable coverage"),
        (F.coalesce(c("m_coverage"), F.lit(0.0)) <= 0, "composite has no covered pixels inside the configured AOI"),
    )
    problems = F.array_compact(F.array(*[F.when(test, text) for test, text in checks]))
    return joined.select(
        *keys, F.array_join(problems, "; ").alias("problems"), (F.size(problems) == 0).alias("ok")
    )
