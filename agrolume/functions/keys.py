"""Deterministic keys: canonical JSON, hashes, readable ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys; missing values are written as null."""
    ordered = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def key_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)


# The fields of each idempotency key family, job_type first.
KEY_FAMILIES: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "sync": (None, ("source_id", "aoi_id", "date_start", "date_end", "job_type")),
    "sentinel2_backfill": (
        "sentinel2_backfill", ("source_id", "provider_route", "aoi_id", "date_start", "date_end", "mode")),
    "sentinel2_scene": (
        "sentinel2_scene", ("source_id", "provider_route", "aoi_id", "stac_item_id", "logical_scene_key")),
    "source_asset_mirror": (
        "source_asset_mirror", ("source_id", "provider_route", "stac_item_id", "asset_key")),
    "sentinel2_index_output": (
        "sentinel2_index_output",
        ("source_id", "provider_route", "stac_item_id", "index_name", "formula_version")),
    "resourcesat_backfill": (
        "resourcesat_backfill", ("source_id", "provider_route", "aoi_id", "date_start", "date_end", "mode")),
    "resourcesat_download": ("resourcesat_download", ("source_id", "provider_route", "product_id")),
    "resourcesat_prepare": (
        "resourcesat_prepare", ("source_id", "provider_route", "product_id", "raw_checksum_sha256")),
    "resourcesat_composite": (
        "resourcesat_composite", ("source_id", "aoi_id", "composite_date", "product_ids")),
    "resourcesat_index_output": (
        "resourcesat_index_output",
        ("source_id", "provider_route", "scene_or_composite_id", "index_name", "formula_version")),
    "eos04_backfill": (
        "eos04_backfill", ("source_id", "provider_route", "aoi_id", "date_start", "date_end", "mode")),
}
VERSION_FIELDS = ("request_params_version", "processing_profile_version")


def idempotency_key(family: str, fields: dict[str, Column]) -> Column:
    """SHA-256 of the family's canonical JSON."""
    job_type, names = KEY_FAMILIES[family]
    material = {name: fields[name] for name in (*names, *VERSION_FIELDS)}
    if job_type is not None:
        material["job_type"] = F.lit(job_type)
    return key_hash(material)


def layer_id(raster_output_id: Column, visibility: Column) -> Column:
    material = F.concat_ws(":", raster_output_id, visibility)
    return F.concat(F.lit("lyr_"), F.substring(F.sha2(material, 256), 1, 24))


def product_hash(logical_key: Column) -> Column:
    return F.substring(F.sha2(logical_key, 256), 1, 12)


def derived_item_id(prefix: Column, group: Column | None, acquired: Column, logical_key: Column) -> Column:
    """``prefix[-group]-yyyyMMddTHHmmss-hash``."""
    stamp = F.coalesce(F.date_format(acquired, "yyyyMMdd'T'HHmmss"), F.lit("unknown"))
    parts = [prefix] + ([] if group is None else [F.coalesce(group, F.lit("group"))])
    return F.concat_ws("-", *parts, stamp, product_hash(logical_key))
