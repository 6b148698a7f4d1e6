"""STAC-like item JSON: normalising provider items, writing derived ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.functions import geo, text

c = F.col

_BAND = "array<struct<scale:double,offset:double,nodata:double>>"
ASSET = f"struct<href:string,type:string,roles:array<string>,gsd:double,`raster:bands`:{_BAND}>"
ITEM = (
    "struct<id:string,collection:string,bbox:array<double>,properties:struct<datetime:string,platform:string,"
    "`eo:cloud_cover`:double,`s2:mgrs_tile`:string,`grid:code`:string,`mgrs:utm_zone`:int,"
    "`mgrs:latitude_band`:string,`mgrs:grid_square`:string,`landsat:collection_category`:string>,"
    f"assets:map<string,{ASSET}>>"
)


def parsed_once(raw: DataFrame, keep: list[str], schema: str, name: str, column: str = "item") -> DataFrame:
    """JSON text -> one struct column, parsed exactly once per row.

    The one-element generator keeps later filters from being pushed below the
    parse, where Spark would repeat it for every field a filter touches.
    """
    return raw.select(*keep, F.explode(F.array(F.from_json(c(column), schema))).alias(name))


def parse_items(raw: DataFrame, column: str = "item") -> DataFrame:
    """JSON text -> one struct column ``i`` with an explicit schema."""
    return parsed_once(raw, [n for n in raw.columns if n != column], ITEM, "i", column)


def normalize_items(raw: DataFrame, *, provider: str, keep: list[str]) -> DataFrame:
    """Provider items as flat scene rows."""
    p = c("i.properties")
    return parse_items(raw).select(
        *keep,
        F.lit(provider).alias("provider_adapter"),
        c("i.collection").alias("provider_collection"),
        c("i.id").alias("stac_item_id"),
        F.concat_ws(":", c("i.collection"), c("i.id")).alias("logical_scene_key"),
        text.iso_datetime(p["datetime"]).alias("acquisition_at"),
        p["platform"].alias("platform"),
        text.mgrs_tile(
            p["s2:mgrs_tile"], p["grid:code"], p["mgrs:utm_zone"], p["mgrs:latitude_band"], p["mgrs:grid_square"]
        ).alias("mgrs_tile"),
        p["eo:cloud_cover"].alias("cloud_percent"),
        c("i.bbox").alias("bbox"),
        F.map_keys("i.assets").alias("asset_keys"),
    )


def storage_class(href: Column) -> tuple[Column, Column]:
    """(backend, access mode) of an asset link."""
    s3 = href.startswith("s3://")
    web = href.startswith("http://") | href.startswith("https://")
    return (
        F.when(s3, "s3").when(web, "https").otherwise("local"),
        F.when(s3, "requester_pays_s3").when(web, "public_https").otherwise("local"),
    )


# The platforms and the collection category of usable Landsat items.
LANDSAT_PLATFORMS = ("landsat-8", "landsat-9")
LANDSAT_CATEGORY = "T1"


def landsat_items(parsed: DataFrame) -> DataFrame:
    """The items of ``parse_items`` that are Landsat scenes of the usable category."""
    p = F.col("i.properties")
    return parsed.where(p["platform"].isin(*LANDSAT_PLATFORMS) & (p["landsat:collection_category"] == LANDSAT_CATEGORY))


def explode_assets(raw: DataFrame, *, keep: list[str], strip_query: bool = False) -> DataFrame:
    """One row per asset with scale, offset (default 0), nodata and storage.

    ``strip_query`` drops signed query strings from the links, as the Landsat
    dialect needs.
    """
    rows = parse_items(raw).select(*keep, F.explode("i.assets").alias("asset_key", "a"))
    href = F.substring_index("a.href", "?", 1) if strip_query else c("a.href")
    backend, access = storage_class(c("href"))
    if strip_query:
        backend, access = F.lit("https"), F.lit("signed_https")
    band = F.get(c("a.raster:bands"), F.lit(0))
    return rows.select(
        *keep, "asset_key", href.alias("href"), c("a.type").alias("media_type"),
        band["scale"].alias("scale"),
        F.coalesce(band["offset"], F.lit(0.0)).alias("offset"),
        band["nodata"].alias("nodata"),
    ).select("*", backend.alias("storage_backend"), access.alias("access_mode"))


# Key fallbacks of the loosely structured provider JSON, best first.
PRODUCT_KEYS = ("productId", "product_id", "ProductId", "ProductID", "productIdentifier", "identifier", "id")
DATE_KEYS = (
    "datetime", "acquisition_datetime", "acquisitionDatetime", "acquisitionDateTime", "AcquisitionDateTime",
    "acquisitionDate", "AcquisitionDate", "start_datetime", "startDateTime",
)


def _first_text(keys: tuple[str, ...], *, properties_first: bool) -> Column:
    paths = []
    for key in keys:
        top, nested = f"$.{key}", f"$.properties.{key}"
        paths += [nested, top] if properties_first else [top, nested]
    return F.coalesce(*[F.nullif(F.try_variant_get("v", path, "string"), F.lit("")) for path in paths])


def normalize_candidates(raw: DataFrame, *, keep: list[str], aoi_bbox: Column) -> DataFrame:
    """Loose provider JSON: fallback keys, repaired bbox, online flag, AOI overlap.

    The text is parsed once and the fallback chains are walked once; filters on
    the result stay above both generators.
    """
    item = raw.select(*keep, aoi_bbox.alias("aoi_bbox"), F.explode(F.array(F.parse_json("item"))).alias("v"))
    box = F.coalesce(
        *[F.try_variant_get(c("v"), p, "array<double>") for p in ("$.bbox", "$.properties.bbox", "$.properties.BoundingBox")]
    )
    online = F.coalesce(*[
        F.try_variant_get(c("v"), p, "string") for p in ("$.properties.Online", "$.properties.online", "$.Online")
    ])
    fields = F.struct(
        _first_text(PRODUCT_KEYS, properties_first=False).alias("product_id"),
        _first_text(DATE_KEYS, properties_first=True).alias("acquisition_text"),
        F.upper(F.trim(F.coalesce(online, F.lit("")))).isin("Y", "YES", "TRUE", "ONLINE", "1").alias("online"),
        box.alias("raw_bbox"),
    )
    out = item.select(*keep, "aoi_bbox", F.inline(F.array(fields))).withColumn(
        "bbox", geo.normalise_bbox(c("raw_bbox"))
    )
    overlap = geo.bbox_intersection(c("bbox"), c("aoi_bbox"))
    return out.withColumn("overlap", overlap).select(
        *keep, "product_id", "acquisition_text", "online",
        c("overlap").isNotNull().alias("intersects_aoi"),
        geo.bbox_area(c("overlap")).alias("overlap_area"),
    )


def search_completeness(items: DataFrame, *, request: str, page: str, position: str, has_next: str, cap: int) -> DataFrame:
    """Per search: items and pages offered, kept items, pages read, exhausted, truncated by the item cap.

    Per-page sums come first, so a search with very many items is never one
    group of rows; a running total over its pages finds where the cap bites.
    """
    from pyspark.sql import Window

    pages = items.groupBy(request, page).agg(
        F.count("*").alias("n"), F.bool_or(has_next).alias("more")
    )
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy(request).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # The cap stops the search on the page that reaches it.
    read = c("before") < cap
    total = F.sum(F.when(read, c("n")))
    reached = total >= cap
    truncated = reached & ((total > cap) | F.max_by("more", F.when(read, c(page))))
    return pages.withColumn("before", before).groupBy(request).agg(
        F.sum("n").alias("offered"),
        F.count("*").alias("offered_pages"),
        F.least(total, F.lit(cap)).alias("items"),
        F.count_if(read).alias("pages"),
        truncated.alias("truncated"),
        (~truncated).alias("exhausted"),
    )


def asset_manifest(assets: DataFrame, *, key: str) -> DataFrame:
    """Manifest JSON per item, assets sorted by key (an item has few assets)."""
    entry = F.struct("asset_key", "href", "media_type", "scale", "offset", "nodata", "storage_backend", "access_mode")
    listed = assets.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("assets"))
    body = F.struct(F.lit("phase2-asset-manifest-v1").alias("schema_version"), c(key), "assets")
    return listed.select(key, F.size("assets").alias("asset_count"), F.to_json(body, {"ignoreNullFields": "false"}).alias("manifest"))


def derived_items(
    outputs: DataFrame, *, keys: list[str], properties: dict[str, Column], asset_key: str, href: str
) -> DataFrame:
    """Derived item JSON: properties plus one asset per output row of the scene."""
    entry = F.struct(c(asset_key).alias("key"), c(href).alias("href"))
    grouped = outputs.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    assets = F.map_from_entries(F.transform(
        "entries", lambda e: F.struct(e["key"], F.struct(e["href"].alias("href"), F.lit(COG).alias("type")))
    ))
    props = F.struct(*[value.alias(name) for name, value in properties.items()])
    body = F.struct(F.lit("Feature").alias("type"), c("item_id").alias("id"), props.alias("properties"), assets.alias("assets"))
    return grouped.select(*keys, F.size("entries").alias("asset_count"), F.to_json(body, {"ignoreNullFields": "false"}).alias("item"))


# Media type of the derived rasters.
COG = "image/tiff; application=geotiff; profile=cloud-optimized"
