"""Registered queries: item JSON, provider JSON, text metadata, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import keys, text
from agrolume.functions.rounding import r6
from agrolume.operators import raster, selection
from agrolume.functions.redaction import redact_json
from agrolume.plans.registry import query
from agrolume.plans.world import World, add_table
from agrolume.session import shared_folder
from agrolume.sources import pixels as pixel_source
from agrolume.sources import stac, textmeta

c = F.col


def _j(path: str) -> str:
    return f"json_extract_string(item, '{path}')"


_P = "$.properties."
_TILE = f"'T' || lpad({_j(_P + '\"mgrs:utm_zone\"')}, 2, '0') || {_j(_P + '\"mgrs:latitude_band\"')} || {_j(_P + '\"mgrs:grid_square\"')}"


@query(
    "stac_normalize_items",
    f"select item_key, 'earthsearch' as provider_adapter, {_j('$.collection')} as provider_collection, {_j('$.id')} as stac_item_id, "
    f"{_j('$.collection')} || ':' || {_j('$.id')} as logical_scene_key, replace(replace({_j(_P + 'datetime')}, 'T', ' '), 'Z', '') as acquired, "
    f"{_j(_P + 'platform')} as platform, {_TILE} as mgrs_tile, cast({_j(_P + '\"eo:cloud_cover\"')} as double) as cloud_percent, "
    f"cast({_j('$.bbox[0]')} as double) as west, cast({_j('$.bbox[3]')} as double) as north, "
    f"{_j('$.assets.scl.href')} is null as missing_scl from item_json",
    tables="item_json",
)
def stac_normalize_items(w: World) -> DataFrame:
    items = stac.normalize_items(w.item_json, provider="earthsearch", keep=["item_key"])
    return items.select(
        "item_key", "provider_adapter", "provider_collection", "stac_item_id", "logical_scene_key",
        F.date_format("acquisition_at", "yyyy-MM-dd HH:mm:ss").alias("acquired"), "platform", "mgrs_tile", "cloud_percent",
        c("bbox")[0].alias("west"), c("bbox")[3].alias("north"),
        (~F.array_contains("asset_keys", "scl")).alias("missing_scl"),
    )


add_table(
    "asset_rows",
    "item_json",
    "select item_key, k as asset_key, json_extract_string(item, '$.assets.' || k || '.href') as href, "
    "json_extract_string(item, '$.assets.' || k || '.type') as media_type, "
    "cast(json_extract_string(item, '$.assets.' || k || '.\"raster:bands\"[0].scale') as double) as scale, "
    "coalesce(cast(json_extract_string(item, '$.assets.' || k || '.\"raster:bands\"[0].offset') as double), 0) as \"offset\", "
    "cast(json_extract_string(item, '$.assets.' || k || '.\"raster:bands\"[0].nodata') as double) as nodata "
    "from (select item_key, item, unnest(json_keys(item, '$.assets')) as k from item_json) s",
)


@query(
    "stac_explode_assets",
    "select *, case when href like 's3://%' then 's3' else 'https' end as storage_backend, "
    "case when href like 's3://%' then 'requester_pays_s3' else 'public_https' end as access_mode from asset_rows",
    tables="asset_rows",
)
def stac_explode_assets(w: World) -> DataFrame:
    return stac.explode_assets(w.item_json, keep=["item_key"])


@query(
    "stac_normalize_landsat",
    "select item_key, asset_key, split_part(href, '?', 1) as href, scale, \"offset\", 'signed_https' as access_mode from "
    "(select a.*, i.item from asset_rows a join item_json i on i.item_key = a.item_key) s "
    f"where {_j(_P + '\"landsat:collection_category\"')} = 'T1' and {_j(_P + 'platform')} in ('landsat-8', 'landsat-9')",
    tables="asset_rows item_json",
)
def stac_normalize_landsat(w: World) -> DataFrame:
    """Landsat dialect: category and platform filters, canonical links."""
    parsed = stac.parse_items(w.item_json.withColumn("raw", c("item")))
    raw = stac.landsat_items(parsed).select("item_key", c("raw").alias("item"))
    return stac.explode_assets(raw, keep=["item_key"], strip_query=True).select(
        "item_key", "asset_key", "href", "scale", "offset", "access_mode"
    )


# Loose provider JSON: the product id, date and online flag hide under several keys.
_LOOSE = (
    "concat('{\"', case o_orderkey % 4 when 0 then 'productId' when 1 then 'ProductID' when 2 then 'identifier' else 'id' end, '\":\"B', "
    "cast(o_orderkey as varchar(20)), '\",\"properties\":{\"', case o_orderkey % 3 when 0 then 'datetime' when 1 then 'acquisitionDate' else 'startDateTime' end, "
    "'\":\"', substring(cast(o_orderdate as varchar(30)), 1, 10), '\",\"', case when o_orderkey % 2 = 0 then 'Online' else 'online' end, '\":', "
    "case o_orderkey % 5 when 0 then '\"Y\"' when 1 then 'true' when 2 then '1' when 3 then '\"N\"' else '\"online\"' end, "
    "'},\"bbox\":[', cast(o_custkey % 100 as varchar(20)), ',', cast((o_custkey*7) % 60 + 4 as varchar(20)), ',', "
    "cast(o_custkey % 100 + 5 as varchar(20)), ',', cast((o_custkey*7) % 60 as varchar(20)), ']}')"
)
add_table("loose", "", f"select o_orderkey as item_no, o_custkey, o_orderdate, {_LOOSE} as item from orders")
add_table(
    "loose_norm",
    "loose",
    "select item_no, coalesce(" + ", ".join(f"nullif({_j('$.' + k)}, ''), nullif({_j(_P + k)}, '')" for k in stac.PRODUCT_KEYS)
    + ") as product_id, coalesce(" + ", ".join(f"nullif({_j(_P + k)}, ''), nullif({_j('$.' + k)}, '')" for k in stac.DATE_KEYS)
    + f") as acquisition_text, upper(coalesce({_j(_P + 'Online')}, {_j(_P + 'online')}, '')) in ('Y', 'YES', 'TRUE', 'ONLINE', '1') as online, "
    "least(x1, 60) > greatest(x0, 20) and least(y1, 45) > greatest(y0, 10) as intersects_aoi, "
    "cast(greatest(least(x1, 60) - greatest(x0, 20), 0)*greatest(least(y1, 45) - greatest(y0, 10), 0) as double) as overlap_area from "
    f"(select *, cast({_j('$.bbox[0]')} as double) as x0, least(cast({_j('$.bbox[1]')} as double), cast({_j('$.bbox[3]')} as double)) as y0, "
    f"cast({_j('$.bbox[2]')} as double) as x1, greatest(cast({_j('$.bbox[1]')} as double), cast({_j('$.bbox[3]')} as double)) as y1 from loose) s",
)


def loose_candidates(w: World) -> DataFrame:
    raw = w.table("orders").selectExpr("o_orderkey as item_no", f"{_LOOSE} as item")
    box = F.array(*[F.lit(v) for v in (20.0, 10.0, 60.0, 45.0)])
    found = stac.normalize_candidates(raw, keep=["item_no"], aoi_bbox=box)
    # No overlap has area 0 whichever sides miss each other.
    return found.withColumn("overlap_area", F.when(c("intersects_aoi"), c("overlap_area")).otherwise(0.0))


_LOOSE_OUT = "select item_no, product_id, acquisition_text, online, intersects_aoi, case when intersects_aoi then overlap_area else 0e0 end as overlap_area from loose_norm"


@query("provider_normalize_candidates", _LOOSE_OUT, tables="loose_norm")
def provider_normalize_candidates(w: World) -> DataFrame:
    return loose_candidates(w)


@query("eligible_candidates", f"{_LOOSE_OUT} where online and intersects_aoi", tables="loose_norm")
def eligible_candidates(w: World) -> DataFrame:
    return loose_candidates(w).where("online and intersects_aoi")


@query(
    "select_downloads",
    "select source_no, item_no, product_id, rank, rank <= 3 as within_limit from (select *, item_no % 7 as source_no, row_number() over (partition by item_no % 7 "
    "order by overlap_area desc, acquisition_text desc nulls last, product_id desc) as rank from loose_norm where online and intersects_aoi) s",
    tables="loose_norm",
)
def select_downloads(w: World) -> DataFrame:
    """Downloads per source by overlap, then newest, then product id; the first three are within the limit."""
    eligible = loose_candidates(w).where("online and intersects_aoi").select(
        "*", (c("item_no") % 7).alias("source_no"), c("acquisition_text").alias("acq_date")
    )
    return selection.top_by_overlap(eligible, ["source_no"], 3, by_product=True).select(
        "source_no", "item_no", "product_id", c("rank").cast("long").alias("rank"), "within_limit"
    )


@query(
    "select_landsat",
    "select aoi_no, scene_id, rank, rank <= 5 as within_limit from (select *, row_number() over (partition by aoi_no order by -coverage_percent, coalesce(cloud_percent, 101), "
    "coalesce(platform, ''), product_id) as rank from (select *, case when scene_id % 5 = 0 then null when scene_id % 2 = 0 then 'landsat-8' else 'landsat-9' end as platform "
    "from catalog where source_no = 1) s) t",
    tables="catalog",
)
def select_landsat(w: World) -> DataFrame:
    """Landsat order (overlap, cloud, platform, id); the first five are within the limit of new scenes."""
    platform = F.expr("case when scene_id % 5 = 0 then null when scene_id % 2 = 0 then 'landsat-8' else 'landsat-9' end")
    scenes = w.catalog.where("source_no = 1").select("*", c("coverage_percent").alias("overlap_ratio"), platform.alias("platform"))
    return selection.ranked_in_bins(scenes, ["aoi_no"], selection.landsat_order(), selection.landsat_bins(), 5).select(
        "aoi_no", "scene_id", c("rank").cast("long").alias("rank"), "within_limit"
    )


@query(
    "search_completeness",
    "select request_no, n as offered, cast(ceil(n/8e0) as bigint) as offered_pages, least(n, 20) as items, cast(least(ceil(n/8e0), 3) as bigint) as pages, n > 20 as truncated, not (n > 20) as exhausted "
    "from (select o_custkey as request_no, count(*) as n from orders group by o_custkey) s",
)
def search_completeness(w: World) -> DataFrame:
    """Pages of eight items per customer search: all that is offered, and what a search with a cap of twenty items keeps."""
    from pyspark.sql import Window

    orders = w.table("orders").selectExpr("o_custkey as request_no", "o_orderkey")
    numbered = orders.withColumn(
        "p", F.row_number().over(Window.partitionBy("request_no").orderBy("o_orderkey")) - 1
    )
    totals = orders.groupBy("request_no").agg(F.count("*").alias("total"))
    items = numbered.join(totals, "request_no").select(
        "request_no", F.floor(c("p") / 8).alias("page"), c("p").alias("position"),
        ((F.floor(c("p") / 8) + 1) * 8 < c("total")).alias("has_next"),
    )
    return stac.search_completeness(
        items, request="request_no", page="page", position="position", has_next="has_next", cap=20
    )


# KEY=VALUE files: one per order, with comments, blanks and sometimes a repeated key.
_LINES = (
    "concat('# header'), concat('SatID = EOS-04 // platform'), concat('SceneNumber=', cast(o_custkey as varchar(20))), '', "
    "case when o_orderkey % 6 = 0 then 'SatID=EOS-04' else 'Sensor=SAR=X' end"
)


@query(
    "band_meta_parse",
    "select file_no, key, min(value) as value, count(*) > 1 as duplicate from (select file_no, trim(split_part(l, '=', 1)) as key, "
    "trim(split_part(regexp_replace(l, '^[^=]*=', ''), '//', 1)) as value from (select o_orderkey as file_no, trim(unnest(["
    f"{_LINES}])) as l from orders) s where l <> '' and l not like '#%' and l like '%=%') t group by file_no, key",
)
def band_meta_parse(w: World) -> DataFrame:
    lines = w.table("orders").selectExpr("o_orderkey as file_no", f"explode(array({_LINES})) as line")
    return textmeta.parse_key_values(lines, file="file_no", line="line")


_FC = (
    "concat('{\"bbox\":[0,0,', cast(c_custkey % 50 + 10 as varchar(20)), ',9],\"features\":[{\"id\":\"sample_field_', cast(c_custkey as varchar(20)), "
    "'\",\"properties\":{\"role\":\"', case c_custkey % 3 when 0 then 'sample_field' when 1 then 'aoi_polygon' else 'centre_point' end, "
    "'\"},\"geometry\":{\"type\":\"', case when c_custkey % 4 = 0 then 'MultiPolygon\",\"coordinates\":[[[[5,5],[6,5],[6,6],[5,5]]],' else 'Polygon\",\"coordinates\":' end, "
    "'[[[0,0],[', cast(c_custkey % 9 + 1 as varchar(20)), ',0],[1,1],[0,0]]]', case when c_custkey % 4 = 0 then ']}' else '}' end, "
    "case when c_custkey % 2 = 0 then ',\"bbox\":[1,2,3,4]' else '' end, '}]}')"
)


@query(
    "aoi_load_geojson",
    "select c_custkey as doc_no, 'sample_field_' || c_custkey as aoi_id, 'Sample Field ' || c_custkey as name, case when c_custkey % 4 = 0 then 'MultiPolygon' else 'Polygon' end as geometry_type, "
    "case when c_custkey % 2 = 0 then 3e0 else c_custkey % 50 + 10e0 end as east, case when c_custkey % 4 = 0 then 8 else 4 end as vertices from customer where c_custkey % 3 <> 2",
)
def aoi_load_geojson(w: World) -> DataFrame:
    from agrolume.functions import polygons as poly

    docs = w.table("customer").selectExpr("c_custkey as doc_no", f"{_FC} as doc")
    areas = textmeta.load_features(docs, key="doc_no", column="doc")
    return areas.select(
        "doc_no", "aoi_id", "name", "geometry_type", c("bbox")[2].alias("east"), poly.vertex_count(c("geometry")).alias("vertices")
    )


@query(
    "asset_manifest",
    "select item_key, cast(count(*) as integer) as asset_count, '{\"schema_version\":\"phase2-asset-manifest-v1\",\"item_key\":' || item_key || ',\"assets\":[' || "
    "string_agg('{\"asset_key\":\"' || asset_key || '\",\"href\":\"' || href || '\",\"media_type\":\"image/tiff\",\"scale\":' || case when scale is null then 'null' else '1.0E-4' end "
    "|| ',\"offset\":' || case when \"offset\" = 0 then '0.0' else '-0.1' end || ',\"nodata\":' || case when nodata is null then 'null' else '0.0' end "
    "|| ',\"storage_backend\":\"' || case when href like 's3://%' then 's3' else 'https' end || '\",\"access_mode\":\"' || "
    "case when href like 's3://%' then 'requester_pays_s3' else 'public_https' end || '\"}', ',' order by asset_key) || ']}' as manifest from asset_rows group by item_key",
    tables="asset_rows",
)
def asset_manifest(w: World) -> DataFrame:
    return stac.asset_manifest(stac.explode_assets(w.item_json, keep=["item_key"]), key="item_key")


# --- derived items ------------------------------------------------------------

_COG = stac.COG
add_table(
    "outputs",
    "scenes",
    "select s.scene_id, s.source_no, s.acq_date, s.product_id, s.cloud_percent, s.site, r.index_name, 'derived/' || s.product_id || '/' || r.index_name || '.tif' as href "
    "from scenes s join (values " + ", ".join(
        f"({no}, '{name}')" for no, _, _, _, family in dims.SOURCES for name in dims.INDEX_ROLES.get(family, {})
        if not (no in dims.NO_SWIR_SOURCES and name == "ndmi")
    ) + ") as r(sno, index_name) on r.sno = s.source_no where s.status = 'accepted'",
)


def outputs(w: World) -> DataFrame:
    """Raster outputs registered for the accepted optical scenes."""
    roles = dims.index_role_dim(w.spark).select("source_no", "index_name")
    return w.scenes.where("status = 'accepted'").join(roles, "source_no").select(
        "scene_id", "source_no", "acq_date", "product_id", "cloud_percent", "site", "index_name",
        F.concat(F.lit("derived/"), "product_id", F.lit("/"), "index_name", F.lit(".tif")).alias("href"),
    )


def _assets_sql() -> str:
    return (
        "string_agg('\"' || index_name || '\":{\"href\":\"' || href || '\",\"type\":\"" + _COG + "\"}', ',' order by index_name)"
    )


_STAMP = "strftime(acq_date, '%Y%m%dT000000')"
_HASH12 = "substring(sha256(product_id), 1, 12)"
_S2_ID = f"'s2-l2a-T' || site || '-' || {_STAMP} || '-' || {_HASH12}"
_OPTICAL = (
    "select scene_id, cast(count(*) as integer) as asset_count, '{{\"type\":\"Feature\",\"id\":\"' || {id} || '\",\"properties\":{{{props}}},\"assets\":{{' || "
    + _assets_sql().replace("{", "{{").replace("}", "}}") + " || '}}}}' as item from outputs where {where} group by scene_id, site, acq_date, product_id, cloud_percent, source_no"
)


@query(
    "stac_build_optical_items",
    _OPTICAL.format(
        id=f"case when source_no = 0 then {_S2_ID} else 'rs2a-' || case source_no when 2 then 'liss3-boa' when 3 then 'liss4-mx70-l2' else 'awifs-boa' end || '-a' || site || '-' || {_STAMP} || '-' || {_HASH12} end",
        props="\"source_no\":' || source_no || ',\"logical_scene_key\":\"' || product_id || '\",\"cloud_cover\":' || coalesce(cast(cast(cloud_percent as bigint) as varchar) || '.0', 'null') || '",
        where="source_no in (0, 2, 3, 4)",
    ),
    tables="outputs",
)
def stac_build_optical_items(w: World) -> DataFrame:
    stamp = c("acq_date").cast("timestamp")
    s2 = keys.derived_item_id(F.lit("s2-l2a"), F.concat(F.lit("T"), c("site")), stamp, c("product_id"))
    slug = F.when(c("source_no") == 2, "rs2a-liss3-boa").when(c("source_no") == 3, "rs2a-liss4-mx70-l2").otherwise("rs2a-awifs-boa")
    rs = keys.derived_item_id(slug, F.concat(F.lit("a"), c("site")), stamp, c("product_id"))
    rows = outputs(w).where("source_no in (0, 2, 3, 4)").withColumn("item_id", F.when(c("source_no") == 0, s2).otherwise(rs))
    built = stac.derived_items(
        rows, keys=["scene_id", "source_no", "product_id", "cloud_percent", "item_id"],
        properties={"source_no": c("source_no"), "logical_scene_key": c("product_id"), "cloud_cover": c("cloud_percent")},
        asset_key="index_name", href="href",
    )
    return built.select("scene_id", "asset_count", "item")


@query(
    "stac_build_landsat_items",
    _OPTICAL.format(
        id=f"'landsat-c2-l2-' || lower(product_id) || '-' || {_HASH12}",
        props="\"platform\":\"landsat-8\",\"landsat:collection_category\":\"T1\",\"cloud_cover\":' || coalesce(cast(cast(cloud_percent as bigint) as varchar) || '.0', 'null') || '",
        where="source_no = 1",
    ).replace("from outputs", "from (select * from outputs where source_no = 1 union all select s.scene_id, s.source_no, s.acq_date, s.product_id, s.cloud_percent, s.site, k, "
              "'prepared/' || s.product_id || '/' || k || '.tif' from (select distinct scene_id, source_no, acq_date, product_id, cloud_percent, site from outputs where source_no = 1) s, (values ('analytic'), ('mask')) as p(k)) o"),
    tables="outputs",
)
def stac_build_landsat_items(w: World) -> DataFrame:
    derived = outputs(w).where("source_no = 1")
    prepared = w.scenes.where("status = 'accepted' and source_no = 1").select(
        "scene_id", "source_no", "acq_date", "product_id", "cloud_percent", "site",
        F.explode(F.array(F.lit("analytic"), F.lit("mask"))).alias("index_name"),
    ).withColumn("href", F.concat(F.lit("prepared/"), "product_id", F.lit("/"), "index_name", F.lit(".tif")))
    item_id = F.concat(F.lit("landsat-c2-l2-"), F.lower("product_id"), F.lit("-"), keys.product_hash(c("product_id")))
    rows = derived.unionByName(prepared).withColumn("item_id", item_id)
    built = stac.derived_items(
        rows, keys=["scene_id", "product_id", "cloud_percent", "item_id"],
        properties={"platform": F.lit("landsat-8"), "landsat:collection_category": F.lit("T1"), "cloud_cover": c("cloud_percent")},
        asset_key="index_name", href="href",
    )
    return built.select("scene_id", "asset_count", "item")


@query(
    "stac_build_sar_items",
    "select scene_id, 1 as asset_count, '{\"type\":\"Feature\",\"id\":\"' || case source_no when 5 then 'eos04-sar-mrs-' else 'nisar-ssar-gcov-' end || "
    f"{_STAMP} || '-' || {_HASH12} || '\",\"properties\":{{\"platform\":\"' || case source_no when 5 then 'eos-04' else 'nisar' end || '\",\"sar:frequency_band\":\"' || "
    "case source_no when 5 then 'C' else 'S' end || '\",\"sar:polarizations\":\"HH,HV\"},\"assets\":{\"backscatter\":{\"href\":\"sar/' || product_id || '.tif\",\"type\":\""
    + _COG + "\"}}}' as item from scenes where source_no >= 5 and status = 'accepted'",
    tables="scenes",
)
def stac_build_sar_items(w: World) -> DataFrame:
    eos = c("source_no") == 5
    prefix = F.when(eos, "eos04-sar-mrs").otherwise("nisar-ssar-gcov")
    rows = w.scenes.where("source_no >= 5 and status = 'accepted'").select(
        "scene_id", "source_no", "product_id",
        keys.derived_item_id(prefix, None, c("acq_date").cast("timestamp"), c("product_id")).alias("item_id"),
        F.lit("backscatter").alias("asset_key"),
        F.concat(F.lit("sar/"), "product_id", F.lit(".tif")).alias("href"),
    )
    built = stac.derived_items(
        rows, keys=["scene_id", "source_no", "item_id"],
        properties={
            "platform": F.when(eos, "eos-04").otherwise("nisar"),
            "sar:frequency_band": F.when(eos, "C").otherwise("S"),
            "sar:polarizations": F.lit("HH,HV"),
        },
        asset_key="asset_key", href="href",
    )
    return built.select("scene_id", "asset_count", "item")


@query(
    "stac_collection_summary",
    f"select {_j('$.collection')} as collection, count(*) as items, string_agg(distinct {_j(_P + 'platform')}, ',' order by {_j(_P + 'platform')}) as platforms, "
    f"min(cast({_j('$.bbox[0]')} as double)) as west, max(cast({_j('$.bbox[2]')} as double)) as east, min(substring({_j(_P + 'datetime')}, 1, 10)) as first_day, "
    f"max(substring({_j(_P + 'datetime')}, 1, 10)) as last_day from item_json group by 1",
    tables="item_json",
)
def stac_collection_summary(w: World) -> DataFrame:
    """Extent and distinct platforms per collection (few distinct values)."""
    items = stac.normalize_items(w.item_json, provider="earthsearch", keep=["item_key"])
    return items.groupBy(c("provider_collection").alias("collection")).agg(
        F.count("*").alias("items"),
        F.array_join(F.array_sort(F.collect_set("platform")), ",").alias("platforms"),
        F.min(c("bbox")[0]).alias("west"), F.max(c("bbox")[2]).alias("east"),
        F.date_format(F.min("acquisition_at"), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max("acquisition_at"), "yyyy-MM-dd").alias("last_day"),
    )


@query(
    "write_derived_partitions",
    "select source_no, index_name, ym, count(*) as pixels, count(distinct scene_id) as scenes, count(code) as valid_pixels from codes_px group by 1, 2, 3",
    tables="codes_px",
)
def write_derived_partitions(w: World) -> DataFrame:
    """Write every index raster partitioned by source, index and month, and report what was written."""
    path = shared_folder(w.spark, "derived")
    pixel_source.write_index_partitions(w.pixels, path)
    back = w.spark.read.schema("scene_id long, source_no long, index_name string, ym long, code long").parquet(path)
    scenes = back.groupBy("source_no", "index_name", "ym", "scene_id").agg(F.count("*").alias("n"), F.count("code").alias("valid"))
    return scenes.groupBy("source_no", "index_name", "ym").agg(
        F.sum("n").alias("pixels"), F.count("*").alias("scenes"), F.sum("valid").alias("valid_pixels")
    )


# --- redaction and scalars ------------------------------------------------------


@query(
    "redact_text",
    "select k, regexp_replace(regexp_replace(txt, '(?i)((?:Bearer|Basic|Token)\\s+)[A-Za-z0-9+/=._\\-]{3,}', '\\1[REDACTED]', 'g'), "
    "'(?i)([?&](?:token|key|password|sig|signature)=)[^&\\s\"'']+', '\\1[REDACTED]', 'g') as txt from log_text",
    tables="log_text",
)
def redact_text(w: World) -> DataFrame:
    return w.log_text.select("k", text.redact_text(c("txt")).alias("txt"))


@query(
    "redact_url",
    "select k, case k % 4 when 0 then 'https://h.example/p' || k || '?sig=[REDACTED]&x=' || k || '&X-Amz-Date=[REDACTED]' "
    "when 1 then 'https://h.example/p' || k || '?next=/a?b=' || k || '&sig=[REDACTED]' "
    "when 2 then 'https://h.example/p' || k || '?%73ig=[REDACTED]&&y=#sig=' || k else 'https://h.example/p' || k || '#a?sig=' || k end as url from log_text",
    tables="log_text",
)
def redact_url(w: World) -> DataFrame:
    base = F.concat(F.lit("https://h.example/p"), c("k"))
    url = (
        F.when(c("k") % 4 == 0, F.concat(base, F.lit("?sig=ab"), c("k"), F.lit("&x="), c("k"), F.lit("&X-Amz-Date=2020"), c("k")))
        .when(c("k") % 4 == 1, F.concat(base, F.lit("?next=/a?b="), c("k"), F.lit("&sig=s"), c("k")))
        .when(c("k") % 4 == 2, F.concat(base, F.lit("?%73ig=s"), c("k"), F.lit("&&y=#sig="), c("k")))
        .otherwise(F.concat(base, F.lit("#a?sig="), c("k")))
    )
    return w.log_text.select("k", text.redact_url(url).alias("url"))


@query(
    "redact_metadata",
    "select k, 'k' || k as name, '[REDACTED]' as my_token, '[REDACTED]' as download, case when k % 2 = 0 then 'Bearer [REDACTED]' else 'plain ' || k end as note, "
    "'{\"id\":' || k || ',\"parts\":[{\"access_token\":\"[REDACTED]\",\"note\":\"' || case when k % 2 = 0 then 'Bearer [REDACTED]' else 'plain ' || k end || '\"},[\"https://h.example/p?sig=[REDACTED]&x=' || k "
    "|| '\",null,true]],\"inner\":{\"providerHref\":\"[REDACTED]\",\"deep\":{\"x-goog-id\":\"[REDACTED]\",\"n\":1.5}}}' as document from log_text",
    tables="log_text",
)
def redact_metadata(w: World) -> DataFrame:
    """Flat string maps, and JSON documents with maps in lists in maps."""
    note = F.when(c("k") % 2 == 0, F.concat(F.lit("Bearer abc"), c("k"))).otherwise(F.concat(F.lit("plain "), c("k")))
    metadata = F.create_map(
        F.lit("name"), F.concat(F.lit("k"), c("k")), F.lit("my_token"), F.concat(F.lit("s"), c("k")),
        F.lit("Download-URL"), c("txt"), F.lit("note"), note,
    )
    document = F.format_string(
        '{"id": %d, "parts": [{"access_token": ["s", %d], "note": "%s"}, ["https://h.example/p?sig=s&x=%d", null, true]], '
        '"inner": {"providerHref": {"u": "s"}, "deep": {"x-goog-id": "s%d", "n": 1.5}}}', c("k"), c("k"), note, c("k"), c("k"),
    )
    return w.log_text.select("k", text.redact_map(metadata).alias("m"), redact_json(document).alias("document")).select(
        "k", c("m")["name"].alias("name"), c("m")["my_token"].alias("my_token"), c("m")["Download-URL"].alias("download"), c("m")["note"].alias("note"), "document"
    )


@query(
    "mgrs_tile",
    f"select item_key, {_TILE} as tile from item_json",
    tables="item_json",
)
def mgrs_tile(w: World) -> DataFrame:
    return stac.normalize_items(w.item_json, provider="earthsearch", keep=["item_key"]).select("item_key", c("mgrs_tile").alias("tile"))


@query(
    "safe_component",
    "select k, case when length(c) > 48 then rtrim(substring(c, 1, 35), '.-') || '-' || substring(sha256(v), 1, 12) when c = '' then 'resourcesat-output' else c end as component "
    "from (select k, v, trim(regexp_replace(v, '[^A-Za-z0-9_.=-]+', '-', 'g'), '.-') as c from (select k, case when k % 10 = 0 then '//' else txt end as v from log_text) s) t",
    tables="log_text",
)
def safe_component(w: World) -> DataFrame:
    value = F.when(c("k") % 10 == 0, "//").otherwise(c("txt"))
    return w.log_text.select("k", text.safe_component(value).alias("component"))


_FILES = (
    "concat('prod/', cast(o_orderkey as varchar(20)), '/a_Band-2.tif'), concat('prod/', cast(o_orderkey as varchar(20)), '/b_BAND3.TIF'), "
    "concat('prod/', cast(o_orderkey as varchar(20)), '/B_band_4', case when o_orderkey % 5 = 0 then '.txt' else '.tiff' end), "
    "concat('prod/', cast(o_orderkey as varchar(20)), '/z_band2.tif')"
)


@query(
    "match_band_files",
    "select product_no, b.band, min(path) as path from (select o_orderkey as product_no, unnest([" + _FILES + "]) as path from orders) f, "
    "(values ('BAND2'), ('BAND3'), ('BAND4')) as b(band) where lower(path) similar to '.*\\.tiff?' and "
    "contains(regexp_replace(upper(regexp_replace(split_part(path, '/', -1), '\\.[^.]*$', '')), '[^A-Z0-9]+', '', 'g'), b.band) group by product_no, b.band",
)
def match_band_files(w: World) -> DataFrame:
    files = w.table("orders").selectExpr("o_orderkey as product_no", "'liss4' as profile", f"explode(array({_FILES})) as path")
    bands = {"liss4": ("BAND2", "BAND3", "BAND4")}
    return textmeta.match_band_files(files, bands, product="product_no")


@query(
    "classify_errors",
    "select event_id, case when last_error is null then null when code = 429 then 'SOURCE_RATE_LIMITED' when code >= 500 then 'PROVIDER_SLA_UNAVAILABLE' else 'STAC_SEARCH_FAILED' end as category, "
    "coalesce(code = 429 or code >= 500, false) as retryable, case event_id % 4 when 0 then 'insufficient_headroom' when 1 then 'lock_failed' when 2 then 'approved_runtime_required' else 'unknown' end as label "
    "from (select *, cast(regexp_extract(last_error, '[0-9]+') as integer) as code from (select *, case when last_error = '' then null else last_error end from ledger_events) l) s",
    tables="ledger_events",
)
def classify_errors(w: World) -> DataFrame:
    code = F.regexp_extract("last_error", "[0-9]+", 0).try_cast("int")
    message = F.element_at(
        F.array(*[F.lit(m) for m in ("low disk", "Lock busy", "not an approved runtime root", "other")]),
        (c("event_id") % 4 + 1).cast("int"),
    )
    category = F.when(c("last_error").isNotNull(), text.error_category(code))
    return w.ledger_events.select(
        "event_id", category.alias("category"),
        F.coalesce(category.isin(*text.RETRYABLE), F.lit(False)).alias("retryable"),
        text.failure_label(message).alias("label"),
    )
