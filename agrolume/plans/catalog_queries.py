"""Registered queries: catalogue joins, validation, upserts, keys, caches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import keys, text
from agrolume.operators import catalog, raster, validation
from agrolume.plans.registry import query
from agrolume.plans.world import World, add_table
from agrolume.sources import stac

c = F.col

# Every optical catalogue scene has one or two versions of each index raster.
_VERSIONS = "case when scene_id % 2 = 0 then 1 else 2 end"
add_table(
    "rasters",
    "catalog",
    "select c.scene_id, c.source_no, c.aoi_no, c.acq_date, c.status, r.index_name, v.version, c.acq_date + cast(v.version*3 as integer) as created_on, "
    "'derived/' || c.scene_id || '/' || r.index_name || '/' || v.version as object_path from catalog c join (values " + ", ".join(
        f"({no}, '{name}')" for no, _, _, _, family in dims.SOURCES for name in dims.INDEX_ROLES.get(family, {})
        if not (no in dims.NO_SWIR_SOURCES and name == "ndmi")
    ) + f") as r(sno, index_name) on r.sno = c.source_no, (values (1), (2)) as v(version) where v.version <= {_VERSIONS} "
    "and not (c.scene_id % 9 = 0 and r.index_name = 'msavi')",
)


def rasters(w: World) -> DataFrame:
    roles = dims.index_role_dim(w.spark).select("source_no", "index_name")
    versions = F.explode(F.sequence(F.lit(1), F.expr(_VERSIONS))).alias("version")
    return (
        w.catalog.join(roles, "source_no")
        .where(~((c("scene_id") % 9 == 0) & (c("index_name") == "msavi")))
        .select("scene_id", "source_no", "aoi_no", "acq_date", "status", "index_name", versions)
        .select(
            "*", F.date_add("acq_date", c("version") * 3).alias("created_on"),
            F.concat_ws("/", F.lit("derived"), c("scene_id"), c("index_name"), c("version")).alias("object_path"),
        )
    )


@query(
    "join_scene_raster",
    "select c.scene_id, c.product_id, r.index_name, r.version, r.object_path from catalog c join (select *, row_number() over ("
    "partition by scene_id, index_name order by created_on desc, version desc) as rn from rasters) r on r.scene_id = c.scene_id where r.rn = 1",
    tables="rasters",
)
def join_scene_raster(w: World) -> DataFrame:
    """Each scene with the latest raster of each index."""
    latest = catalog.latest_per(
        rasters(w).select("scene_id", "index_name", "created_on", "version", "object_path"),
        ["scene_id", "index_name"], ["created_on", "version"],
    )
    return w.catalog.select("scene_id", "product_id").join(latest, "scene_id").select(
        "scene_id", "product_id", "index_name", "version", "object_path"
    )


@query(
    "join_index_mask",
    "select p.scene_id, p.rw, p.cl, p.code, case when p.scene_id % 3 = 0 then x.explicit_mask else p.mask end as mask from ndvi_px p left join "
    "(select scene_id, rw, cl, cast(case when scl = 0 then 0 else 1 end as integer) as explicit_mask from pixels where source_no <= 4) x "
    "on x.scene_id = p.scene_id and x.rw = p.rw and x.cl = p.cl",
    tables="ndvi_px pixels",
)
def join_index_mask(w: World) -> DataFrame:
    """Index raster with its mask: an explicit mask raster, else the source's own."""
    cell = ["scene_id", "rw", "cl"]
    # The source's own mask comes with the index row; only scenes with an explicit raster are joined.
    index = raster.index_raster(w.pixels, "ndvi").select(*cell, "code", c("mask").alias("own"))
    explicit = w.pixels.where("source_no <= 4 and scene_id % 3 = 0").select(*cell, F.when(c("scl") == 0, 0).otherwise(1).alias("explicit_mask"))
    return index.join(explicit, cell, "left").select(*cell, "code", F.coalesce("explicit_mask", "own").alias("mask"))


@query(
    "layer_resolution",
    "select 'lyr_' || substring(sha256(object_path || ':private'), 1, 24) as layer_id, r.index_name, r.scene_id, c.product_id as item_id, "
    "case when r.version = 2 then 'custom-v2' else 'derived-v1' end as collection_id from rasters r left join (select * from catalog where status = 'accepted') c on c.scene_id = r.scene_id",
    tables="rasters",
)
def layer_resolution(w: World) -> DataFrame:
    """Tile layers resolved to their raster and, where published, their scene."""
    made = rasters(w)
    layers = made.select(keys.layer_id(c("object_path"), F.lit("private")).alias("layer_id"), "object_path")
    published = w.catalog.where("status = 'accepted'").select("scene_id", c("product_id").alias("item_id"))
    return (
        layers.join(made, "object_path")
        .join(published, "scene_id", "left")
        .select(
            "layer_id", "index_name", "scene_id", "item_id",
            F.when(c("version") == 2, "custom-v2").otherwise("derived-v1").alias("collection_id"),
        )
    )


_PROFILES = (
    "select s_suppkey as profile_key, case s_suppkey % 3 when 0 then 'ndvi' when 1 then 'msavi' else 'ndmi' end as index_name, "
    "case when s_suppkey % 5 = 0 then null else s_suppkey % 7 end as source_no, s_suppkey % 4 <> 1 as is_default, s_suppkey*37 % 101 as created_at from supplier"
)


@query(
    "join_default_profile",
    "select request_id, index_name, source_no, coalesce(own, generic) as profile_key from (select r.*, "
    f"(select arg_max(profile_key, created_at*1000000 + profile_key) from ({_PROFILES}) p where is_default and p.index_name = r.index_name and p.source_no = r.source_no) as own, "
    f"(select arg_max(profile_key, created_at*1000000 + profile_key) from ({_PROFILES}) p where is_default and p.index_name = r.index_name and p.source_no is null) as generic "
    "from (select request_id, source_no, case request_id % 4 when 0 then 'ndvi' when 1 then 'msavi' when 2 then 'ndmi' else 'ndwi' end as index_name from requests) r) s",
    tables="requests",
)
def join_default_profile(w: World) -> DataFrame:
    profiles = w.table("supplier").selectExpr(
        "s_suppkey as profile_key",
        "case s_suppkey % 3 when 0 then 'ndvi' when 1 then 'msavi' else 'ndmi' end as index_name",
        "case when s_suppkey % 5 = 0 then null else s_suppkey % 7 end as source_no",
        "s_suppkey % 4 <> 1 as is_default", "s_suppkey*37 % 101 as created_at",
    )
    asked = w.requests.selectExpr(
        "request_id", "source_no",
        "case request_id % 4 when 0 then 'ndvi' when 1 then 'msavi' when 2 then 'ndmi' else 'ndwi' end as index_name",
    )
    return catalog.default_profile(asked, profiles).select("request_id", "index_name", "source_no", "profile_key")


@query(
    "active_routes",
    "select s_suppkey as route_no, s_suppkey % 7 as source_no, s_nationkey as priority from supplier "
    "where case s_suppkey % 4 when 0 then 'active' when 1 then 'manual_only' when 2 then 'retired' else 'blocked' end in ('manual_only', 'active') order by 2, 3, 1",
)
def active_routes(w: World) -> DataFrame:
    """Routes that may be used, by source and priority."""
    routes = w.table("supplier").selectExpr(
        "s_suppkey as route_no", "s_suppkey % 7 as source_no", "s_nationkey as priority",
        "case s_suppkey % 4 when 0 then 'active' when 1 then 'manual_only' when 2 then 'retired' else 'blocked' end as status",
    )
    return routes.where(c("status").isin("manual_only", "active")).orderBy("source_no", "priority", "route_no").drop("status")


add_table(
    "complete",
    "rasters catalog",
    "select c.scene_id, c.source_no, c.aoi_no, c.acq_date from catalog c join (select scene_id, count(distinct index_name) as have from rasters group by scene_id) r "
    "on r.scene_id = c.scene_id where c.status = 'accepted' and r.have = case c.source_no when 0 then 6 when 3 then 3 else 4 end",
)


def completed(w: World) -> DataFrame:
    return catalog.complete_scenes(
        w.catalog, rasters(w), dims.index_role_dim(w.spark), published=c("status") == "accepted"
    )


@query("complete_scenes", "select scene_id, source_no from complete", tables="complete")
def complete_scenes(w: World) -> DataFrame:
    return completed(w).select("scene_id", "source_no")


@query(
    "latest_processed_date",
    "select source_no, aoi_no, max(acq_date) as latest_date from complete group by source_no, aoi_no",
    tables="complete",
)
def latest_processed_date(w: World) -> DataFrame:
    return completed(w).groupBy("source_no", "aoi_no").agg(F.max("acq_date").alias("latest_date"))


# Fixed number of required indices per source, as rows of the profile.
_REQUIRED = {no: dims.REQUIRED_INDICES[family] for no, _, _, _, family in dims.SOURCES if family in dims.REQUIRED_INDICES}


@query(
    "dates_intersection",
    "select source_no, aoi_no, acq_date from rasters join (values " + ", ".join(f"({no}, '{name}', {len(names)})" for no, names in _REQUIRED.items() for name in names)
    + ") as q(sno, wanted, needed) on sno = source_no and wanted = index_name group by source_no, aoi_no, acq_date, needed having count(distinct index_name) = needed",
    tables="rasters",
)
def dates_intersection(w: World) -> DataFrame:
    """Dates on which every index that the source's profile requires exists, per (source, AOI)."""
    return catalog.complete_dates(rasters(w), _REQUIRED)


_MIRROR = "case when (scene_id + p) % 4 = 0 then 'pending' else 'mirrored' end"
add_table(
    "assets",
    "catalog",
    f"select c.scene_id, k.asset_key, case when k.asset_key = 'analytic' then case when scene_id % 3 = 0 then 'raw' else 'prepared' end else 'source' end as asset_kind, "
    f"{_MIRROR} as mirror_status, case when (scene_id + p) % 5 = 0 then null else 'mirror/' || scene_id || '/' || asset_key end as mirror_path "
    "from catalog c, (values (0, 'red'), (1, 'green'), (2, 'blue'), (3, 'analytic')) as k(p, asset_key)",
)


def assets(w: World) -> DataFrame:
    listed = F.posexplode(F.array(*[F.lit(k) for k in ("red", "green", "blue", "analytic")])).alias("p", "asset_key")
    return w.catalog.select("scene_id", listed).selectExpr(
        "scene_id", "asset_key",
        "case when asset_key = 'analytic' then case when scene_id % 3 = 0 then 'raw' else 'prepared' end else 'source' end as asset_kind",
        f"{_MIRROR} as mirror_status",
        "case when (scene_id + p) % 5 = 0 then null else concat('mirror/', scene_id, '/', asset_key) end as mirror_path",
    )


@query(
    "display_assets",
    "select scene_id, case when count(case when asset_key in ('red','green','blue') and mirror_status = 'mirrored' and mirror_path is not null then 1 end) = 3 then 'red,green,blue' "
    "when count(case when asset_key = 'analytic' and asset_kind in ('analytic', 'prepared') then 1 end) > 0 then 'analytic' end as display from assets group by scene_id",
    tables="assets",
)
def display_assets(w: World) -> DataFrame:
    return catalog.display_assets(assets(w))


# --- validation ------------------------------------------------------------------


@query(
    "composite_provenance_filter",
    "select scene_id, case when scene_id % 4 = 0 or scene_id % 4 = 1 then true when scene_id % 12 = 2 then false when scene_id % 6 = 3 then false else true end as accepted from catalog",
    tables="catalog",
)
def composite_provenance_filter(w: World) -> DataFrame:
    """Composites whose contributors agree with the published date."""
    k = c("scene_id")
    # k%4: 0 not a composite, 1 no detail, 2 and 3 two contributors.
    day = c("acq_date").cast("string")
    second = F.when(k % 6 == 3, F.date_sub("acq_date", 5).cast("string")).otherwise(day)
    rows = w.catalog.select(
        "scene_id",
        (k % 4 != 0).alias("composite"),
        F.when(k % 12 != 2, c("acq_date")).alias("acquired"),
        F.when(k % 4 == 1, F.array().cast("array<string>")).otherwise(F.array(day, second)).alias("days"),
    )
    return rows.select("scene_id", catalog.provenance_ok(c("composite"), c("acquired"), c("days")).alias("accepted"))


# Landsat items with a fault of each kind; the assets of an item and their values, by the same expressions in both engines.
_LANDSAT = {
    "item_key": "o_orderkey",
    "product_id": "concat(case when o_orderkey % 11 = 0 then 'LE07' when o_orderkey % 2 = 0 then 'LC08' else 'LC09' end, '_L2', case when o_custkey % 3 = 0 then 'SR' else 'SP' end, "
    "'_146039_20240105_02_', case when o_orderkey % 13 = 0 then 'T2' else 'T1' end)",
    "platform": "case when o_orderkey % 17 = 0 then 'landsat-7' when (o_orderkey + o_custkey % 19 * 0) % 2 = 0 or o_custkey % 19 = 0 then 'landsat-8' else 'LANDSAT-9' end",
    "collection_number": "case o_custkey % 7 when 0 then null when 1 then '2' when 2 then '01' else '02' end",
    "category": "case o_orderkey % 5 when 0 then null when 1 then 't1' when 2 then 'RT' else 'T1' end",
    "correction": "case when o_orderkey % 3 = 0 then null else 'l2sp' end",
}
_LANDSAT_ASSETS = ("blue", "green", "red", "nir08", "swir16", "qa_pixel", "qa_radsat")
_ASSET_FACTS = {
    "common_name": "case when (item_key + p) % 23 = 0 then 'pan' else k end",
    "scale": "case when (item_key + p) % 19 = 0 then null when (item_key + p) % 29 = 0 then 0.0001 else 0.0000275 end",
    "offset": "case when (item_key + p) % 31 = 0 then 0.0 else -0.2 end",
    "nodata": "case when (item_key + p) % 37 = 0 then 1.0 else 0.0 end",
    "resolution": "case when (item_key + p) % 41 = 0 then 60.0 else 30.0 end",
    "media_type": "case when (item_key + p) % 43 = 0 then 'image/tiff' else 'image/tiff; profile=cloud-optimized' end",
}
add_table("landsat_items", "", "select " + ", ".join(f"{sql} as {n}" for n, sql in _LANDSAT.items()) + " from orders")
add_table(
    "landsat_assets",
    "landsat_items",
    "select item_key, p, k, " + ", ".join(f'{sql} as "{n}"' for n, sql in _ASSET_FACTS.items())
    + " from landsat_items, (values " + ", ".join(f"({p}, '{k}')" for p, k in enumerate(_LANDSAT_ASSETS)) + ") as a(p, k) where (item_key * 7 + p) % 53 <> 0",
)
_FLAWS = (
    ("invalid common name", "p < 5 and common_name <> k"), ("invalid scale", "p < 5 and (scale is null or scale = 0.0001)"), ("invalid offset", 'p < 5 and "offset" = 0'),
    ("invalid nodata", "p < 5 and nodata = 1"), ("not 30 m", "resolution = 60"), ("not a cloud optimized GeoTIFF", "media_type = 'image/tiff'"),
)
_LANDSAT_SQL = (
    "select item_key, 'landsat' as profile, concat_ws('; ', case when lower(platform) = 'landsat-7' then 'unsupported platform' end, "
    "case when not fits then 'product id is not collection 2 tier 1 level 2' end, "
    "case when fits and lower(platform) <> 'landsat-7' and right(lower(platform), 1) <> substring(product_id, 4, 1) then 'product id conflicts with platform' end, "
    "case when collection_number = '01' then 'not collection 2' end, case when category = 'RT' then 'not category T1' end, "
    "case when fits and correction is not null and product_id like '%L2SR%' then 'product id conflicts with correction' end, "
    "case when n < 7 then 'missing assets: ' || array_to_string(list_sort(list_filter(['blue','green','red','nir08','swir16','qa_pixel','qa_radsat'], lambda x: not list_contains(ks, x))), ', ') end, "
    + ", ".join(f"'{reason}: ' || f{k}" for k, (reason, _) in enumerate(_FLAWS))
    + ") as problems from (select *, product_id like 'LC0%T1' as fits from landsat_items) i join (select item_key as a_key, count(*) as n, list(k) as ks, "
    + ", ".join(f"string_agg(k, ', ' order by k) filter (where {test}) as f{k}" for k, (_, test) in enumerate(_FLAWS)) + " from landsat_assets group by item_key) a on a_key = item_key"
)


def landsat_items(w: World) -> DataFrame:
    items = w.table("orders").selectExpr(*[f"{sql} as {n}" for n, sql in _LANDSAT.items()])
    facts = ", ".join(f"'{n}', {sql if 'name' in n or 'media' in n else f'cast({sql} as double)'}" for n, sql in _ASSET_FACTS.items())
    listed = "array(" + ", ".join(f"struct({p} as p, '{k}' as k)" for p, k in enumerate(_LANDSAT_ASSETS)) + ")"
    facts = facts.replace("+ p)", "+ x.p)").replace("else k end", "else x.k end")
    return items.withColumn("assets", F.expr(f"transform(filter({listed}, x -> (item_key * 7 + x.p) % 53 <> 0), x -> named_struct('key', x.k, {facts}))"))


@query(
    "validate_scene_items",
    "select item_key, 'sentinel' as profile, concat_ws('; ', case when missing <> '' then 'missing required assets: ' || missing end, case when item_key % 5 = 0 then 'missing raster scale: nir' end) as problems "
    "from (select item_key, concat_ws(', ', 'green', case when item_key % 7 = 0 then 'scl' end) as missing from item_json) s union all " + _LANDSAT_SQL,
    tables="item_json landsat_items landsat_assets",
)
def validate_scene_items(w: World) -> DataFrame:
    """All reasons against each item, by the rules of its profile."""
    required = ("red", "green", "nir", "scl")
    bands = F.filter(F.map_entries("i.assets"), lambda e: (e["key"] != "scl") & F.get(e["value"]["raster:bands"], F.lit(0))["scale"].isNull())
    found = catalog.item_problems(required, F.map_keys("i.assets"), F.transform(bands, lambda e: e["key"]))
    sentinel = stac.parse_items(w.item_json).select("item_key", F.lit("sentinel").alias("profile"), F.array_join(found, "; ").alias("problems"))
    landsat = landsat_items(w).select("item_key", F.lit("landsat").alias("profile"), F.array_join(validation.problems(validation.landsat_rules()), "; ").alias("problems"))
    return sentinel.unionByName(landsat)


@query(
    "missing_assets",
    "select item_key, concat_ws(',', 'green', case when item_key % 7 = 0 then 'scl' end) as missing from item_json",
    tables="item_json",
)
def missing_assets(w: World) -> DataFrame:
    required = F.array(*[F.lit(k) for k in ("green", "nir", "red", "scl")])
    return stac.parse_items(w.item_json).select(
        "item_key", F.array_join(F.array_except(required, F.map_keys("i.assets")), ",").alias("missing")
    )


# KEY=VALUE metadata of each radar product; declared polarizations by number, from one to four, with faults.
_SAR_DECLARED = {
    "ProductType": "case when product_no % 23 = 0 then 'L1-SLC' else 'l2b-ard-product ' end",
    "SatID": "sat_id", "Sensor": "case when product_no % 29 = 0 then 'OPT' else sensor end", "ImagingMode": "imaging_mode", "RTC_Apply_Flag": "rtc_flag",
    "Missing_Frames_Flag": "case when product_no % 31 = 0 then '1' else '0' end",
    "NoOfPolarizations": "case product_no % 37 when 0 then 'two' when 1 then '5' when 2 then '3' else '2' end",
    "TxRxPol1": "case when product_no % 41 = 0 then 'XX' else 'HH' end", "TxRxPol2": "case when product_no % 43 = 0 then 'hh' else 'HV' end",
    "IncidenceAngle": "incidence", "OutputPixelSpacing": "spacing",
}


@query(
    "validate_sar_metadata",
    "select product_no, concat_ws(',', " + ", ".join(
        f"case when upper(trim({_SAR_DECLARED[key]})) <> '{expected}' then '{key}' end" for key, expected in validation.EOS04_DECLARED.items()
    )
    + ", case when product_no % 37 in (0, 1) then 'NoOfPolarizations' end, case when (product_no % 41 = 0 and product_no % 37 <> 0) or product_no % 37 in (1, 2) then 'TxRxPol unknown' end, "
    "case when (product_no % 43 = 0 and product_no % 41 <> 0 and product_no % 37 <> 0) or product_no % 37 = 1 then 'TxRxPol repeated' end, "
    "case when try_cast(incidence as double) is null then 'IncidenceAngle' end, case when try_cast(spacing as double) is null then 'OutputPixelSpacing' end) as problems from sar_meta",
    tables="sar_meta",
)
def validate_sar_metadata(w: World) -> DataFrame:
    """Facts of a radar product that break its expected profile, from its key-value metadata."""
    metadata = F.create_map(*[x for key, sql in _SAR_DECLARED.items() for x in (F.lit(key), F.expr(sql))])
    found = validation.problems(validation.eos04_rules(metadata))
    return w.sar_meta.select("product_no", F.array_join(found, ",").alias("problems"))


@query(
    "source_registry",
    "select source_no, family, count(*) as scenes, count(cloud_percent) as with_cloud from (select source_no, case source_no when 0 then 's2' when 1 then 'landsat' else 'resourcesat' end as family, "
    "cloud_percent from catalog where source_no <= 4 union all select source_no, 'sar', null from catalog where source_no >= 5) s group by source_no, family",
    tables="catalog",
)
def source_registry(w: World) -> DataFrame:
    """Optical and radar scene lists, with different columns, as one registry."""
    optical = w.catalog.where("source_no <= 4").select(
        "source_no", "scene_id", "cloud_percent",
        F.when(c("source_no") == 0, "s2").when(c("source_no") == 1, "landsat").otherwise("resourcesat").alias("family"),
    )
    radar = w.catalog.where("source_no >= 5").select("source_no", "scene_id", F.lit("sar").alias("family"))
    both = optical.unionByName(radar, allowMissingColumns=True)
    return both.groupBy("source_no", "family").agg(
        F.count("*").alias("scenes"), F.count("cloud_percent").alias("with_cloud")
    )


# --- upserts ---------------------------------------------------------------------

# Existing rows have keys k, incoming rows 2k: about half of them replace a row.
_SCENE_ROWS = (
    "select o_orderkey*{m} as product_no, 'earthsearch' as provider, {v} as version, o_orderkey*10 + {v} as scene_id, "
    "{v}*1000 + o_custkey as created_no, case when {v} = 1 then o_orderstatus else 'A' end as status, cast(o_custkey % 50 + {v} as double) as cloud_percent from orders"
)


def _scene_rows(w: World, m: int, v: int) -> DataFrame:
    return w.table("orders").selectExpr(
        f"o_orderkey*{m} as product_no", "'earthsearch' as provider", f"{v} as version", f"o_orderkey*10 + {v} as scene_id",
        f"{v}*1000 + o_custkey as created_no", f"case when {v} = 1 then o_orderstatus else 'A' end as status",
        f"cast(o_custkey % 50 + {v} as double) as cloud_percent",
    )


@query(
    "upsert_scenes",
    "select provider, product_no, arg_min(scene_id, version) as scene_id, arg_min(created_no, version) as created_no, max(version) as version, "
    f"arg_max(status, version) as status, arg_max(cloud_percent, version) as cloud_percent from ({_SCENE_ROWS.format(m=1, v=1)} union all {_SCENE_ROWS.format(m=2, v=2)}) s group by provider, product_no",
)
def upsert_scenes(w: World) -> DataFrame:
    """Scenes by (provider, product): id and creation stay, the rest is replaced."""
    return catalog.upsert(
        _scene_rows(w, 1, 1), _scene_rows(w, 2, 2), keys=["provider", "product_no"],
        version="version", keep_first=["scene_id", "created_no"],
    )


_ASSET_ROWS = (
    "select o_orderkey*{m} as scene_no, case when o_orderkey % 2 = 0 then 'red' else 'nir' end as asset_key, 'h{v}/' || o_orderkey as href, "
    "case when o_orderkey % 3 = 0 then null else o_orderkey + {v} end as size_bytes, case when o_orderkey % {p} = 0 then 'pending' else 'mirrored' end as mirror_status, "
    "case when o_orderkey % {p} = 0 then null else 'm{v}/' || o_orderkey end as mirror_path, case when o_orderkey % {p} = 0 then null else md5('{v}' || o_orderkey) end as mirror_checksum from orders"
)


def _asset_rows(w: World, m: int, v: int, p: int) -> DataFrame:
    return w.table("orders").selectExpr(
        f"o_orderkey*{m} as scene_no", "case when o_orderkey % 2 = 0 then 'red' else 'nir' end as asset_key",
        f"concat('h{v}/', o_orderkey) as href", f"case when o_orderkey % 3 = 0 then null else o_orderkey + {v} end as size_bytes",
        f"case when o_orderkey % {p} = 0 then 'pending' else 'mirrored' end as mirror_status",
        f"case when o_orderkey % {p} = 0 then null else concat('m{v}/', o_orderkey) end as mirror_path",
        f"case when o_orderkey % {p} = 0 then null else md5(concat('{v}', o_orderkey)) end as mirror_checksum",
    )


@query(
    "upsert_assets",
    "select coalesce(n.scene_no, o.scene_no) as scene_no, coalesce(n.asset_key, o.asset_key) as asset_key, coalesce(n.href, o.href) as href, coalesce(n.size_bytes, o.size_bytes) as size_bytes, "
    "case when n.scene_no is null or (n.mirror_path is null and o.mirror_path is not null) then o.mirror_status else n.mirror_status end as mirror_status, "
    "coalesce(n.mirror_path, o.mirror_path) as mirror_path, coalesce(n.mirror_checksum, o.mirror_checksum) as mirror_checksum from "
    f"({_ASSET_ROWS.format(m=1, v=1, p=5)}) o full join ({_ASSET_ROWS.format(m=2, v=2, p=4)}) n on n.scene_no = o.scene_no and n.asset_key = o.asset_key",
)
def upsert_assets(w: World) -> DataFrame:
    return catalog.upsert_assets(_asset_rows(w, 1, 1, 5), _asset_rows(w, 2, 2, 4), keys=["scene_no", "asset_key"])


_IDENTITY = ["scene_no", "output_kind", "index_name", "formula_version", "profile_version", "resolution_m"]


def _raster_rows_sql(m: int, v: int) -> str:
    return (
        f"select o_orderkey*{m} as scene_no, 'derived_index' as output_kind, case when o_orderkey % 2 = 0 then 'ndvi' else 'msavi' end as index_name, "
        f"'f' || cast(o_orderkey % 2 as varchar(4)) as formula_version, 'p1' as profile_version, case when o_orderkey % 3 = 0 then 10e0 else 20e0 end as resolution_m, "
        f"{v} as version, o_orderkey*10 + {v} as raster_id, 'path{v}/' || cast(o_orderkey as varchar(20)) as object_path from orders"
    )


@query(
    "upsert_rasters",
    f"select {', '.join(_IDENTITY)}, arg_min(raster_id, version) as raster_id, max(version) as version, arg_max(object_path, version) as object_path "
    f"from ({_raster_rows_sql(1, 1)} union all {_raster_rows_sql(2, 2)}) s group by {', '.join(_IDENTITY)}",
)
def upsert_rasters(w: World) -> DataFrame:
    """Derived rasters by their six-part identity."""

    def rows(m: int, v: int) -> DataFrame:
        return w.table("orders").selectExpr(
            f"o_orderkey*{m} as scene_no", "'derived_index' as output_kind",
            "case when o_orderkey % 2 = 0 then 'ndvi' else 'msavi' end as index_name",
            "concat('f', o_orderkey % 2) as formula_version", "'p1' as profile_version",
            "case when o_orderkey % 3 = 0 then 10e0 else 20e0 end as resolution_m",
            f"{v} as version", f"o_orderkey*10 + {v} as raster_id", f"concat('path{v}/', o_orderkey) as object_path",
        )

    return catalog.upsert(rows(1, 1), rows(2, 2), keys=_IDENTITY, version="version", keep_first=["raster_id"])


@query(
    "dedupe_jobs",
    "select request_id, key_hash, coalesce(job, request_id) as job_id, failed or job = request_id as created from (select r.*, min(case when not failed then request_id end) over "
    "(partition by key_hash) as job from (select event_id as request_id, md5(concat(cast(user_id as varchar(20)), ':', event_type)) as key_hash, event_id % 10 = 0 as failed from events) r) s",
)
def dedupe_jobs(w: World) -> DataFrame:
    """Create-or-get: one active job per key, failed jobs free the key."""
    asked = w.table("events").selectExpr(
        "event_id as request_id", "md5(concat(user_id, ':', event_type)) as key_hash", "event_id % 10 = 0 as failed"
    )
    return catalog.create_or_get_jobs(asked)


# --- keys and ids ------------------------------------------------------------------

_KEY_TEXT = {
    "source_id": "concat('src-', cast(o_custkey % 7 as varchar(20)))",
    "provider_route": "concat('route:', cast(o_custkey % 5 as varchar(20)))",
    "aoi_id": "concat('aoi-', cast(o_custkey % 3 as varchar(20)))",
    "date_start": "substring(cast(o_orderdate as varchar(30)), 1, 10)",
    "date_end": "substring(cast(o_orderdate as varchar(30)), 1, 10)",
    "job_type": "'sync'",
    "mode": "case when o_orderkey % 2 = 0 then 'full_pipeline' else 'metadata_only' end",
    "stac_item_id": "concat('S', cast(o_orderkey as varchar(20)))",
    "logical_scene_key": "concat('c:S', cast(o_orderkey as varchar(20)))",
    "asset_key": "'red'",
    "index_name": "'ndvi'",
    "formula_version": "'ndvi-s2-v1'",
    "product_id": "concat('P', cast(o_orderkey as varchar(20)))",
    "raw_checksum_sha256": "md5(cast(o_orderkey as varchar(20)))",
    "composite_date": "substring(cast(o_orderdate as varchar(30)), 1, 10)",
    "product_ids": "concat('P', cast(o_orderkey as varchar(20)), ',Q')",
    "scene_or_composite_id": "concat('C', cast(o_orderkey as varchar(20)))",
    "request_params_version": "'v1'",
    "processing_profile_version": "'p1'",
}


def _family_sql(family: str) -> str:
    job_type, names = keys.KEY_FAMILIES[family]
    values = {n: _KEY_TEXT[n] for n in (*names, *keys.VERSION_FIELDS)}
    if job_type is not None:
        values["job_type"] = f"'{job_type}'"
    body = " || ',' || ".join(f"'\"{n}\":\"' || {values[n]} || '\"'" for n in sorted(values))
    return f"select o_orderkey as k, '{family}' as family, sha256('{{' || {body} || '}}') as key_hash from orders"


@query("idempotency_keys", " union all ".join(_family_sql(f) for f in keys.KEY_FAMILIES))
def idempotency_keys(w: World) -> DataFrame:
    """All key families of every order, one row each."""
    fields = {name: F.expr(expr) for name, expr in _KEY_TEXT.items()}
    entries = F.array(*[
        F.struct(F.lit(f).alias("family"), keys.idempotency_key(f, fields).alias("key_hash")) for f in keys.KEY_FAMILIES
    ])
    return w.table("orders").select(c("o_orderkey").alias("k"), F.inline(entries))


@query(
    "deterministic_ids",
    "select scene_id, 'lyr_' || substring(sha256(cast(scene_id as varchar) || ':private'), 1, 24) as layer_id, 's2-l2a-T' || aoi_no || '-' || strftime(acq_date, '%Y%m%dT000000') || '-' || "
    "substring(sha256(product_id), 1, 12) as item_id, 'derived/earthsearch/s2/' || product_id || '/ndvi.parquet' as object_path from catalog",
    tables="catalog",
)
def deterministic_ids(w: World) -> DataFrame:
    from agrolume.sources.pixels import derived_path

    return w.catalog.select(
        "scene_id",
        keys.layer_id(c("scene_id").cast("string"), F.lit("private")).alias("layer_id"),
        keys.derived_item_id(
            F.lit("s2-l2a"), F.concat(F.lit("T"), c("aoi_no")), c("acq_date").cast("timestamp"), c("product_id")
        ).alias("item_id"),
        derived_path(F.lit("earthsearch"), F.lit("s2"), c("product_id"), F.lit("ndvi")).alias("object_path"),
    )


# --- caches and integrity ------------------------------------------------------------

_NOW = "2024-01-20 00:00:00"
_CACHED = (
    "select event_id as query_id, user_id as scene_no, md5(event_type) as geometry_hash, 'v1' as analysis_version, ts as created_at, "
    "case when event_id % 6 = 0 then null else ts + interval 3 day end as expires_at from events"
)


def cached(w: World) -> DataFrame:
    return w.table("events").selectExpr(
        "event_id as query_id", "user_id as scene_no", "md5(event_type) as geometry_hash", "'v1' as analysis_version",
        "ts as created_at", "case when event_id % 6 = 0 then null else ts + interval 3 day end as expires_at",
    )


@query(
    "cache_lookup",
    "select r.request_id, arg_max(k.query_id, k.created_at) as query_id from (select o_orderkey as request_id, o_custkey % 200 as scene_no, "
    "md5(case o_orderkey % 3 when 0 then 'click' when 1 then 'view' else 'none' end) as geometry_hash from orders) r left join "
    f"({_CACHED}) k on k.scene_no = r.scene_no and k.geometry_hash = r.geometry_hash and (k.expires_at is null or k.expires_at > timestamp '{_NOW}') group by r.request_id",
)
def cache_lookup(w: World) -> DataFrame:
    asked = w.table("orders").selectExpr(
        "o_orderkey as request_id", "o_custkey % 200 as scene_no",
        "md5(case o_orderkey % 3 when 0 then 'click' when 1 then 'view' else 'none' end) as geometry_hash", "'v1' as analysis_version",
    )
    found = catalog.cache_lookup(
        asked, cached(w), keys=["scene_no", "geometry_hash", "analysis_version"], now=F.lit(_NOW).cast("timestamp_ntz")
    )
    return found.select("request_id", "query_id")


@query(
    "cache_expire",
    f"select query_id from ({_CACHED}) k where query_id not in (select query_id from ({_CACHED}) e where expires_at <= timestamp '{_NOW}')",
)
def cache_expire(w: World) -> DataFrame:
    """The cache after a purge of all its expired rows."""
    return catalog.purge(cached(w), now=F.lit(_NOW).cast("timestamp_ntz")).select("query_id")


@query(
    "integrity_check",
    "select k, case when k % 7 = 0 then 'size_mismatch' when k % 4 = 3 and k % 3 = 0 then 'unchecked' when k % 5 = 0 then 'checksum_mismatch' else 'verified' end as outcome "
    "from (select o_orderkey as k from orders) s",
)
def integrity_check(w: World) -> DataFrame:
    """Downloads against their declared size and checksum header."""
    body = F.concat(F.lit("body"), c("k"))
    declared = F.when(c("k") % 5 == 0, F.concat(body, F.lit("x"))).otherwise(body)
    header = F.element_at(
        F.array(*[F.lit(h) for h in ("x-checksum-sha256", "x-checksum-md5", "x-amz-checksum-sha256", "etag")]), (c("k") % 4 + 1).cast("int")
    )
    as_base64 = F.base64(F.unhex(F.sha2(declared, 256)))
    expected = (
        F.when(c("k") % 4 == 0, F.sha2(declared, 256)).when(c("k") % 4 == 1, F.concat(F.lit('"'), F.md5(declared), F.lit('"')))
        .when(c("k") % 4 == 2, as_base64)
        .when(c("k") % 3 == 0, F.concat(F.md5(declared), F.lit("-2"))).otherwise(F.md5(declared))
    )
    rows = w.table("orders").select(c("o_orderkey").alias("k")).select(
        "k", header.alias("header"), expected.alias("expected"), F.length(body).alias("actual"),
        (F.length(body) + F.when(c("k") % 7 == 0, 1).otherwise(0)).alias("declared"),
        F.sha2(body, 256).alias("sha"), F.md5(body).alias("md"),
    )
    return rows.select(
        "k", catalog.integrity(c("declared"), c("actual"), c("header"), c("expected"), c("sha"), c("md")).alias("outcome")
    )
