"""Registered queries: pixel maths, masks and rendering tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import bands, indices, masks, render, sar
from agrolume.functions.rounding import r6
from agrolume.operators import raster
from agrolume.plans.registry import query
from agrolume.plans.world import World, add_table
from agrolume.sources import pixels as pixel_source

c = F.col

# --- oracle building blocks ------------------------------------------------

_LANDSAT_CLASS = (
    "case when qa_pixel & 1 <> 0 or qa_radsat & 2174 <> 0 then 0 when qa_pixel & 14 <> 0 then 2 "
    "when qa_pixel & 16 <> 0 then 3 when qa_pixel & 32 <> 0 then 5 when qa_pixel & 128 <> 0 then 4 else 1 end"
)
_RS_SWIR = (
    "case when green_dn = 0 or red_dn = 0 or nir_dn = 0 or swir_dn = 0 then 0 "
    "when 5*(green_dn - nir_dn) >= green_dn + nir_dn and nir_dn <= 2000 then 4 "
    "when nir_dn <= 800 and swir_dn <= 800 and red_dn <= 800 then 3 "
    "when green_dn + red_dn + nir_dn >= 9600 and swir_dn >= 2000 then 2 else 1 end"
)
_RS_NO_SWIR = (
    "case when green_dn = 0 or red_dn = 0 or nir_dn = 0 then 0 "
    "when 5*(green_dn - nir_dn) >= green_dn + nir_dn and nir_dn <= 2000 then 4 "
    "when green_dn + red_dn + nir_dn >= 9600 and 5*(nir_dn - red_dn) <= nir_dn + red_dn then 2 "
    "when green_dn <= 800 and red_dn <= 800 and nir_dn <= 800 then 3 else 1 end"
)
_MASK = (
    f"case when source_no = 0 then scl when source_no = 1 then {_LANDSAT_CLASS} "
    f"when source_no = 3 then {_RS_NO_SWIR} else {_RS_SWIR} end"
)


def _refl(band: str) -> str:
    return (
        f"case source_no when 0 then case when scl in (4,5,6) then {band}_dn*1e-4 + -1e-1 end "
        f"when 1 then case when {band}_dn <> 0 then {band}_dn*2.75e-5 + -2e-1 end "
        f"else {band}_dn*1e-4 end as {band}"
    )


add_table(
    "optical",
    "pixels",
    "select scene_id, grid_no, source_no, ym, rw, cl, "
    + ", ".join(_refl(b) for b in bands.BANDS)
    + f", cast({_MASK} as integer) as mask from pixels where source_no <= 4",
)
_ROLES = ", ".join(
    f"({source_no}, '{name}', '{dims.ROLE_COLUMNS[first]}', '{dims.ROLE_COLUMNS[second]}')"
    for source_no, _, _, _, family in dims.SOURCES
    for name, (first, second) in dims.INDEX_ROLES.get(family, {}).items()
    if not (source_no in dims.NO_SWIR_SOURCES and name == "ndmi")
)
_PICK = " ".join(f"when '{b}' then {b}" for b in bands.BANDS)
_ND = "case when abs(a+b) > 1e-6 then (a-b)/(a+b) end"
_MSAVI = (
    "case when (a*2e0+1e0)*(a*2e0+1e0) - (a-b)*8e0 >= 0 then "
    "((a*2e0+1e0) - sqrt((a*2e0+1e0)*(a*2e0+1e0) - (a-b)*8e0))*5e-1 end"
)
_RECI = "case when b > 1e-4 then a/b - 1e0 end"
_USABLE = "(source_no = 0 and mask in (4,5,6)) or (source_no between 1 and 4 and mask in (1,4))"
_CODE = "cast(round_even(least(greatest(v, -1e0), 1e0)*10000e0, 0) as smallint)"

add_table(
    "index_px",
    "optical",
    "select scene_id, grid_no, source_no, ym, rw, cl, mask, index_name, "
    f"case when index_name = 'msavi' then {_MSAVI} when index_name = 'reci' then {_RECI} else {_ND} end as v "
    f"from (select o.*, r.index_name, case when {_USABLE} then case first_band {_PICK} end end as a, "
    f"case when {_USABLE} then case second_band {_PICK} end end as b "
    f"from optical o join (values {_ROLES}) as r(sno, index_name, first_band, second_band) on r.sno = o.source_no) s",
)
add_table(
    "ndvi_px",
    "optical",
    f"select scene_id, grid_no, source_no, ym, rw, cl, mask, case when v is null then -32768 else {_CODE} end as code from ("
    f"select *, {_ND} as v from (select *, case when {_USABLE} then nir end as a, "
    f"case when {_USABLE} then red end as b from optical) s) t",
)

# Every index in its own integer scale, NULL for nodata.
_LONG_CODE = (
    f"case when v is null then null when index_name = 'reci' then cast(round_even(cast(cast(v as float) as double)*{dims.RECI_SCALE}e0, 0) as bigint) "
    f"else cast({_CODE} as bigint) end"
)
INDEX_UNIT = f"(case when index_name = 'reci' then {dims.RECI_SCALE}e0 else {dims.INDEX_SCALE}e0 end)"
add_table("codes_px", "index_px", f"select * exclude (v), {_LONG_CODE} as code from index_px")

# --- scans -----------------------------------------------------------------


@query(
    "scan_pixels_window",
    "select scene_id, rw, cl, red_dn, nir_dn from pixels "
    "where source_no = 0 and ym between 23952 and 23975 and rw between 0 and 100000 and cl >= 84",
    tables="pixels",
)
def scan_pixels_window(w: World) -> DataFrame:
    return pixel_source.scan_window(
        w.pixels, source_no=0, ym=(23952, 23975), rows=(0, 100000), cols=(84, None),
        columns=["scene_id", "rw", "cl", "red_dn", "nir_dn"],
    )


@query(
    "raster_summary",
    "select scene_id, index_name, case when index_name = 'reci' then 'float32' else 'int16' end as dtype, count(code) as valid_count, "
    f"min(code)/{INDEX_UNIT} as min_value, max(code)/{INDEX_UNIT} as max_value from codes_px group by scene_id, index_name",
    tables="codes_px",
)
def raster_summary(w: World) -> DataFrame:
    return raster.summary(raster.by_index(raster.coded(w.pixels)), keys=["scene_id"])


@query(
    "overview_pyramid",
    "select l.level, p.scene_id, index_name, cast(floor(rw/pow(2,l.level)) as bigint) as rw, cast(floor(cl/pow(2,l.level)) as bigint) as cl, "
    f"case when count(code) > 0 then sum(code)/(count(code)*{INDEX_UNIT}) end as mean_value, "
    "cast(arg_min(mask, rw*1000000 + cl) as integer) as mask "
    "from codes_px p cross join (values (1),(2),(3)) as l(level) group by 1,2,3,4,5",
    tables="codes_px",
)
def overview_pyramid(w: World) -> DataFrame:
    return raster.overview_pyramid(raster.coded(w.pixels), levels=(1, 2, 3))


# --- reflectance -----------------------------------------------------------


@query(
    "reflectance_s2",
    "select scene_id, rw, cl, round(case when scl in (4,5,6) then red_dn*1e-4 + -1e-1 end, 6) as red, "
    "round(case when scl in (4,5,6) then nir_dn*1e-4 + -1e-1 end, 6) as nir from pixels where source_no = 0",
    tables="pixels",
)
def reflectance_s2(w: World) -> DataFrame:
    valid = masks.scl_valid(c("scl"))
    return w.pixels.where("source_no = 0").select(
        "scene_id", "rw", "cl",
        r6(bands.reflectance_s2(c("red_dn"), valid)).alias("red"),
        r6(bands.reflectance_s2(c("nir_dn"), valid)).alias("nir"),
    )


@query(
    "reflectance_landsat",
    "select scene_id, rw, cl, round(case when red_dn <> 0 then red_dn*2.75e-5 + -2e-1 end, 8) as red, "
    "round(case when nir_dn <> 0 then nir_dn*2.75e-5 + -2e-1 end, 8) as nir from pixels where source_no = 1",
    tables="pixels",
)
def reflectance_landsat(w: World) -> DataFrame:
    return w.pixels.where("source_no = 1").select(
        "scene_id", "rw", "cl",
        F.round(bands.reflectance_landsat(c("red_dn")), 8).alias("red"),
        F.round(bands.reflectance_landsat(c("nir_dn")), 8).alias("nir"),
    )


@query(
    "reflectance_resourcesat",
    "select scene_id, rw, cl, round(green_dn*1e-4, 6) as green, round(nir_dn*1e-4, 6) as nir "
    "from pixels where source_no in (2,3,4)",
    tables="pixels",
)
def reflectance_resourcesat(w: World) -> DataFrame:
    return w.pixels.where("source_no in (2,3,4)").select(
        "scene_id", "rw", "cl",
        r6(bands.reflectance_resourcesat(c("green_dn"))).alias("green"),
        r6(bands.reflectance_resourcesat(c("nir_dn"))).alias("nir"),
    )


# --- indices ---------------------------------------------------------------


@query(
    "index_normalized_difference",
    "select scene_id, rw, cl, round(v, 6) as ndvi from "
    f"(select scene_id, rw, cl, {_ND} as v from (select *, nir as a, red as b from optical) s) t",
    tables="optical",
)
def index_normalized_difference(w: World) -> DataFrame:
    return raster.optical(w.pixels).select(
        "scene_id", "rw", "cl", r6(indices.normalized_difference(c("nir"), c("red"))).alias("ndvi")
    )


@query(
    "index_msavi",
    f"select scene_id, rw, cl, round({_MSAVI}, 6) as msavi from (select *, nir as a, red as b from optical) s",
    tables="optical",
)
def index_msavi(w: World) -> DataFrame:
    return raster.optical(w.pixels).select(
        "scene_id", "rw", "cl", r6(indices.msavi(c("nir"), c("red"))).alias("msavi")
    )


@query(
    "index_reci",
    f"select scene_id, rw, cl, round({_RECI}, 6) as reci "
    "from (select *, nir as a, rededge as b from optical where source_no = 0) s",
    tables="optical",
)
def index_reci(w: World) -> DataFrame:
    return raster.optical(w.pixels).where("source_no = 0").select(
        "scene_id", "rw", "cl", r6(indices.reci(c("nir"), c("rededge"))).alias("reci")
    )


@query(
    "index_all_sources",
    "select source_no, scene_id, index_name, count(*) as pixels, count(v) as valid_pixels, "
    "round(min(v), 6) as min_value, round(max(v), 6) as max_value from index_px group by all",
    tables="index_px",
)
def index_all_sources(w: World) -> DataFrame:
    long = raster.all_indices(w.pixels)
    return long.groupBy("source_no", "scene_id", "index_name").agg(
        F.count("*").alias("pixels"),
        F.count("value").alias("valid_pixels"),
        r6(F.min("value")).alias("min_value"),
        r6(F.max("value")).alias("max_value"),
    )


@query(
    "index_encode",
    "select scene_id, rw, cl, index_name, "
    f"case when index_name = 'reci' then null when v is null then -32768 else {_CODE} end as code, "
    "case when index_name = 'reci' then round(cast(coalesce(cast(v as float), -9999) as double), 4) end as reci_value "
    "from index_px",
    tables="index_px",
)
def index_encode(w: World) -> DataFrame:
    is_reci = c("index_name") == "reci"
    return raster.all_indices(w.pixels).select(
        "scene_id", "rw", "cl", "index_name",
        F.when(~is_reci, indices.encode(c("value"))).alias("code"),
        F.when(is_reci, F.round(indices.encode_reci(c("value")).cast("double"), 4)).alias("reci_value"),
    )


@query(
    "index_decode",
    "select scene_id, rw, cl, nullif(code, -32768)/10000e0 as ndvi from ndvi_px",
    tables="ndvi_px",
)
def index_decode(w: World) -> DataFrame:
    return raster.index_raster(w.pixels, "ndvi").select(
        "scene_id", "rw", "cl", indices.decode(c("code")).alias("ndvi")
    )


@query(
    "custom_index",
    "select scene_id, count(v) as valid_pixels, round(max(v), 6) as max_value from "
    "(select scene_id, case when a + b + 0.5e0 > 1e-6 then (a-b)*1.5e0/(a+b+0.5e0) end as v "
    "from (select *, nir as a, red as b from optical) s) t group by scene_id",
    tables="optical",
)
def custom_index(w: World) -> DataFrame:
    """A user's own formula (soil-adjusted difference) registered by name."""
    indices.register_index(
        "savi_half", lambda a, b: F.when(a + b + 0.5 > 1e-6, (a - b) * 1.5 / (a + b + 0.5))
    )
    value = indices.index_value("savi_half", c("nir"), c("red"))
    return (
        raster.optical(w.pixels)
        .select("scene_id", value.alias("v"))
        .groupBy("scene_id")
        .agg(F.count("v").alias("valid_pixels"), r6(F.max("v")).alias("max_value"))
    )


# --- masks -----------------------------------------------------------------


@query(
    "mask_scl",
    "select scene_id, rw, cl, scl in (4,5,6) as valid from pixels where source_no = 0",
    tables="pixels",
)
def mask_scl(w: World) -> DataFrame:
    return w.pixels.where("source_no = 0").select(
        "scene_id", "rw", "cl", masks.scl_valid(c("scl")).alias("valid")
    )


@query(
    "mask_landsat_qa",
    f"select scene_id, rw, cl, {_LANDSAT_CLASS} as mask from pixels where source_no = 1",
    tables="pixels",
)
def mask_landsat_qa(w: World) -> DataFrame:
    return w.pixels.where("source_no = 1").select(
        "scene_id", "rw", "cl", masks.landsat_class(c("qa_pixel"), c("qa_radsat")).alias("mask")
    )


@query(
    "mask_landsat_valid",
    f"select scene_id, rw, cl, ({_LANDSAT_CLASS}) in (1,4) and nir_dn <> 0 and red_dn <> 0 as valid "
    "from pixels where source_no = 1",
    tables="pixels",
)
def mask_landsat_valid(w: World) -> DataFrame:
    mask = masks.landsat_class(c("qa_pixel"), c("qa_radsat"))
    both = (
        bands.reflectance_landsat(c("nir_dn")).isNotNull()
        & bands.reflectance_landsat(c("red_dn")).isNotNull()
    )
    return w.pixels.where("source_no = 1").select(
        "scene_id", "rw", "cl", (masks.clear_or_water(mask) & both).alias("valid")
    )


@query(
    "mask_threshold_resourcesat",
    f"select scene_id, rw, cl, case when source_no = 3 then {_RS_NO_SWIR} else {_RS_SWIR} end as mask "
    "from pixels where source_no in (2,3,4)",
    tables="pixels",
)
def mask_threshold_resourcesat(w: World) -> DataFrame:
    return w.pixels.where("source_no in (2,3,4)").select(
        "scene_id", "rw", "cl", masks.source_mask().alias("mask")
    )


@query(
    "mask_resourcesat_valid",
    "select scene_id, rw, cl, mask in (1,4) as valid from optical where source_no >= 2",
    tables="optical",
)
def mask_resourcesat_valid(w: World) -> DataFrame:
    return raster.optical(w.pixels).where("source_no >= 2").select(
        "scene_id", "rw", "cl", masks.clear_or_water(c("mask")).alias("valid")
    )


@query(
    "mask_policy_flags",
    "select scene_id, count(*) as pixels, "
    f"count(case when {_USABLE} then 1 end) as usable, "
    "count(case when (source_no = 0 and mask in (8,9,10)) or (source_no = 1 and mask in (2,5)) "
    "or (source_no >= 2 and mask = 2) then 1 end) as cloud, "
    "count(case when mask = 3 then 1 end) as shadow, count(case when mask = 0 then 1 end) as nodata "
    "from optical group by scene_id",
    tables="optical",
)
def mask_policy_flags(w: World) -> DataFrame:
    """Class policy as a data dimension: a broadcast-sized equi-join."""
    policy = dims.mask_policy_dim(w.spark)
    flagged = raster.optical(w.pixels).join(policy, "source_no")

    def hits(column: str) -> F.Column:
        return F.count_if(F.array_contains(c(column), c("mask")))

    return flagged.groupBy("scene_id").agg(
        F.count("*").alias("pixels"),
        hits("usable_classes").alias("usable"),
        hits("cloud_classes").alias("cloud"),
        hits("shadow_classes").alias("shadow"),
        hits("nodata_classes").alias("nodata"),
    )


# --- radar -----------------------------------------------------------------

_GAMMA0 = "case when {0}_dn*{0}_dn - noise > 0 then 10e0*log10({0}_dn*{0}_dn - noise) - calibration_db end"
_POWER = "case when {0}_dn > 0 then 10e0*log10({0}_dn*1e-3) end"
_DB = (
    "case when source_no = 6 and valid_mask between 1 and subswaths then round(" + _POWER + ", 6) "
    "when source_no <> 6 and valid_mask = 128 then round(" + _GAMMA0 + ", 6) end as {0}"
)
add_table(
    "sar_px",
    "pixels_sar",
    f"select scene_id, grid_no, source_no, ym, rw, cl, valid_mask, {_DB.format('hh')}, {_DB.format('hv')} from pixels_sar",
)


@query(
    "sar_gamma0_db",
    f"select scene_id, rw, cl, round({_GAMMA0.format('hh')}, 4) as hh_db, round({_GAMMA0.format('hv')}, 4) as hv_db from pixels_sar where source_no = 5",
    tables="pixels_sar",
)
def sar_gamma0_db(w: World) -> DataFrame:
    return w.pixels_sar.where("source_no = 5").select(
        "scene_id", "rw", "cl",
        *[F.round(sar.gamma0_db(c(f"{b}_dn"), c("noise"), c("calibration_db")), 4).alias(f"{b}_db") for b in ("hh", "hv")],
    )


@query(
    "sar_power_db",
    "select scene_id, rw, cl, round(case when hh_dn > 0 then 10e0*log10(hh_dn*1e-3) end, 4) as hh_db "
    "from pixels_sar where source_no = 6",
    tables="pixels_sar",
)
def sar_power_db(w: World) -> DataFrame:
    return w.pixels_sar.where("source_no = 6").select(
        "scene_id", "rw", "cl", F.round(sar.power_db(c("hh_dn") * 1e-3), 4).alias("hh_db")
    )


@query(
    "sar_valid_counts",
    "select scene_id, count(hh) as hh_valid, count(hv) as hv_valid from sar_px "
    "group by scene_id having count(hh) > 0 and count(hv) > 0",
    tables="sar_px",
)
def sar_valid_counts(w: World) -> DataFrame:
    """Valid pixels per polarization; scenes with an empty band are rejected."""
    return (
        raster.backscatter(w.pixels_sar)
        .groupBy("scene_id")
        .agg(F.count("hh").alias("hh_valid"), F.count("hv").alias("hv_valid"))
        .where("hh_valid > 0 and hv_valid > 0")
    )


# --- rendering tables ------------------------------------------------------

_COLOUR = "case " + " ".join(
    f"when v < {upper} then '{code}'" for _, upper, code in dims.NDVI_COLOURS[:-1]
) + f" when v is not null then '{dims.NDVI_COLOURS[-1][2]}' end"


@query(
    "render_ndvi_classes",
    f"select scene_id, rw, cl, {_COLOUR} as colour from "
    "(select scene_id, rw, cl, nullif(code, -32768)/10000e0 as v from ndvi_px) s",
    tables="ndvi_px",
)
def render_ndvi_classes(w: World) -> DataFrame:
    value = indices.decode(c("code"))
    return raster.index_raster(w.pixels, "ndvi").select(
        "scene_id", "rw", "cl", render.ndvi_colour(value).alias("colour")
    )


_CONTRAST = "case " + " ".join(
    f"when v < lo + {n}e0*(hi-lo)/5e0 then '{dims.CONTRAST_COLOURS[n - 1]}'" for n in range(1, 6)
) + f" when v is not null then '{dims.CONTRAST_COLOURS[5]}' end"


@query(
    "render_contrast_profile",
    "select p.scene_id, p.rw, p.cl, case when lo is not null and lo <> hi then 'contrast' else 'standard' end as applied, "
    "case when lo is null then 'missing_statistics' when lo = hi then 'constant_scene' end as fallback_reason, "
    f"case when lo <> hi then {_CONTRAST} end as colour from "
    "(select scene_id, rw, cl, nullif(code, -32768)/10000e0 as v from ndvi_px) p join "
    "(select scene_id, min(nullif(code, -32768))/10000e0 as lo, max(nullif(code, -32768))/10000e0 as hi "
    "from ndvi_px group by scene_id) s on s.scene_id = p.scene_id",
    tables="ndvi_px",
)
def render_contrast_profile(w: World) -> DataFrame:
    codes = raster.index_raster(w.pixels, "ndvi")
    value = indices.decode(c("code"))
    summary = codes.groupBy("scene_id").agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))
    low, high = c("min_value"), c("max_value")
    applied, reason = render.contrast_profile(F.lit("ndvi"), low, high)
    return codes.join(summary, "scene_id").select(
        "scene_id", "rw", "cl",
        applied.alias("applied"),
        reason.alias("fallback_reason"),
        F.when(reason.isNull(), render.contrast_colour(value, low, high)).alias("colour"),
    )


@query(
    "render_gray_ramp",
    "select scene_id, rw, cl, cast(round_even(least(greatest((hh - -25e0)/30e0, 0e0), 1e0)*255e0, 0) as integer) as gray "
    "from sar_px where hh is not null",
    tables="sar_px",
)
def render_gray_ramp(w: World) -> DataFrame:
    return raster.backscatter(w.pixels_sar).where("hh is not null").select(
        "scene_id", "rw", "cl", render.gray_level(c("hh")).alias("gray")
    )
