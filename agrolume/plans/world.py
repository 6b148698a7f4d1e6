"""Domain tables derived from the driver's Parquet tables.

Each table is written once as a list of SQL expressions that mean the same in
Spark and DuckDB. ``World`` turns them into DataFrames; ``with_tables`` turns
them into common table expressions for the oracle statements. Nothing here
filters the inputs: every row of the driver tables feeds its derived table, so
the amount of imagery, fields and requests grows with the data.

Layout of the invented world: one *site* per supplier, a granule of 12 x 12
pixels with a grid of its own: the resolution of its source, the UTM zone it
lies in. Sites stand in rows of 64, and zone 43 ends in the middle of a row. One
scene per site and month, one source per site. A line item is one 2 x 2 pixel
block of its scene. Customers are fields, longitude/latitude boxes, fifteen to a
site; large ones reach granules of other resolutions or of the other zone.
Orders are catalogue scenes, STAC-like items, log lines and questions about fields.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import geo
from agrolume.operators import georef
from agrolume.plans import projection_sql
from agrolume.session import tune

SITE_SPAN = 12
SITES_PER_ROW = 64
FIELDS_PER_SITE = 15


def _alias(exprs: dict[str, str]) -> list[str]:
    return [f"{expr} as {name}" for name, expr in exprs.items()]


def _text(expr: str) -> str:
    return f"cast({expr} as varchar(20))"


# --- pixel blocks ---------------------------------------------------------

BLOCKS = {
    "scene_id": "l_suppkey*100000 + year(l_shipdate)*12 + month(l_shipdate)-1",
    "br": "(l_orderkey*31 + l_linenumber) % 6",
    "bc": "(l_partkey*17 + l_suppkey) % 6",
    "ok": "l_orderkey",
    "ln": "cast(l_linenumber as bigint)",
    "pk": "l_partkey",
    "sk": "l_suppkey",
}

_SC = "(((scene_id * 7919) % 101) * (scene_id % 2))"

PIXELS = {
    "scene_id": "scene_id",
    "grid_no": "sk",
    "source_no": "sk % 7",
    "ym": "scene_id % 100000",
    "rw": f"cast(floor(sk/{SITES_PER_ROW}) as bigint)*{SITE_SPAN} + br*2 + cast(floor(sub/2) as bigint)",
    "cl": f"(sk % {SITES_PER_ROW})*{SITE_SPAN} + bc*2 + sub % 2",
    "blue_dn": "(pk*613 + ok*7 + sub*131) % 4000",
    "green_dn": "(pk*3571 + ok*11 + sub*137) % 5000",
    "red_dn": "(sk*6151 + ok*7907 + ln + sub*139) % 5000",
    "nir_dn": "(pk*7919 + ok*104729 + sub*149) % 6000",
    "swir_dn": "(pk*4241 + sk*97 + ok + sub*151) % 5000",
    "rededge_dn": "(pk*1013 + ok*53 + sub*157) % 5000",
    "scl": (
        f"case when (ok*13 + pk*7 + ln + sub*29) % 101 < {_SC} "
        "then case when pk % 4 = 0 then 3 else 8 + pk % 3 end "
        "when (ok*17 + ln + sub*5) % 211 = 0 then 0 else 4 + pk % 3 end"
    ),
    "qa_pixel": (
        f"case when (ok*13 + pk*7 + ln + sub*29) % 101 < {_SC} then (ok*37 + pk*5) % 256 "
        "else case when pk % 5 = 0 then 128 else 64 end end"
    ),
    "qa_radsat": "case when (ok*17 + ln + sub*5) % 97 = 0 then (pk*29 + ok) % 4096 else 0 end",
}

PIXELS_SAR = {
    "scene_id": "scene_id",
    "grid_no": "grid_no",
    "source_no": "source_no",
    "ym": "ym",
    "rw": "rw",
    "cl": "cl",
    "hh_dn": "nir_dn % 2000",
    "hv_dn": "red_dn % 900",
    # EOS-04 marks valid pixels with 128, NISAR with the number of their sub-swath.
    "valid_mask": "case when scl = 0 then 0 when source_no = 6 then 1 + (scl + nir_dn) % 5 else 128 end",
    # From each product's own metadata.
    "noise": "cast(10 + scene_id % 5 as double)",
    "calibration_db": "cast(81 + scene_id % 4 as double)",
    "subswaths": "3 + scene_id % 2",
}

# --- scenes with pixels ---------------------------------------------------

_ACQ = (
    "make_date(cast(floor(ym/12) as int), cast(ym % 12 as int) + 1, "
    "cast(1 + (site*5 + (ym % 12 + 1)*3) % 28 as int))"
)

SCENES = {
    "scene_id": "scene_id",
    "site": "site",
    "grid_no": "site",
    "source_no": "site % 7",
    "ym": "ym",
    "acq_date": _ACQ,
    "cloud_percent": (
        "case when scene_id % 13 = 0 then null else cast((scene_id*7919) % 101 as double) end"
    ),
    "status": "case when scene_id % 17 = 0 then 'discovered' else 'accepted' end",
    "product_id": f"concat('P', {_text('(scene_id*104729) % 1000003')})",
    "x0": f"cast((site % {SITES_PER_ROW})*{SITE_SPAN} as double)",
    "y0": f"cast(cast(floor(site/{SITES_PER_ROW}) as bigint)*{SITE_SPAN} as double)",
    "heading": "cast((site*37) % 360 as double)",
    "incidence": "case when (site + ym) % 5 = 0 then 314e-1 else 30e0 end",
    "track_no": "1 + (site + cast(floor(ym/24) as bigint)) % 4",
}

# --- fields ---------------------------------------------------------------

_FSITE = f"cast(floor(c_custkey/{FIELDS_PER_SITE}) as bigint)"
_FX = f"({_FSITE} % {SITES_PER_ROW})*{SITE_SPAN} + c_custkey % 9"
_FY = f"cast(floor({_FSITE}/{SITES_PER_ROW}) as bigint)*{SITE_SPAN} + (c_custkey*3) % 8"

_RES = "case {0} % 7 " + " ".join(f"when {no} then {metres:.1f}e0" for no, _, metres, _, _ in dims.SOURCES) + " end"
# The north-west corner of a site, and degrees of longitude and latitude of about a metre.
_ALON = f"(778e-1 + ({{0}} % {SITES_PER_ROW})*625e-5)"
_ALAT = f"(17e0 + (cast(floor({{0}}/{SITES_PER_ROW}) as bigint) % 9600)*625e-5)"
_FRES = _RES.format(_FSITE)

FIELDS = {
    "field_id": "c_custkey",
    "field_name": f"concat('field_', {_text('c_custkey')})",
    "site": _FSITE,
    "x0": f"cast({_FX} as double)",
    "y0": f"cast({_FY} as double)",
    "x1": f"cast({_FX} + 4 + c_custkey % 3 as double)",
    "y1": f"cast({_FY} + 4 + c_custkey % 2 as double)",
    "lon0": f"{_ALON.format(_FSITE)} + (c_custkey % 9)*{_FRES}*95e-7",
    "lon1": f"{_ALON.format(_FSITE)} + (c_custkey % 9 + 4 + c_custkey % 3)*{_FRES}*95e-7",
    "lat0": f"{_ALAT.format(_FSITE)} - ((c_custkey*3) % 8 + 4 + c_custkey % 2)*{_FRES}*9e-6",
    "lat1": f"{_ALAT.format(_FSITE)} - ((c_custkey*3) % 8)*{_FRES}*9e-6",
}

# --- grids -----------------------------------------------------------------

GRID_CORNERS = {
    "grid_no": "s_suppkey",
    "source_no": "s_suppkey % 7",
    "res": _RES.format("s_suppkey"),
    "lon": _ALON.format("s_suppkey"),
    "lat": _ALAT.format("s_suppkey"),
    "zone": f"cast(floor(({_ALON.format('s_suppkey')} + 180)/6) + 1 as int)",
    "row0": f"cast(floor(s_suppkey/{SITES_PER_ROW}) as bigint)*{SITE_SPAN}",
    "col0": f"(s_suppkey % {SITES_PER_ROW})*{SITE_SPAN}",
}
# From the projected corner (east, north): north-up, snapped to whole pixels.
GRIDS = {
    "grid_no": "grid_no",
    "source_no": "source_no",
    "epsg": "cast(32600 + zone as bigint)",
    "a": "res",
    "b": "0e0",
    "c": "floor(east/res)*res - col0*res",
    "d": "0e0",
    "e": "-res",
    "f": "ceil(north/res)*res + row0*res",
    "row0": "row0",
    "col0": "col0",
    "height": f"cast({SITE_SPAN} as bigint)",
    "width": f"cast({SITE_SPAN} as bigint)",
}

# --- catalogue scenes, requests, items, logs (orders) ---------------------

CATALOG = {
    "scene_id": "o_orderkey",
    "source_no": "(o_orderkey*3 + o_custkey) % 7",
    "aoi_no": "cast(floor(o_custkey/150) as bigint)",
    "acq_date": "cast(o_orderdate as date)",
    "cloud_percent": (
        "case when o_orderkey % 11 = 0 then null else cast((o_orderkey*7919) % 101 as double) end"
    ),
    "status": "case when o_orderstatus = 'P' then 'discovered' else 'accepted' end",
    "product_id": f"concat('P', {_text('(o_orderkey*104729) % 1000003')})",
    "coverage_percent": "cast((o_orderkey*31) % 101 as double)",
    "x0": "cast(o_custkey % 100 as double)",
    "y0": "cast((o_custkey*7) % 60 as double)",
    "x1": "cast(o_custkey % 100 + 2 + o_orderkey % 5 as double)",
    "y1": "cast((o_custkey*7) % 60 + 2 + o_orderkey % 4 as double)",
    "created_no": "o_orderkey",
}

REQUESTS = {
    "request_id": "o_orderkey",
    "field_id": "o_custkey",
    "site": f"cast(floor(o_custkey/{FIELDS_PER_SITE}) as bigint)",
    "source_no": f"cast(floor(o_custkey/{FIELDS_PER_SITE}) as bigint) % 7",
    "aoi_no": "cast(floor(o_custkey/150) as bigint)",
    "request_date": "cast(o_orderdate as date)",
    "max_cloud": "cast(20 + o_orderkey % 3 * 20 as double)",
    # How far back a radar history goes, and how many of its passes count.
    "lookback_days": "cast(180 + o_orderkey % 3*185 as int)",
    "max_observations": "cast(8 + o_orderkey % 2*4 as int)",
    # One of the indices of the source; radar has none.
    "index_name": f"case cast(floor(o_custkey/{FIELDS_PER_SITE}) as bigint) % 7 " + " ".join(
        f"when {no} then case o_orderkey % {len(names)} " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(names)) + " end"
        for no, names in ((no, [n for n, sources in dims.INDEX_SOURCES.items() if no in sources]) for no in range(5))
    ) + " end",
}

ITEM_JSON = {
    "item_key": "o_orderkey",
    "item": (
        "concat('{\"id\":\"S', " + _text("o_orderkey") + ", '\",\"collection\":\"c', "
        + _text("o_custkey % 7")
        + ", '\",\"properties\":{\"datetime\":\"', substring(cast(o_orderdate as varchar(30)), 1, 10), "
        "'T05:', " + _text("o_orderkey % 50 + 10") + ", ':00Z\",\"platform\":\"', "
        "case o_orderkey % 6 when 0 then 'landsat-8' when 2 then 'landsat-9' when 4 then 'landsat-7' when 1 then 'sentinel-2a' else 'sentinel-2b' end, '\",\"eo:cloud_cover\":', "
        + _text("(o_orderkey*7919) % 101")
        + ", ',\"mgrs:utm_zone\":', " + _text("o_custkey % 60 + 1")
        + ", ',\"mgrs:latitude_band\":\"P\",\"mgrs:grid_square\":\"GR\",\"landsat:collection_category\":\"T', "
        + _text("1 + o_orderkey % 2")
        + ", '\"},\"bbox\":[', " + _text("o_custkey % 100") + ", ',', " + _text("(o_custkey*7) % 80")
        + ", ',', " + _text("o_custkey % 100 + 5") + ", ',', " + _text("(o_custkey*7) % 80 + 5")
        + ", '],\"assets\":{\"red\":{\"href\":\"s3://b/', " + _text("o_orderkey")
        + ", '/B04.tif?sig=', " + _text("o_custkey")
        + ", '\",\"type\":\"image/tiff\",\"raster:bands\":[{\"scale\":0.0001,\"offset\":-0.1,\"nodata\":0}]},"
        "\"nir\":{\"href\":\"https://h/', " + _text("o_orderkey")
        + ", '/B08.tif\",\"type\":\"image/tiff\"', case when o_orderkey % 5 = 0 then '' else "
        "',\"raster:bands\":[{\"scale\":0.0001}]' end, '}', case when o_orderkey % 7 = 0 then '' else "
        "',\"scl\":{\"href\":\"https://h/scl.tif\",\"type\":\"image/tiff\"}' end, '}}')"
    ),
}

_RAW_TIME = (
    "concat(lpad(cast(day(o_orderdate) as varchar(4)), 2, '0'), '-', "
    "substring('JanFebMarAprMayJunJulAugSepOctNovDec', cast((month(o_orderdate)-1)*3+1 as int), 3), '-', "
    "cast(year(o_orderdate) as varchar(4)), ' 05:', lpad(cast(o_orderkey % 60 as varchar(4)), 2, '0'), "
    "':07', case when o_orderkey % 3 = 0 then '.123456789' when o_orderkey % 3 = 1 then '.5' else '' end)"
)

SAR_META = {
    "product_no": "o_orderkey",
    "site": "cast(floor(o_custkey/15) as bigint)",
    "acq_date": "cast(o_orderdate as date)",
    "pass_type": (
        "case o_orderkey % 6 when 0 then ' ascending ' when 1 then 'DESC' when 2 then 'NA' when 3 then '' "
        "when 4 then 'A' else 'unknown' end"
    ),
    "heading": (
        "case when o_orderkey % 9 = 0 then 'N/A' when o_orderkey % 9 = 1 then '90.0' "
        "else cast((o_custkey*37) % 400 as varchar(20)) end"
    ),
    "scene_number": "case when o_orderkey % 8 = 0 then '-9999' else cast(o_custkey % 12 as varchar(20)) end",
    "sat_id": "case when o_orderkey % 17 = 0 then ' eos-04' else 'EOS-04' end",
    "sensor": "'SAR'",
    "imaging_mode": "case when o_orderkey % 13 = 0 then 'FRS' else 'mrs' end",
    "software": "concat('V', cast(1 + o_custkey % 2 as varchar(4)))",
    "rtc_flag": "case o_orderkey % 10 when 0 then '0' when 1 then 'x' else '1' end",
    "dem_correction": "case o_orderkey % 5 when 0 then 'no' when 1 then 'Y' else 'YES' end",
    "dem_source": "case when o_orderkey % 20 = 0 then 'none' else 'srtm' end",
    "orientation": "case when o_custkey % 2 = 0 then 'RIGHT' else 'left' end",
    "incidence": "case when o_orderkey % 19 = 0 then 'bad' else concat(cast(30 + o_custkey % 4 as varchar(4)), '.5') end",
    "spacing": "case when o_orderkey % 21 = 0 then '' else '18' end",
    "polarizations": "case o_custkey % 3 when 0 then 'HV, HH' when 1 then 'vv;vh xx' else 'hh' end",
    "start_time": _RAW_TIME,
    # How far back earlier products are compared with this one.
    "lookback_days": "cast(60 + o_orderkey % 3*30 as int)",
}

#: What the provider says of each EOS-04 scene, as text; mostly alike within a site, with odd ones in between.
SCENE_META = {
    "product_no": "scene_id",
    "site": "site",
    "acq_date": "acq_date",
    "pass_type": "case scene_id % 29 when 0 then 'NA' when 1 then 'DESC' else ' ascending ' end",
    "heading": "cast(cast(heading as int) as varchar(20))",
    "scene_number": "case when scene_id % 31 = 0 then '-9999' else cast(track_no as varchar(20)) end",
    "sat_id": "case when scene_id % 3 = 0 then ' eos-04' else 'EOS-04' end",
    "sensor": "'SAR'",
    "imaging_mode": "case when scene_id % 17 = 0 then 'FRS' else 'mrs' end",
    "software": "case when scene_id % 19 = 0 then 'V2' else 'v1' end",
    "rtc_flag": "case when scene_id % 37 = 0 then '0' else '1' end",
    "dem_correction": "case when scene_id % 2 = 0 then 'Y' else 'yes' end",
    "dem_source": "'srtm'",
    "orientation": "case when site % 2 = 0 then 'RIGHT' else 'left' end",
    "incidence": "cast(incidence as varchar(20))",
    "spacing": "case scene_id % 7 when 0 then '18.5' when 1 then '18.6' when 2 then '' else '18' end",
    "polarizations": "case when scene_id % 2 = 0 then 'HV, HH' else 'hh hv' end",
    "start_time": _RAW_TIME.replace("o_orderdate", "acq_date").replace("o_orderkey", "scene_id"),
}

LOG_TEXT = {
    "k": "o_orderkey",
    "txt": (
        "concat('GET https://h.example/p', " + _text("o_orderkey") + ", '?sig=ab', " + _text("o_custkey")
        + ", '&x=1 Authorization: Bearer tok', " + _text("o_orderkey") + ", '.z')"
    ),
}

# --- ledgers and jobs (events) --------------------------------------------

LEDGER_EVENTS = {
    "event_id": "event_id",
    "source_id": "event_type",
    "aoi_no": "cast(floor(user_id/3) as bigint)",
    "provider_date": "cast(ts as date)",
    "scene_count": "event_id % 9",
    "processed_count": "(event_id*5) % 9",
    "failed_count": "cast(case when event_id % 10 = 0 then 1 else 0 end as bigint)",
    "search_complete": "event_id % 7 <> 0",
    "last_error": f"case when event_id % 10 = 0 then concat('HTTP ', {_text('400 + event_id % 130')}) end",
    "heartbeat_at": "ts",
}

JOB_EVENTS = {
    "event_id": "event_id",
    "job_id": "user_id",
    "stage_name": "event_type",
    "started_at": "ts",
    "status": (
        "case when event_id % 10 = 0 then 'failed' when event_id % 10 = 1 then 'running' "
        "else 'completed' end"
    ),
    "mode_no": "event_id % 4",
    "processed_count": "event_id % 6",
    "failed_count": "cast(case when event_id % 8 = 0 then 1 else 0 end as bigint)",
}


def _select(exprs: dict[str, str], source: str) -> str:
    return f"select {', '.join(_alias(exprs))} from {source}"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "blocks": (
        (),
        "select scene_id, br, bc, ok, ln, pk, sk from (select *, row_number() over ("
        "partition by scene_id, br, bc order by ok, ln, pk, sk) as rn from ("
        + _select(BLOCKS, "lineitem") + ") s) d where rn = 1",
    ),
    "pixels": (
        ("blocks",),
        _select(PIXELS, "(select b.*, t.sub from blocks b cross join (values (0::bigint), (1::bigint), "
                "(2::bigint), (3::bigint)) as t(sub)) e"),
    ),
    "pixels_sar": (("pixels",), _select(PIXELS_SAR, "pixels where source_no in (5, 6)")),
    "scenes": (
        (),
        _select(SCENES, "(select distinct l_suppkey*100000 + year(l_shipdate)*12 + month(l_shipdate)-1 as scene_id, "
                "l_suppkey as site, year(l_shipdate)*12 + month(l_shipdate)-1 as ym from lineitem) s"),
    ),
    "fields": ((), _select(FIELDS, "customer")),
    "grids": ((), _select(GRIDS, "(" + projection_sql.utm(_select(GRID_CORNERS, "supplier")) + ") g")),
    "catalog": ((), _select(CATALOG, "orders")),
    "requests": ((), _select(REQUESTS, "orders")),
    "item_json": ((), _select(ITEM_JSON, "orders")),
    "log_text": ((), _select(LOG_TEXT, "orders")),
    "sar_meta": ((), _select(SAR_META, "orders")),
    "scene_meta": (("scenes",), _select(SCENE_META, "scenes where source_no = 5")),
    "ledger_events": ((), _select(LEDGER_EVENTS, "events")),
    "job_events": ((), _select(JOB_EVENTS, "events")),
}


def add_table(name: str, needs: str, sql: str) -> None:
    """Add a reusable oracle table (a named common table expression)."""
    _CTES[name] = (tuple(needs.split()), sql)


def with_tables(names: list[str], body: str) -> str:
    """Put the named derived tables, dependencies first, in front of ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in _CTES[name][0]:
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{name} as ({_CTES[name][1]})" for name in ordered)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


class World:
    """Lazy DataFrames of the derived tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _derive(self, table: str, exprs: dict[str, str]) -> DataFrame:
        return self.table(table).selectExpr(*_alias(exprs))

    @cached_property
    def blocks(self) -> DataFrame:
        # The site is part of the scene number. As a key of its own it lets a filter on sources reach the scan.
        first = F.min(F.struct("ok", "ln", "pk")).alias("first")
        return (
            self._derive("lineitem", BLOCKS)
            .groupBy("scene_id", "sk", "br", "bc")
            .agg(first)
            .select("scene_id", "br", "bc", "first.*", "sk")
        )

    @cached_property
    def pixels(self) -> DataFrame:
        return self._of_blocks(self.blocks)

    @cached_property
    def pixels_sar(self) -> DataFrame:
        return self._radar(self.pixels)

    def pixels_of(self, wanted: DataFrame) -> DataFrame:
        """Pixels of the scenes of ``wanted``: its blocks are chosen before they become pixels."""
        return self._of_blocks(self.blocks.join(wanted.select("scene_id").distinct(), "scene_id", "left_semi"))

    def pixels_sar_of(self, wanted: DataFrame) -> DataFrame:
        return self._radar(self.pixels_of(wanted))

    def _of_blocks(self, blocks: DataFrame) -> DataFrame:
        subs = F.explode(F.array(*[F.lit(i).cast("long") for i in range(4)])).alias("sub")
        return blocks.select("*", subs).selectExpr(*_alias(PIXELS))

    def _radar(self, pixels: DataFrame) -> DataFrame:
        return pixels.where("source_no in (5, 6)").selectExpr(*_alias(PIXELS_SAR))

    @cached_property
    def scenes(self) -> DataFrame:
        return (
            self.table("lineitem")
            .selectExpr(
                "l_suppkey*100000 + year(l_shipdate)*12 + month(l_shipdate)-1 as scene_id",
                "l_suppkey as site",
                "year(l_shipdate)*12 + month(l_shipdate)-1 as ym",
            )
            .distinct()
            .selectExpr(*_alias(SCENES))
        )

    @cached_property
    def fields(self) -> DataFrame:
        return self._derive("customer", FIELDS)

    @cached_property
    def field_shapes(self) -> DataFrame:
        """Fields as longitude/latitude polygons."""
        return georef.lonlat_boxes(self.fields, keep=("field_id", "site"))

    @cached_property
    def grids(self) -> DataFrame:
        corners = self._derive("supplier", GRID_CORNERS)
        east, north = geo.utm_forward(F.col("lon"), F.col("lat"), F.col("zone"))
        return corners.select("*", east.alias("east"), north.alias("north")).selectExpr(*_alias(GRIDS))

    @cached_property
    def field_spans(self) -> DataFrame:
        """Fields cut into spans on every grid they meet."""
        return georef.field_spans(self.field_shapes, self.grids)

    @cached_property
    def catalog(self) -> DataFrame:
        return self._derive("orders", CATALOG)

    @cached_property
    def requests(self) -> DataFrame:
        return self._derive("orders", REQUESTS)

    @cached_property
    def item_json(self) -> DataFrame:
        return self._derive("orders", ITEM_JSON)

    @cached_property
    def log_text(self) -> DataFrame:
        return self._derive("orders", LOG_TEXT)

    @cached_property
    def sar_meta(self) -> DataFrame:
        return self._derive("orders", SAR_META)

    @cached_property
    def scene_meta(self) -> DataFrame:
        return self.scenes.where("source_no = 5").selectExpr(*_alias(SCENE_META))

    @cached_property
    def ledger_events(self) -> DataFrame:
        return self._derive("events", LEDGER_EVENTS)

    @cached_property
    def job_events(self) -> DataFrame:
        return self._derive("events", JOB_EVENTS)
