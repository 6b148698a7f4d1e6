"""Registered queries: scene search, best scene, field dates, radar selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import render, sar
from agrolume.operators import georef, raster, selection, zonal
from agrolume.plans.registry import query
from agrolume.plans.world import World, add_table
from agrolume.plans.zonal_queries import field_spans, index_profiles
from agrolume.session import shared

c = F.col
CATALOG_KEYS = ("source_no", "aoi_no")
SITE_KEYS = ("source_no", "site")

_WINDOW = "case {0} " + " ".join(f"when {no} then {days}" for no, _, _, days, _ in dims.SOURCES) + " end"
_NATIVE = "case {0} " + " ".join(f"when {no} then {m}::double" for no, _, m, _, _ in dims.SOURCES) + " end"

add_table(
    "pairs",
    "requests catalog",
    "select r.request_id, r.request_date, s.*, abs(s.acq_date - r.request_date) as date_distance "
    "from requests r join catalog s on s.source_no = r.source_no and s.aoi_no = r.aoi_no "
    f"and abs(s.acq_date - r.request_date) <= {_WINDOW.format('r.source_no')}",
)
add_table(
    "cands",
    "pairs",
    "select * from (select *, row_number() over (partition by request_id order by date_distance, acq_date desc, product_id, scene_id) "
    "as rank from pairs) s",
)
add_table(
    "px_pairs",
    "requests scenes",
    "select r.request_id, r.field_id, r.request_date, r.max_cloud, r.index_name, s.*, abs(s.acq_date - r.request_date) as date_distance "
    "from requests r join scenes s on s.source_no = r.source_no and s.site = r.site "
    f"and abs(s.acq_date - r.request_date) <= {_WINDOW.format('r.source_no')}",
)
add_table(
    "px_cands",
    "px_pairs",
    "select * from (select *, row_number() over (partition by request_id order by date_distance, acq_date desc, product_id) "
    "as rank from px_pairs) s",
)
add_table(
    "best",
    "px_cands quality",
    "select * from (select p.request_id, p.field_id, p.scene_id, p.source_no, p.index_name, p.acq_date, p.product_id, p.date_distance, "
    "q.valid_px, q.min, q.max, q.mean, q.median, q.stddev, q.usable_percent, q.coverage_percent, q.cloud_percent as field_cloud, "
    "q.shadow_percent, q.obscured_percent, row_number() over (partition by p.request_id order by p.date_distance, "
    "q.usable_percent desc, q.coverage_percent desc, q.obscured_percent, p.product_id) as rn "
    "from px_cands p join quality q on q.field_id = p.field_id and q.scene_id = p.scene_id and q.index_name = p.index_name "
    "where p.status = 'accepted' and q.valid_px >= 1 and q.coverage_percent >= 95 and q.obscured_percent <= p.max_cloud) s where rn = 1",
)


@query(
    "join_request_scenes",
    "select request_id, count(*) as scenes, min(date_distance) as nearest, cast(sum(scene_id) as bigint) as scene_sum "
    "from pairs group by request_id",
    tables="pairs",
)
def join_request_scenes(w: World) -> DataFrame:
    return (
        selection.join_request_scenes(w.requests, w.catalog, on=CATALOG_KEYS)
        .groupBy("request_id")
        .agg(
            F.count("*").alias("scenes"),
            F.min("date_distance").cast("long").alias("nearest"),
            F.sum("scene_id").alias("scene_sum"),
        )
    )


@query(
    "scene_candidates",
    "select request_id, scene_id, date_distance, rank, rank <= 20 as within_limit from cands",
    tables="cands",
)
def scene_candidates(w: World) -> DataFrame:
    found = selection.candidates(w.requests, w.catalog, on=CATALOG_KEYS)
    return found.select(
        "request_id", "scene_id", c("date_distance").cast("long").alias("date_distance"),
        c("rank").cast("long").alias("rank"), "within_limit",
    )


@query(
    "rank_candidates_prefilter",
    "select request_id, scene_id, row_number() over (partition by request_id order by date_distance, "
    "coalesce(cloud_percent, 101), -coalesce(coverage_percent, 0), product_id) as prefilter_rank from cands",
    tables="cands",
)
def rank_candidates_prefilter(w: World) -> DataFrame:
    found = selection.candidates(w.requests, w.catalog, on=CATALOG_KEYS)
    ranked = selection.ranked_per(found, ["request_id"], selection.prefilter_order(), rank="prefilter_rank")
    return ranked.select("request_id", "scene_id", c("prefilter_rank").cast("long").alias("prefilter_rank"))


@query(
    "asof_nearest_scene",
    "select request_id, scene_id, acq_date, date_distance from (select *, row_number() over (partition by request_id "
    "order by date_distance, acq_date desc, product_id) as rn from pairs) s where rn = 1",
    tables="pairs",
)
def asof_nearest_scene(w: World) -> DataFrame:
    nearest = selection.nearest_scene(w.requests, w.catalog, on=CATALOG_KEYS)
    return nearest.withColumn("date_distance", c("date_distance").cast("long"))


@query(
    "scene_range",
    "select scene_id, acq_date, product_id from catalog where source_no = 0 and acq_date between date '1996-01-01' "
    "and date '1999-12-31' order by acq_date desc, product_id",
    tables="catalog",
)
def scene_range(w: World) -> DataFrame:
    return (
        w.catalog.where("source_no = 0 and acq_date between date'1996-01-01' and date'1999-12-31'")
        .orderBy(c("acq_date").desc(), "product_id")
        .select("scene_id", "acq_date", "product_id")
    )


@query(
    "scenes_for_aoi",
    "select source_no, aoi_no, scene_id, acq_date from catalog order by source_no, aoi_no, acq_date asc nulls last, created_no",
    tables="catalog",
)
def scenes_for_aoi(w: World) -> DataFrame:
    """Scenes of every (source, AOI), oldest first; a range sort splits hot groups."""
    return w.catalog.orderBy("source_no", "aoi_no", c("acq_date").asc_nulls_last(), "created_no").select(
        "source_no", "aoi_no", "scene_id", "acq_date"
    )


@query(
    "latest_exact_date",
    "select source_no, aoi_no, scene_id, acq_date from (select *, max(acq_date) over (partition by source_no, aoi_no) as newest "
    "from catalog) s where acq_date = newest",
    tables="catalog",
)
def latest_exact_date(w: World) -> DataFrame:
    return selection.latest_exact_date(w.catalog, ["source_no", "aoi_no"]).select(
        "source_no", "aoi_no", "scene_id", "acq_date"
    )


# --- best scene and field answers -------------------------------------------


PAIR = ["field_id", "scene_id"]


def wanted_pairs(found: DataFrame, *more: str) -> DataFrame:
    """The distinct (field, scene) pairs that anybody asks for."""
    return found.select(*PAIR, "grid_no", *more).distinct()


def gated(w: World, found: DataFrame) -> DataFrame:
    """Candidates with what the quality gates judge: pixels of the candidate pairs only are read, and only counted."""
    wanted = wanted_pairs(found)
    coded = raster.with_flags(raster.coded(w.pixels_of(wanted)))
    pixels = georef.join_wanted(coded, field_spans(w), wanted, asked_only=True)
    return zonal.gates(found.join(zonal.gate_counts(pixels), PAIR))


def graded_options(w: World) -> DataFrame:
    """Accepted candidates that pass the gates."""
    found = selection.candidates(w.requests, w.scenes, on=SITE_KEYS).where("status = 'accepted' and index_name is not null")
    found = found.select("request_id", *PAIR, "grid_no", "source_no", "index_name", "acq_date", "product_id", "date_distance", "max_cloud")
    return gated(w, found).where(selection.is_eligible(c("max_cloud")))


@query(
    "best_scene",
    "select request_id, field_id, scene_id, acq_date, date_distance, usable_percent, coverage_percent, obscured_percent, "
    "valid_px from best",
    tables="best",
)
def best_scene(w: World) -> DataFrame:
    picked = selection.best_scene(graded_options(w), payload=["field_id", "scene_id", "acq_date", "valid_px"])
    return picked.select(
        "request_id", "field_id", "scene_id", "acq_date", c("date_distance").cast("long").alias("date_distance"),
        "usable_percent", "coverage_percent", "obscured_percent", "valid_px",
    )


def _by_source(position: int, kind: str) -> str:
    """A source's provenance value as an expression that Spark and DuckDB share."""
    cases = " ".join(f"when {no} then {kind.format(row[position])}" for no, row in dims.PROVENANCE.items() if row[position] is not None)
    return f"case source_no {cases} end"


_FORMULAS = "case source_no " + " ".join(
    f"when {no} then case index_name " + " ".join(f"when '{n}' then '{dims.formula_version(no, n)}'" for k, n in dims.optical_indices() if k == no) + " end"
    for no in dims.PROVENANCE
) + " end"
_DISPLAY = "case index_name " + " ".join(f"when '{n}' then '{row[0]}'" for n, row in dims.VISUALIZATION.items()) + " end"
PROVENANCE = {
    "provider_route": _by_source(0, "'{}'"),
    "atmospheric_correction": _by_source(1, "'{}'"),
    "formula_version": _FORMULAS,
    "warning": _by_source(3, "'{}'"),
    "quality_status": f"case when {_by_source(3, '1')} = 1 then 'WARN' else 'GOOD' end",
    "display_profile": _DISPLAY,
}
_CLASSES = ", ".join(
    f"({no}, '{name}', {i}, '{label}', {lower}::double, {upper}::double, {native * native}::double, "
    f"'{'ndvi-generic-v1' if family == 's2' else 'resourcesat-thresholds-v1'}')"
    for no, _, native, _, family in dims.SOURCES
    for name in dims.profiled_indices(no, family)
    for i, (label, lower, upper) in enumerate(dims.THRESHOLD_CLASSES[name])
)


@query(
    "field_index",
    "select b.request_id, b.field_id, b.scene_id, b.index_name, b.acq_date, b.valid_px, b.min, b.max, b.mean, b.median, b.stddev, "
    "b.usable_percent, b.coverage_percent, b.field_cloud as cloud_percent, b.shadow_percent, b.obscured_percent, "
    + _NATIVE.format("b.source_no") + " as native_m, "
    + ", ".join(f"{e.replace('source_no', 'b.source_no').replace('index_name', 'b.index_name')} as {n}" for n, e in PROVENANCE.items()) + ", "
    "case when b.min = b.max then 'standard' else 'contrast' end as render_profile, "
    "case when b.min = b.max then 'constant_scene' end as render_fallback, "
    "c.profile_version as threshold_profile, c.class_no, c.label, "
    "round(count(case when f.code >= round(lower*10000) and f.code < round(upper*10000) then 1 end)*any_value(pixel_area), 6) as area_m2, "
    "round(count(case when f.code >= round(lower*10000) and f.code < round(upper*10000) then 1 end)*100e0/nullif(count(f.code), 0), 6) as area_percent "
    f"from best b left join (values {_CLASSES}) as c(sno, iname, class_no, label, lower, upper, pixel_area, profile_version) "
    "on c.sno = b.source_no and c.iname = b.index_name "
    "left join fpi f on f.field_id = b.field_id and f.scene_id = b.scene_id and f.index_name = b.index_name and f.code is not null and c.class_no is not null "
    "group by all",
    tables="best fpi",
)
def field_index(w: World) -> DataFrame:
    """The whole answer: chosen scene, statistics, classes, profiles, versions of the asked index.

    One row per threshold class of the chosen scene; sources and indices without
    a default threshold profile answer with a single row. Candidates are only
    counted; statistics and classes come from one histogram of the chosen pairs.
    """
    shares = ["index_name", "valid_px", "cloud_percent", "shadow_percent"]
    picked = shared(selection.best_scene(graded_options(w), payload=[*PAIR, "grid_no", "acq_date", "source_no", *shares]))
    wanted = wanted_pairs(picked, "index_name")
    chosen = georef.join_wanted(raster.coded(w.pixels_of(wanted)), field_spans(w), wanted, asked_only=True)
    keys = (*PAIR, "index_name")
    codes = zonal.gathered(chosen.select(*keys, "source_no", raster.of_index(c("index_name")).alias("code")))
    # Statistics and classes both read it.
    hist = shared(zonal.histogram(codes, keys=(*keys, "source_no"), nodata=None))
    stats = zonal.stats_from_histogram(hist, keys=keys, unit=raster.scale_of(c("index_name"))).select(*keys, "min", "max", "mean", "median", "stddev")
    classes = zonal.classes_from_histogram(hist, index_profiles(w), keys=keys).drop("lower", "upper")
    versions = dims.threshold_profiles_dim(w.spark).select(
        "source_no", "index_name", "class_no", c("profile_version").alias("threshold_profile")
    )
    applied, fallback = render.contrast_profile(c("index_name"), c("min"), c("max"))
    answer = picked.join(stats, list(keys)).select(
        "request_id", *keys, "source_no", "acq_date", "valid_px", "min", "max", "mean",
        "median", "stddev", "usable_percent", "coverage_percent", "cloud_percent",
        "shadow_percent", "obscured_percent", "native_m",
        *[F.expr(e).alias(n) for n, e in PROVENANCE.items()],
        applied.alias("render_profile"), fallback.alias("render_fallback"),
    )
    return (
        answer.join(classes, list(keys), "left")
        .join(versions, ["source_no", "index_name", "class_no"], "left")
        .drop("source_no")
    )


add_table(
    "day_pairs",
    "requests scenes quality",
    "select r.request_id, r.field_id, r.d as request_date, r.max_cloud, r.index_name, s.scene_id, s.product_id, s.status = 'accepted' as has_raster, "
    "q.field_px, q.valid_px, q.usable_percent, q.coverage_percent, q.obscured_percent from "
    "(select *, request_date + cast(unnest(range(10)) as integer) as d from requests) r "
    "left join scenes s on s.source_no = r.source_no and s.site = r.site and s.acq_date = r.d "
    "left join quality q on q.field_id = r.field_id and q.scene_id = s.scene_id and q.index_name = r.index_name and s.status = 'accepted'",
)


@query(
    "field_dates",
    "select request_id, request_date, status, scene_id, usable_percent, coverage_percent, obscured_percent, coalesce(valid_px, 0) as valid_px "
    "from (select *, row_number() over (partition by request_id, request_date order by list_position(['AVAILABLE', "
    "'CLOUD_THRESHOLD_EXCEEDED', 'PROCESSING_FAILED', 'PROCESSING_PENDING', 'INSUFFICIENT_FIELD_COVERAGE', "
    "'NO_FIELD_INTERSECTION'], status), coverage_percent desc, valid_px desc, product_id) as rn from (select *, case when scene_id is null "
    "then 'NO_FIELD_INTERSECTION' when not has_raster then 'PROCESSING_PENDING' when field_px is null then 'NO_FIELD_INTERSECTION' "
    "when coverage_percent < 95 then 'INSUFFICIENT_FIELD_COVERAGE' when obscured_percent > max_cloud then 'CLOUD_THRESHOLD_EXCEEDED' "
    "when valid_px < 1 then 'PROCESSING_FAILED' else 'AVAILABLE' end as status from day_pairs where request_id is not null) s) t where rn = 1",
    tables="day_pairs",
)
def field_dates(w: World) -> DataFrame:
    """Every asked date of every request: available, or why not."""
    keys = ["request_id", "request_date"]
    asked = w.requests.withColumn(
        "request_date", F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.date_add("request_date", i)))
    )
    pairs = selection.join_request_scenes(asked, w.scenes, on=SITE_KEYS, window_days=0)
    pairs = pairs.select(*keys, *PAIR, "grid_no", "index_name", "product_id", (c("status") == "accepted").alias("has_raster"))
    shares = ["usable_percent", "coverage_percent", "obscured_percent"]
    seen = gated(w, pairs.where("has_raster and index_name is not null")).select(*keys, "scene_id", "field_px", "valid_px", *shares)
    found = pairs.join(seen, [*keys, "scene_id"], "left").drop("field_id", "grid_no", "index_name")
    graded = asked.select(*keys, "field_id", "max_cloud").join(found, keys, "left").withColumn("status", selection.date_status(c("max_cloud")))
    return selection.field_dates(graded, keys)


# --- radar ------------------------------------------------------------------

add_table(
    "sar_pick",
    "px_pairs sar_cover requests",
    "select r.request_id, r.field_id, r.site, r.source_no, r.request_date, r.lookback_days, r.max_observations, a.scene_id, a.acq_date, a.coverage_percent, "
    "coalesce(n.accepted, 0) as accepted, coalesce(n.overlapping, 0) as overlapping, coalesce(n.low, 0) as low "
    "from (select * from requests where source_no >= 5) r left join (select * from (select p.request_id, p.scene_id, p.acq_date, "
    "v.coverage_percent, row_number() over (partition by p.request_id order by p.date_distance, v.coverage_percent desc, p.product_id) as rn "
    "from (select * from (select *, row_number() over (partition by request_id order by date_distance, acq_date desc, product_id) as k "
    "from px_pairs where source_no >= 5) i where status = 'accepted') p join sar_cover v on v.field_id = p.field_id "
    "and v.scene_id = p.scene_id where v.coverage_percent >= 95) s where rn = 1) a on a.request_id = r.request_id "
    "left join (select p.request_id, count(*) as accepted, count(v.field_px) as overlapping, "
    "count(case when v.coverage_percent < 95 then 1 end) as low from (select * from (select *, row_number() over (partition by request_id "
    "order by date_distance, acq_date desc, product_id) as k from px_pairs where source_no >= 5) i where status = 'accepted') p "
    "left join sar_cover v on v.field_id = p.field_id and v.scene_id = p.scene_id group by p.request_id) n on n.request_id = r.request_id",
)
_CONFIDENCE = (
    "case when abs(d) <= 3 and coverage_percent >= 95 then 'high' when abs(d) <= 7 and coverage_percent >= 95 then 'medium' "
    "when abs(d) <= 12 and coverage_percent >= 95 then 'low' else 'none' end"
)


def sar_requests(w: World) -> DataFrame:
    return w.requests.where("source_no >= 5")


def sar_pixels(w: World, pairs: DataFrame) -> DataFrame:
    """Backscatter of the wanted (field, scene) pairs."""
    return georef.join_wanted(raster.backscatter(w.pixels_sar_of(pairs)), field_spans(w), pairs, asked_only=True)


def picked_sar(w: World) -> DataFrame:
    """The radar scene of each request: coverage is counted for candidate pairs only."""
    asked = sar_requests(w)
    found = selection.candidates(asked, w.scenes, on=SITE_KEYS, limit=dims.SAR_MAX_CANDIDATES)
    coverage = zonal.sar_coverage(sar_pixels(w, wanted_pairs(found.where("status = 'accepted'"))))
    return selection.field_sar(asked, found, coverage)


@query(
    "field_sar",
    "select request_id, field_id, scene_id, acq_date, d as days_from_target, coverage_percent, "
    f"case when scene_id is not null then {_CONFIDENCE} end as confidence, case when scene_id is not null then null "
    "when accepted = 0 then 'no_scene' when low > 0 then 'low_coverage' when overlapping = 0 then 'no_overlap' else 'no_scene' end as reason_code "
    "from (select *, acq_date - request_date as d from sar_pick) s",
    tables="sar_pick",
)
def field_sar(w: World) -> DataFrame:
    return picked_sar(w).select(
        "request_id", "field_id", "scene_id", "acq_date", c("days_from_target").cast("long").alias("days_from_target"),
        "coverage_percent", "confidence", "reason_code",
    )


@query(
    "sar_confidence",
    f"select request_id, scene_id, {_CONFIDENCE} as confidence from "
    "(select request_id, scene_id, acq_date - request_date as d, coverage_percent from pairs where source_no >= 5) s",
    tables="pairs",
)
def sar_confidence(w: World) -> DataFrame:
    pairs = selection.join_request_scenes(sar_requests(w), w.catalog, on=CATALOG_KEYS)
    days = F.datediff("acq_date", "request_date")
    return pairs.select("request_id", "scene_id", sar.confidence(days, c("coverage_percent")).alias("confidence"))


add_table(
    "history",
    "sar_pick sar_cover scenes",
    "select * from (select request_id, field_id, current_scene_id, scene_id, acq_date, max_observations, hh_median, hv_median, hh_minus_hv, "
    "row_number() over (partition by request_id order by acq_date desc, product_id) as position from (select p.*, v.coverage_percent, "
    "v.hh_median, v.hv_median, v.hh_minus_hv from (select * from (select k.request_id, k.field_id, k.scene_id as current_scene_id, k.max_observations, s.*, "
    "row_number() over (partition by k.request_id order by s.acq_date desc, s.product_id) as fetched from sar_pick k join scenes s "
    "on s.source_no = k.source_no and s.site = k.site and s.acq_date < k.acq_date and s.acq_date >= k.acq_date - k.lookback_days "
    "where k.source_no = 5 and k.scene_id is not null) i where status = 'accepted') p "
    "join sar_cover v on v.field_id = p.field_id and v.scene_id = p.scene_id where v.coverage_percent >= 95) q) t",
)


def sar_histories(w: World) -> tuple[DataFrame, DataFrame]:
    """(chosen EOS-04 observation, history) of every answered request (NISAR has none).

    Both carry the medians; they are taken of the chosen and earlier pairs alone.
    """
    more = w.requests.select("request_id", "site", "lookback_days", "max_observations")
    chosen = shared(picked_sar(w).where("source_no = 5 and scene_id is not null").join(more, "request_id"))
    pairs = shared(selection.history_pairs(chosen, w.scenes, on=SITE_KEYS))
    now = chosen.select(*PAIR, c("site").alias("grid_no"))
    coverage = shared(zonal.sar_common_coverage(sar_pixels(w, wanted_pairs(pairs).unionByName(now).distinct())))
    current = chosen.select("request_id", *PAIR).join(coverage.drop("coverage_percent"), PAIR)
    return current, selection.sar_history(pairs, coverage)


@query(
    "sar_history",
    "select request_id, current_scene_id, scene_id, acq_date, position, position <= max_observations as within_limit, hh_median from history",
    tables="history",
)
def sar_history(w: World) -> DataFrame:
    return sar_histories(w)[1].select(
        "request_id", "current_scene_id", "scene_id", "acq_date", c("position").cast("long").alias("position"), "within_limit", "hh_median"
    )
