"""Registered queries: radar metadata, comparability, change, baselines, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import text
from agrolume.functions.rounding import r6
from agrolume.operators import selection, temporal, zonal
from agrolume.plans.registry import query
from agrolume.plans.selection_queries import sar_histories
from agrolume.plans.world import World, add_table
from agrolume.plans.zonal_queries import field_pixels
from agrolume.session import shared

c = F.col


def _clean(col: str) -> str:
    return (
        f"case when upper(trim({col})) not in ('', 'NA', 'N/A', 'NONE', 'NULL', 'UNKNOWN', '-9999') then upper(trim({col})) end"
    )


def _number(col: str) -> str:
    return f"case when try_cast(trim({col}) as double) > -9999 then try_cast(trim({col}) as double) end"


_STATE = (
    "case when pt like 'ASC%' or pt = 'A' then 'ASCENDING' when pt like 'DES%' or pt = 'D' then 'DESCENDING' "
    "when hd >= 0 and hd < 360 and hd not in (90, 270) then case when hd < 90 or hd > 270 then 'ASCENDING' else 'DESCENDING' end end"
)
_POLS = (
    "array_to_string(list_filter(['HH','HV','VH','VV','RH','RV'], lambda p: "
    "list_contains(regexp_split_to_array(upper(trim(polarizations)), '[,;\\s]+'), p)), ',')"
)
_START = (
    "strftime(try_strptime(split_part(start_time, '.', 1) || '.' || rpad(substring(split_part(start_time, '.', 2), 1, 6), 6, '0'), "
    "'%d-%b-%Y %H:%M:%S.%f'), '%Y-%m-%dT%H:%M:%S.%f')"
)
_REQUIRED = temporal.REQUIRED


def _norm(source: str, kept: str) -> str:
    """Oracle of the normalised metadata of a table of provider texts."""
    return (
        "select *, array_to_string(list_filter([" + ", ".join(f"case when {n} is null then '{n}' end" for n in _REQUIRED)
        + "], lambda x: x is not null), ',') as missing from (select "
        f"{kept}, {_clean('sat_id')} as platform, {_clean('sensor')} as sensor, {_clean('imaging_mode')} as instrument_mode, "
        f"{_clean('software')} as software, case trim(rtc_flag) when '1' then true when '0' then false end as rtc_applied, "
        "case when upper(trim(dem_correction)) in ('YES','Y','TRUE','1') then true when upper(trim(dem_correction)) in ('NO','N','FALSE','0') then false end as dem_correction, "
        f"{_clean('dem_source')} as dem_source, nullif({_POLS}, '') as polarizations, {_clean('orientation')} as orientation, {_STATE} as orbit_state, "
        "case when pt like 'ASC%' or pt = 'A' or pt like 'DES%' or pt = 'D' then 'provider_pass_type' "
        "when hd >= 0 and hd < 360 and hd not in (90, 270) then 'satellite_heading' end as orbit_state_source, "
        "'scene:' || cast(case when sn > 0 and sn = floor(sn) then cast(sn as bigint) end as varchar) as track_key, "
        f"{_number('incidence')} as incidence_deg, coalesce({_number('spacing')}, 18e0) as pixel_spacing_m, {_START} as acquisition_start "
        f"from (select *, {_clean('pass_type')} as pt, {_number('heading')} as hd, {_number('scene_number')} as sn from {source}) s) t"
    )


add_table("sar_norm", "sar_meta", _norm("sar_meta", "product_no, site, acq_date, lookback_days"))
add_table("scene_norm", "scene_meta", _norm("scene_meta", "product_no, site, acq_date"))


def normalized(w: World) -> DataFrame:
    return temporal.normalize_sar_metadata(w.sar_meta)


@query(
    "sar_normalize_metadata",
    "select * exclude (acq_date, site, lookback_days), missing = '' as complete from sar_norm",
    tables="sar_norm",
)
def sar_normalize_metadata(w: World) -> DataFrame:
    return normalized(w).drop("acq_date", "site", "lookback_days")


@query(
    "normalize_polarizations",
    f"select product_no, {_POLS} as polarizations from sar_meta",
    tables="sar_meta",
)
def normalize_polarizations(w: World) -> DataFrame:
    return w.sar_meta.select(
        "product_no", F.array_join(text.normalize_polarizations(c("polarizations")), ",").alias("polarizations")
    )


@query(
    "parse_provider_datetime",
    f"select product_no, {_START} as acquisition_start from sar_meta",
    tables="sar_meta",
)
def parse_provider_datetime(w: World) -> DataFrame:
    stamp = text.provider_datetime(c("start_time"))
    return w.sar_meta.select(
        "product_no", F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("acquisition_start")
    )


_DIFFERS = " or ".join
_REASONS = (
    "case when not (a.missing = '' and b.missing = '') then 'METADATA_INCOMPLETE' else array_to_string(list_filter(["
    "case when a.platform is distinct from b.platform or a.sensor is distinct from b.sensor or a.instrument_mode is distinct from b.instrument_mode then 'PROCESSING_PROFILE_MISMATCH' end, "
    "case when a.software is distinct from b.software then 'PROCESSING_SOFTWARE_MISMATCH' end, "
    "case when a.rtc_applied is distinct from b.rtc_applied or a.dem_correction is distinct from b.dem_correction or a.dem_source is distinct from b.dem_source then 'RTC_OR_DEM_MISMATCH' end, "
    "case when a.polarizations is distinct from b.polarizations then 'POLARIZATION_MISMATCH' end, "
    "case when a.orientation is distinct from b.orientation then 'LOOK_DIRECTION_MISMATCH' end, "
    "case when a.orbit_state is distinct from b.orbit_state then 'ORBIT_STATE_MISMATCH' end, "
    "case when a.track_key is distinct from b.track_key then 'TRACK_MISMATCH' end, "
    "case when abs(a.incidence_deg - b.incidence_deg) > 1 then 'INCIDENCE_ANGLE_MISMATCH' end, "
    "case when abs(a.pixel_spacing_m - b.pixel_spacing_m) > 5e-1 then 'RESOLUTION_MISMATCH' end"
    "], lambda x: x is not null), ',') end"
)


@query(
    "sar_comparability",
    f"select a.product_no as current_no, b.product_no as candidate_no, {_REASONS} as reasons from sar_norm a join sar_norm b "
    "on b.site = a.site and b.acq_date < a.acq_date and b.acq_date >= a.acq_date - a.lookback_days",
    tables="sar_norm",
)
def sar_comparability(w: World) -> DataFrame:
    """Each product against the earlier products of its site within its own look-back."""
    norm = normalized(w)
    placed = ("site", "acq_date", "lookback_days")
    packed = norm.select(*placed, F.struct(*[n for n in norm.columns if n not in placed]).alias("m"))
    now = packed.select("site", c("acq_date").alias("now_date"), "lookback_days", c("m").alias("now"))
    before = packed.select("site", "acq_date", c("m").alias("before"))
    pairs = selection.join_date_range(now, before, on=("site",), start=F.date_sub("now_date", c("lookback_days")), end=F.date_sub("now_date", 1))
    return pairs.select(
        c("now.product_no").alias("current_no"), c("before.product_no").alias("candidate_no"),
        F.array_join(temporal.comparison_reasons("now", "before"), ",").alias("reasons"),
    )


_KEY_FIELDS = sorted([n for n in _REQUIRED if n != "acquisition_start"] + ["policy_version"])


def _json_value(name: str) -> str:
    if name == "policy_version":
        return "'\"eos04-comparability-v1\"'"
    return f"coalesce('\"' || cast({name} as varchar) || '\"', 'null')"


_CANONICAL = "'{' || " + " || ',' || ".join(f"'\"{n}\":' || {_json_value(n)}" for n in _KEY_FIELDS) + " || '}'"


@query(
    "comparison_key_hash",
    f"select product_no, sha256({_CANONICAL}) as key_hash from sar_norm",
    tables="sar_norm",
)
def comparison_key_hash(w: World) -> DataFrame:
    return normalized(w).select("product_no", temporal.comparison_key().alias("key_hash"))


# --- change and baseline over field histories --------------------------------

add_table(
    "judged",
    "history scene_norm",
    f"select h.*, ({_REASONS}) = '' as comparable from history h join scene_norm a on a.product_no = h.current_scene_id "
    "join scene_norm b on b.product_no = h.scene_id",
)
add_table("past", "judged", "select * from judged where comparable")
add_table(
    "current_sar",
    "sar_pick sar_cover",
    "select k.request_id, k.scene_id, v.hh_median, v.hv_median, v.hh_minus_hv from sar_pick k join sar_cover v "
    "on v.field_id = k.field_id and v.scene_id = k.scene_id where k.source_no = 5",
)
_FEATURES = ("hh_median", "hv_median", "hh_minus_hv")


def _long(table: str, extra: str = "") -> str:
    return " union all ".join(
        f"select request_id, '{f}' as feature, {f} as value{extra} from {table} where {f} is not null" for f in _FEATURES
    )


def observed(w: World) -> tuple[DataFrame, DataFrame]:
    """(current observation per request, judged history rows)."""
    facts = temporal.normalize_sar_metadata(w.scene_meta).withColumnRenamed("product_no", "scene_id")
    current, history = sar_histories(w)
    return current.join(facts.select("scene_id", "complete"), "scene_id"), temporal.judged_history(history, facts)


@query(
    "sar_change",
    "select n.request_id, n.feature, p.acq_date as reference_date, n.value as current_value, p.value as reference_value, "
    f"n.value - p.value as delta from ({_long('current_sar')}) n join ({_long('newest', ', acq_date')}) p "
    "on p.request_id = n.request_id and p.feature = n.feature",
    tables="current_sar newest",
)
def sar_change(w: World) -> DataFrame:
    current, judged = observed(w)
    return temporal.change_vs_previous(current, judged.where("comparable"))


add_table(
    "newest",
    "past",
    "select * from (select *, row_number() over (partition by request_id order by acq_date desc, scene_id desc) as rn from past) s where rn = 1",
)
add_table(
    "baseline",
    "past current_sar",
    "select n.request_id, n.feature, n.value as current_value, m.baseline_median, m.mad, m.observations, "
    "case when m.mad > 1e-6 then 67448975e-8*(n.value - m.baseline_median)/m.mad end as robust_deviation from "
    f"({_long('current_sar')}) n join (select h.request_id, h.feature, c.med as baseline_median, c.n as observations, "
    f"median(abs(h.value - c.med)) as mad from ({_long('past')}) h join (select request_id, feature, median(value) as med, count(*) as n "
    f"from ({_long('past')}) x group by request_id, feature having count(*) >= 5) c on c.request_id = h.request_id and c.feature = h.feature "
    "group by h.request_id, h.feature, c.med, c.n) m on m.request_id = n.request_id and m.feature = n.feature",
)


@query(
    "sar_robust_baseline",
    "select request_id, feature, current_value, baseline_median, observations, round(mad, 8) as mad, "
    "round(robust_deviation, 6) as robust_deviation from baseline",
    tables="baseline",
)
def sar_robust_baseline(w: World) -> DataFrame:
    current, judged = observed(w)
    out = temporal.robust_baseline(current, judged.where("comparable"))
    return out.withColumn("mad", F.round("mad", 8)).withColumn("robust_deviation", r6(c("robust_deviation")))


@query(
    "sar_temporal_status",
    "select c.request_id, case when n.missing <> '' then 'METADATA_INCOMPLETE' when coalesce(j.prior, 0) = 0 then 'NO_COMPARABLE_HISTORY' when j.prior < 5 then 'INSUFFICIENT_BASELINE' "
    "when coalesce(b.scores, 0) = 0 then 'DEGENERATE_BASELINE' else 'AVAILABLE' end as status, coalesce(j.prior, 0) + 1 as comparable_observations, "
    "coalesce(j.excluded, 0) as excluded_observations from current_sar c join scene_norm n on n.product_no = c.scene_id left join (select request_id, count(case when comparable then 1 end) as prior, "
    "count(case when not comparable then 1 end) as excluded from judged group by request_id) j on j.request_id = c.request_id "
    "left join (select request_id, count(robust_deviation) as scores from baseline group by request_id) b on b.request_id = c.request_id",
    tables="current_sar judged baseline scene_norm",
)
def sar_temporal_status(w: World) -> DataFrame:
    current, judged = observed(w)
    judged = shared(judged.select("request_id", "comparable", *temporal.FEATURES))
    baseline = temporal.robust_baseline(current, judged.where("comparable"))
    return temporal.temporal_status(current, judged, baseline)


@query(
    "field_trend",
    "select field_id, count(*) as observations, min(acq_date) as first_date, max(acq_date) as latest_date, "
    "round(arg_min(v, acq_date), 6) as first_value, round(arg_max(v, acq_date), 6) as latest_value, round(min(v), 6) as min_value, "
    "round(max(v), 6) as max_value, round(avg(v), 6) as mean_value, round(regr_slope(v, acq_date - date '1970-01-01'), 8) as slope_per_day, "
    "count(case when step > 45 then 1 end) as gaps, round(arg_max(v, acq_date) - arg_min(v, acq_date), 6) as change from "
    "(select field_id, acq_date, v, acq_date - lag(acq_date) over (partition by field_id order by acq_date) as step from "
    "(select f.field_id, s.acq_date, floor((200*sum(f.code) + count(*))/(2*count(*)))/1e6 as v from fpx f join scenes s on s.scene_id = f.scene_id "
    "where f.code <> -32768 group by f.field_id, s.acq_date) d) e group by field_id",
    tables="fpx scenes",
)
def field_trend(w: World) -> DataFrame:
    """NDVI trend of each field over all usable acquisitions.

    A day's mean is taken to millionths in integers, half up, so that it does not depend on float sums.
    """
    code = F.nullif(c("code").cast("long"), F.lit(dims.INDEX_NODATA).cast("long"))
    per_scene = field_pixels(w).groupBy("field_id", "scene_id").agg(
        F.sum(code).alias("value_sum"), F.count(code).alias("value_n")
    ).where("value_n > 0")
    dated = per_scene.join(w.scenes.select("scene_id", "acq_date"), "scene_id")
    daily = dated.groupBy("field_id", "acq_date").agg(F.sum("value_sum").alias("s"), F.sum("value_n").alias("n"))
    micro = F.expr("floor((200 * s + n) / (2 * n))")
    exact = daily.select("field_id", "acq_date", micro.alias("value_sum"), F.lit(1e6).alias("value_n"))
    out = temporal.field_trend(exact, keys=["field_id"])
    rounded = ["first_value", "latest_value", "min_value", "max_value", "mean_value", "change"]
    for name in rounded:
        out = out.withColumn(name, r6(c(name)))
    return out.withColumn("slope_per_day", F.round("slope_per_day", 8))
