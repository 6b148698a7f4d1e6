"""Radar comparability, change and robust baselines; index trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrolume.functions import keys, text
from agrolume.operators.geometry import once

c = F.col

# Fixed values of the comparability policy.
POLICY_VERSION = "eos04-comparability-v1"
INCIDENCE_TOLERANCE = 1.0
RESOLUTION_TOLERANCE = 0.5
MAD_FLOOR = 1e-6
ROBUST_SCALE = 0.67448975

# What must be present before two passes may be compared.
REQUIRED = (
    "platform", "sensor", "instrument_mode", "software", "rtc_applied", "dem_correction", "dem_source",
    "polarizations", "orientation", "orbit_state", "track_key", "incidence_deg", "pixel_spacing_m",
    "acquisition_start",
)


def normalize_sar_metadata(raw: DataFrame, *, resolution_m: float = 18.0) -> DataFrame:
    """Provider text fields -> typed comparison fields plus completeness."""
    state, origin = text.orbit_state(text.clean_text(c("pass_type")), text.number(c("heading")))
    scene = text.positive_integer(c("scene_number"))
    polarizations = F.array_join(text.normalize_polarizations(c("polarizations")), ",")
    fields: dict[str, Column] = {
        "platform": text.clean_text(c("sat_id")),
        "sensor": text.clean_text(c("sensor")),
        "instrument_mode": text.clean_text(c("imaging_mode")),
        "software": text.clean_text(c("software")),
        "rtc_applied": text.flag(c("rtc_flag")),
        "dem_correction": text.yes_no(c("dem_correction")),
        "dem_source": text.clean_text(c("dem_source")),
        "polarizations": F.when(polarizations != "", polarizations),
        "orientation": text.clean_text(c("orientation")),
        "orbit_state": state,
        "orbit_state_source": origin,
        "track_key": F.concat(F.lit("scene:"), scene.cast("string")),
        "incidence_deg": text.number(c("incidence")),
        "pixel_spacing_m": F.coalesce(text.number(c("spacing")), F.lit(resolution_m)),
        "acquisition_start": F.date_format(
            text.provider_datetime(c("start_time")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        ),
    }
    passthrough = [n for n in raw.columns if n in ("product_no", "site", "acq_date", "lookback_days")]
    typed = raw.select(*passthrough, *[value.alias(name) for name, value in fields.items()])
    missing = F.array_compact(F.array(*[F.when(c(n).isNull(), n) for n in REQUIRED]))
    return typed.withColumn("missing", F.array_join(missing, ",")).withColumn("complete", c("missing") == "")


def comparison_key(prefix: str = "") -> Column:
    """SHA-256 of the comparison fields as canonical JSON (numbers as text)."""
    names = [n for n in REQUIRED if n != "acquisition_start"]
    fields = {n: c(prefix + n).cast("string") for n in names}
    fields["policy_version"] = F.lit(POLICY_VERSION)
    return keys.key_hash(fields)


def comparison_reasons(current: str, candidate: str) -> Column:
    """Why two passes may not be compared; an empty array means they may.

    ``current`` and ``candidate`` are the struct columns of the two passes.
    Tolerances are strict: a difference equal to the tolerance is accepted.
    """
    a, b = c(current), c(candidate)

    def differs(*names: str) -> Column:
        test = F.lit(False)
        for name in names:
            test = test | ~a[name].eqNullSafe(b[name])
        return test

    def beyond(name: str, tolerance: float) -> Column:
        return F.abs(a[name] - b[name]) > tolerance

    checks = (
        (differs("platform", "sensor", "instrument_mode"), "PROCESSING_PROFILE_MISMATCH"),
        (differs("software"), "PROCESSING_SOFTWARE_MISMATCH"),
        (differs("rtc_applied", "dem_correction", "dem_source"), "RTC_OR_DEM_MISMATCH"),
        (differs("polarizations"), "POLARIZATION_MISMATCH"),
        (differs("orientation"), "LOOK_DIRECTION_MISMATCH"),
        (differs("orbit_state"), "ORBIT_STATE_MISMATCH"),
        (differs("track_key"), "TRACK_MISMATCH"),
        (beyond("incidence_deg", INCIDENCE_TOLERANCE), "INCIDENCE_ANGLE_MISMATCH"),
        (beyond("pixel_spacing_m", RESOLUTION_TOLERANCE), "RESOLUTION_MISMATCH"),
    )
    reasons = F.array_compact(F.array(*[F.when(test, code) for test, code in checks]))
    incomplete = ~(a["complete"] & b["complete"])
    return F.when(incomplete, F.array(F.lit("METADATA_INCOMPLETE"))).otherwise(reasons)


def judged_history(history: DataFrame, facts: DataFrame) -> DataFrame:
    """``history`` (current_scene_id, scene_id) with ``comparable`` and ``reasons``, by the metadata of both passes.

    ``facts`` are normalised rows with a scene_id. Pairs are those of the history and no others; a
    pass without metadata leaves its pairs out.
    """
    packed = facts.select("scene_id", F.struct(*[n for n in (*REQUIRED, "complete")]).alias("m"))
    both = history.join(packed.select(c("scene_id").alias("current_scene_id"), c("m").alias("now")), "current_scene_id")
    both = both.join(packed.select("scene_id", c("m").alias("before")), "scene_id")
    judged = both.withColumn("reasons", comparison_reasons("now", "before")).drop("now", "before")
    return judged.withColumn("comparable", F.size("reasons") == 0)


FEATURES = ("hh_median", "hv_median", "hh_minus_hv")


def long_features(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per observation and radar feature, missing features dropped."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("feature"), c(name).alias("value")) for name in FEATURES
    ])).alias("e")
    return df.select(*keep, entries).select(*keep, "e.feature", "e.value").where("value is not null")


def change_vs_previous(current: DataFrame, comparable: DataFrame) -> DataFrame:
    """Difference of each feature to the newest comparable earlier pass."""
    newest = F.max(F.struct("acq_date", "scene_id", *FEATURES)).alias("p")
    previous = comparable.groupBy("request_id").agg(newest).select("request_id", "p.*")
    before = long_features(previous, ["request_id", "acq_date"]).select(
        "request_id", "feature", c("acq_date").alias("reference_date"), c("value").alias("reference_value")
    )
    now = long_features(current, ["request_id"])
    return now.join(before, ["request_id", "feature"]).select(
        "request_id", "feature", "reference_date",
        c("value").alias("current_value"), "reference_value",
        (c("value") - c("reference_value")).alias("delta"),
    )


def _middle(values: Column) -> Column:
    """Median of a sorted array, NULL if it is empty."""
    n = F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.get(values, low) * 0.5 + F.get(values, high) * 0.5


def robust_baseline(current: DataFrame, comparable: DataFrame, *, minimum: int = 5) -> DataFrame:
    """Median and MAD of comparable history, and the robust deviation from it.

    History is bounded by the look-back of its request, so its values are brought to one row per request
    once, and both medians are taken there; features with fewer than ``minimum`` values are left out.
    """
    history = comparable.groupBy("request_id").agg(*[F.collect_list(name).alias(f"past_{name}") for name in FEATURES])
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("feature"), c(name).alias("value"), F.sort_array(f"past_{name}").alias("past")) for name in FEATURES
    ])).alias("e")
    now = current.select("request_id", *FEATURES).join(history, "request_id").select("request_id", entries).select("request_id", "e.*")
    centred = now.where(c("value").isNotNull() & (F.size("past") >= minimum)).select(
        "request_id", "feature", "value", "past", once(_middle(c("past"))).alias("baseline_median")
    )
    spread = centred.select(
        "request_id", "feature", "value", "baseline_median", F.size("past").cast("long").alias("n"),
        once(F.sort_array(F.transform("past", lambda v: F.abs(v - c("baseline_median"))))).alias("away"),
    ).withColumn("mad", _middle(c("away")))
    deviation = F.when(
        c("mad") > MAD_FLOOR, F.lit(ROBUST_SCALE) * (c("value") - c("baseline_median")) / c("mad")
    )
    return spread.select(
        "request_id", "feature", c("value").alias("current_value"), "baseline_median", "mad",
        c("n").alias("observations"), deviation.alias("robust_deviation"),
    )


def temporal_status(
    current: DataFrame, judged: DataFrame, baseline: DataFrame, *, minimum: int = 5
) -> DataFrame:
    """Comparison status per request; the current pass counts as comparable."""
    counts = judged.groupBy("request_id").agg(
        F.count_if(c("comparable")).alias("prior"), F.count_if(~c("comparable")).alias("excluded")
    )
    scored = baseline.groupBy("request_id").agg(F.count("robust_deviation").alias("scores"))
    prior = F.coalesce(c("prior"), F.lit(0))
    status = (
        F.when(~c("complete"), "METADATA_INCOMPLETE")
        .when(prior == 0, "NO_COMPARABLE_HISTORY")
        .when(prior < minimum, "INSUFFICIENT_BASELINE")
        .when(F.coalesce(c("scores"), F.lit(0)) == 0, "DEGENERATE_BASELINE")
        .otherwise("AVAILABLE")
    )
    return (
        current.select("request_id", "complete")
        .join(counts, "request_id", "left")
        .join(scored, "request_id", "left")
        .select(
            "request_id", status.alias("status"),
            (prior + 1).alias("comparable_observations"),
            F.coalesce(c("excluded"), F.lit(0)).alias("excluded_observations"),
        )
    )


def field_trend(observations: DataFrame, *, keys: list[str], gap_days: int = 45) -> DataFrame:
    """First, latest, min, max, mean, change, slope per day, and gaps.

    Observations are first reduced to one value per key and day, which bounds
    every series by the length of the calendar.
    """
    daily = observations.groupBy(*keys, "acq_date").agg(
        F.sum("value_sum").alias("s"), F.sum("value_n").alias("n")
    ).withColumn("value", c("s") / c("n"))
    step = F.datediff("acq_date", F.lag("acq_date").over(Window.partitionBy(*keys).orderBy("acq_date")))
    day = F.unix_date("acq_date").cast("double")
    return (
        daily.withColumn("step", step)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("observations"),
            F.min("acq_date").alias("first_date"),
            F.max("acq_date").alias("latest_date"),
            F.min_by("value", "acq_date").alias("first_value"),
            F.max_by("value", "acq_date").alias("latest_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.avg("value").alias("mean_value"),
            F.regr_slope("value", day).alias("slope_per_day"),
            F.count_if(c("step") > gap_days).alias("gaps"),
        )
        .withColumn("change", c("latest_value") - c("first_value"))
    )
