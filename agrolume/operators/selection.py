"""Which scene answers a question about a field and a date.

A *request* asks about one field, source and date. Requests meet scenes on their
equi keys plus a day bucket as wide as the source's window, so a source or AOI
with very many scenes is spread over its days. Choosing one scene per request is
a ``min`` over an ordered struct, which Spark combines before the shuffle. Rankings
keep every row and say by ``within_limit`` which ones a limit would take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import sar

c = F.col


def source_window(source_no: Column) -> Column:
    """Search window in days of each source, NULL for unknown sources."""
    out = None
    for number, _, _, days, _ in dims.SOURCES:
        out = F.when(source_no == number, days) if out is None else out.when(source_no == number, days)
    return out


def native_metres(source_no: Column) -> Column:
    out = None
    for number, _, metres, _, _ in dims.SOURCES:
        test = source_no == number
        out = F.when(test, metres) if out is None else out.when(test, metres)
    return out


def join_request_scenes(
    requests: DataFrame, scenes: DataFrame, *, on: tuple[str, ...], window_days: Column | int | None = None
) -> DataFrame:
    """Every (request, scene) pair with |acquisition - request date| <= window.

    ``window_days`` may be a constant or an expression over the ``on`` columns;
    by default it is the window of the source.
    """
    if window_days is None:
        window = source_window(c("source_no"))
    else:
        window = F.lit(window_days) if isinstance(window_days, int) else window_days
    span = window * 2 + 1
    day = F.unix_date("request_date")
    asked = requests.withColumn(
        "bucket", F.explode(F.sequence(F.floor((day - window) / span), F.floor((day + window) / span)))
    )
    offered = scenes.withColumn("bucket", F.floor(F.unix_date("acq_date") / span))
    distance = F.abs(F.datediff("acq_date", "request_date"))
    return (
        asked.join(offered, [*on, "bucket"])
        .withColumn("date_distance", distance)
        .where(c("date_distance") <= window)
        .drop("bucket")
    )


#: Days of the buckets in which date ranges and scenes meet.
RANGE_BUCKET = 64


def join_date_range(asked: DataFrame, scenes: DataFrame, *, on: tuple[str, ...], start: Column, end: Column, bucket_days: int = RANGE_BUCKET) -> DataFrame:
    """Every (asked, scene) pair whose acquisition lies in the asked row's own range of days, both ends included.

    Ranges are spread over buckets of days and a scene lies in one of them, so
    pairs meet once however long a range is.
    """
    first, last = F.unix_date(start), F.unix_date(end)
    spread = asked.withColumns({"first_day": first, "last_day": last}).where("last_day >= first_day").withColumn(
        "bucket", F.explode(F.sequence(F.floor(c("first_day") / bucket_days), F.floor(c("last_day") / bucket_days)))
    )
    offered = scenes.withColumn("bucket", F.floor(F.unix_date("acq_date") / bucket_days))
    met = spread.join(offered, [*on, "bucket"])
    return met.where(F.unix_date("acq_date").between(c("first_day"), c("last_day"))).drop("bucket", "first_day", "last_day")


def ranked_per(df: DataFrame, keys: list[str], order: list[Column], limit: int | None = None, rank: str = "rank") -> DataFrame:
    """All rows with their position per key in ``order``; with a limit also whether it reaches them."""
    out = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return out if limit is None else out.withColumn("within_limit", c(rank) <= limit)


def ranked_in_bins(df: DataFrame, keys: list[str], order: list[Column], bins: list[tuple[Column, bool]], limit: int | None = None, rank: str = "rank") -> DataFrame:
    """What ranked_per gives, for keys with very many rows: rows are ranked within bins, and bins by their counts.

    ``bins`` are coarser steps of ``order``, each with whether it descends (nulls last): rows of an earlier bin come
    before all rows of a later one.
    A window then holds one bin of a key, and another the key's bins, not its rows.
    """
    names = [f"bin_{k}" for k in range(len(bins))]
    binned = df.withColumns({n: value for n, (value, _) in zip(names, bins, strict=True)})
    sizes = binned.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("bin_size"))
    steps = [c(n).desc_nulls_last() if down else c(n).asc_nulls_first() for n, (_, down) in zip(names, bins, strict=True)]
    before = Window.partitionBy(*keys).orderBy(*steps).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("ahead", F.coalesce(F.sum("bin_size").over(before), F.lit(0))).drop("bin_size")
    inner = F.row_number().over(Window.partitionBy(*[binned[n] for n in (*keys, *names)]).orderBy(*order))
    ranks = binned.withColumn("inner_rank", inner)
    out = ranks.join(offsets.withColumnsRenamed({n: f"of_{n}" for n in (*keys, *names)}), [ranks[n].eqNullSafe(F.col(f"of_{n}")) for n in (*keys, *names)])
    out = out.select(*df.columns, (c("ahead") + c("inner_rank")).alias(rank))
    return out if limit is None else out.withColumn("within_limit", c(rank) <= limit)


def candidates(
    requests: DataFrame,
    scenes: DataFrame,
    *,
    on: tuple[str, ...],
    keys: tuple[str, ...] = ("request_id",),
    window_days: Column | int | None = None,
    limit: int = dims.MAX_CANDIDATE_SCENES,
) -> DataFrame:
    """Scenes near each request's date: nearest first, then newest, then product, then scene. None is left out."""
    pairs = join_request_scenes(requests, scenes, on=on, window_days=window_days)
    # A product may be listed as several scenes: only the scene number leaves nothing open.
    order = [c("date_distance"), c("acq_date").desc(), c("product_id"), c("scene_id")]
    return ranked_per(pairs, list(keys), order, limit)


def prefilter_order() -> list[Column]:
    """Cheap ranking of candidates before any pixel is read."""
    return [
        c("date_distance"),
        F.coalesce(c("cloud_percent"), F.lit(101.0)),
        -F.coalesce(c("coverage_percent"), F.lit(0.0)),
        native_metres(c("source_no")),
        c("product_id"),
    ]


def nearest_scene(
    requests: DataFrame, scenes: DataFrame, *, on: tuple[str, ...], key: str = "request_id"
) -> DataFrame:
    """One scene per request: nearest in either direction, newest on ties.

    Only the first scene of each day can win, so scenes are reduced to one per
    day before they meet the requests.
    """
    first = F.min(F.struct("product_id", "scene_id")).alias("s")
    daily = scenes.groupBy(*on, "acq_date").agg(first).select(*on, "acq_date", "s.product_id", "s.scene_id")
    pairs = join_request_scenes(requests, daily, on=on)
    best = F.min(F.struct(
        "date_distance", (-F.unix_date("acq_date")).alias("newest"), "product_id", "scene_id", "acq_date"
    )).alias("best")
    return pairs.groupBy(key).agg(best).select(
        key, "best.scene_id", "best.acq_date", "best.date_distance"
    )


def is_eligible(max_cloud: Column) -> Column:
    """Quality gates on a candidate's field statistics."""
    return (
        (c("valid_px") >= dims.FIELD_MIN_USABLE_PIXELS)
        & (c("coverage_percent") >= dims.FIELD_MIN_COVERAGE)
        & (c("obscured_percent") <= max_cloud)
    )


def best_scene(
    options: DataFrame, *, key: str = "request_id", payload: list[str] | None = None
) -> DataFrame:
    """Pick per request: nearest date, most usable, best covered, least obscured,
    finest resolution, product id."""
    payload = payload or []
    best = F.min(F.struct(
        c("date_distance"),
        (-c("usable_percent")).alias("k_usable"),
        (-c("coverage_percent")).alias("k_coverage"),
        c("obscured_percent"),
        native_metres(c("source_no")).alias("native_m"),
        c("product_id"),
        *[c(name) for name in payload],
    )).alias("best")
    return options.groupBy(key).agg(best).select(
        key, "best.date_distance",
        (-c("best.k_usable")).alias("usable_percent"),
        (-c("best.k_coverage")).alias("coverage_percent"),
        "best.obscured_percent", "best.native_m", "best.product_id",
        *[c(f"best.{name}").alias(name) for name in payload],
    )


STATUS_PRIORITY = (
    "AVAILABLE",
    "CLOUD_THRESHOLD_EXCEEDED",
    "PROCESSING_FAILED",
    "PROCESSING_PENDING",
    "INSUFFICIENT_FIELD_COVERAGE",
    "NO_FIELD_INTERSECTION",
)


def date_status(max_cloud: Column) -> Column:
    """Typed outcome of one exact-date candidate, gates in checking order."""
    return (
        F.when(c("scene_id").isNull(), "NO_FIELD_INTERSECTION")
        .when(~c("has_raster"), "PROCESSING_PENDING")
        .when(c("field_px").isNull(), "NO_FIELD_INTERSECTION")
        .when(c("coverage_percent") < dims.FIELD_MIN_COVERAGE, "INSUFFICIENT_FIELD_COVERAGE")
        .when(c("obscured_percent") > max_cloud, "CLOUD_THRESHOLD_EXCEEDED")
        .when(c("valid_px") < dims.FIELD_MIN_USABLE_PIXELS, "PROCESSING_FAILED")
        .otherwise("AVAILABLE")
    )


def field_dates(graded: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (request, date): the available scene or the most telling rejection."""
    available = c("status") == "AVAILABLE"
    priority = F.array_position(F.array(*[F.lit(s) for s in STATUS_PRIORITY]), c("status"))
    coverage = F.coalesce(c("coverage_percent"), F.lit(0.0))
    valid = F.coalesce(c("valid_px"), F.lit(0)).cast("double")
    best = F.min(F.struct(
        priority.alias("priority"),
        F.when(available, -c("usable_percent")).otherwise(-coverage).alias("k1"),
        F.when(available, -coverage).otherwise(-valid).alias("k2"),
        c("obscured_percent"), c("product_id"), c("status"), c("scene_id"),
        c("usable_percent"), c("coverage_percent"), c("valid_px"),
    )).alias("best")
    return graded.groupBy(*keys).agg(best).select(
        *keys, "best.status", "best.scene_id", "best.usable_percent", "best.coverage_percent",
        "best.obscured_percent", F.coalesce(c("best.valid_px"), F.lit(0)).alias("valid_px"),
    )


def field_sar(requests: DataFrame, cands: DataFrame, coverage: DataFrame, *, min_coverage: float = 95.0) -> DataFrame:
    """Nearest qualified radar scene per request, or the reason there is none.

    ``cands`` are the candidates, ``coverage`` is per (field, scene).
    """
    accepted = cands.where("status = 'accepted'").join(coverage, ["field_id", "scene_id"], "left")
    qualified = c("coverage_percent") >= min_coverage
    best = F.min(F.when(qualified, F.struct(
        "date_distance", (-c("coverage_percent")).alias("k_coverage"), "product_id", "scene_id",
        "acq_date", "coverage_percent",
    ))).alias("best")
    seen = accepted.groupBy("request_id").agg(
        best,
        F.count("*").alias("accepted"),
        F.count("field_px").alias("overlapping"),
        F.count_if(c("coverage_percent") < min_coverage).alias("low"),
    )
    days = F.datediff("best.acq_date", "request_date")
    reason = (
        F.when(c("best").isNotNull(), None)
        .when(F.coalesce(c("accepted"), F.lit(0)) == 0, "no_scene")
        .when(c("low") > 0, "low_coverage")
        .when(c("overlapping") == 0, "no_overlap")
        .otherwise("no_scene")
    )
    return requests.join(seen, "request_id", "left").select(
        "request_id", "field_id", "source_no", "request_date",
        c("best.scene_id").alias("scene_id"),
        c("best.acq_date").alias("acq_date"),
        days.alias("days_from_target"),
        c("best.coverage_percent").alias("coverage_percent"),
        F.when(c("best").isNotNull(), sar.confidence(days, c("best.coverage_percent"))).alias("confidence"),
        reason.alias("reason_code"),
    )


def history_pairs(selected: DataFrame, scenes: DataFrame, *, on: tuple[str, ...]) -> DataFrame:
    """Accepted scenes before each selected observation, within its request's own ``lookback_days``."""
    asked = selected.select(
        "request_id", "field_id", *on, "lookback_days", "max_observations", c("scene_id").alias("current_scene_id"), c("acq_date").alias("current_date"),
    )
    start = F.date_sub("current_date", c("lookback_days"))
    return join_date_range(asked, scenes.where("status = 'accepted'"), on=on, start=start, end=F.date_sub("current_date", 1))


def sar_history(pairs: DataFrame, coverage: DataFrame, *, min_coverage: float = 95.0) -> DataFrame:
    """Earlier qualified scenes of each selected observation, newest first, all within the look-back.

    ``within_limit`` marks the newest ``max_observations`` of the request.
    """
    good = pairs.join(coverage, ["field_id", "scene_id"]).where(c("coverage_percent") >= min_coverage)
    ranked = ranked_per(good, ["request_id"], [c("acq_date").desc(), c("product_id")], rank="position")
    return ranked.withColumn("within_limit", c("position") <= c("max_observations"))


def top_by_overlap(candidates_df: DataFrame, keys: list[str], k: int, *, by_product: bool = False) -> DataFrame:
    """Largest overlap first, then newest; optionally the product id decides ties. The first k are within_limit."""
    order = [c("overlap_area").desc(), c("acq_date").desc_nulls_last()]
    order += [c("product_id").desc()] if by_product else [c("item_no")]
    # Areas within some 9 % of each other and one day make a bin.
    size = F.when(c("overlap_area") > 0, F.floor(F.log2("overlap_area") * 8))
    return ranked_in_bins(candidates_df, keys, order, [(size, True), (F.substring(c("acq_date").cast("string"), 1, 10), True)], k)


def landsat_order() -> list[Column]:
    return [
        -c("overlap_ratio"), F.coalesce(c("cloud_percent"), F.lit(101.0)),
        F.coalesce(c("platform"), F.lit("")), c("product_id"),
    ]


def landsat_bins() -> list[tuple[Column, bool]]:
    """Coarser steps of the first two of landsat_order."""
    return [(F.floor(-c("overlap_ratio")), False), (F.floor(F.coalesce(c("cloud_percent"), F.lit(101.0))), False)]


def latest_exact_date(scenes: DataFrame, keys: list[str]) -> DataFrame:
    """All scenes that share the newest acquisition date of their group."""
    newest = scenes.groupBy(*keys).agg(F.max("acq_date").alias("acq_date"))
    return scenes.join(newest, [*keys, "acq_date"], "left_semi")
