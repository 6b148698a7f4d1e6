"""Steps whose work or memory once grew faster than their tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import polygons as poly
from agrolume.operators import georef, geometry, selection, temporal, zonal
from agrolume.plans import load
from agrolume.plans.registry import as_callables
from agrolume.plans.world import World
from agrolume.session import tune

load()
BUILDS = as_callables()
c = F.col


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_products_are_ranked_by_scene(spark):
    day = datetime.date(2020, 1, 5)
    scenes = spark.createDataFrame([(0, 1, n, day, "P7") for n in range(300, 0, -1)], "source_no long, aoi_no long, scene_id long, acq_date date, product_id string")
    asked = spark.createDataFrame([(1, 0, 1, day)], "request_id long, source_no long, aoi_no long, request_date date")
    ranked = selection.candidates(asked, scenes, on=("source_no", "aoi_no")).orderBy("rank").collect()
    assert [r.scene_id for r in ranked] == list(range(1, 301))


def test_exploded_tables_are_not_broadcast_by_their_file_size(spark, tmp_path):
    tune(spark)
    spark.range(40_000).write.parquet(str(tmp_path / "asked"))
    asked = spark.read.parquet(str(tmp_path / "asked")).withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(9))))
    assert "BroadcastHashJoin" not in plan(asked.join(spark.range(1 << 40).withColumnRenamed("id", "day"), "day"))


def test_box_footprints_are_covered_like_clipped_ones(spark):
    day = datetime.date(2020, 1, 5)
    views = spark.createDataFrame([(1, 0, day, day, 1.0, 1.0, 3.0, 2.0)], "request_id long, source_no long, start_date date, end_date date, x0 double, y0 double, x1 double, y1 double")
    corners = {
        1: [(0, 0), (2, 0), (2, 1.5), (0, 1.5), (0, 0)],
        2: [(0, 0), (0, 1.5), (2, 1.5), (2, 0), (0, 0)],
        3: [(0, 0), (1, 0), (2, 0), (2, 1.5), (0, 1.5), (0, 0)],
        4: [(0, 0), (2, 0), (1.5, 1.5), (0, 1.5), (0, 0)],
    }
    rows = [(0, n, day, [[[(float(x), float(y)) for x, y in ring]]]) for n, ring in corners.items()]
    scenes = spark.createDataFrame(rows, f"source_no long, scene_id long, acq_date date, footprint {poly.POLYGONS}")
    boxes = {r.scene_id: r.b for r in scenes.select("scene_id", poly.is_box(c("footprint")).alias("b")).collect()}
    assert boxes == {1: True, 2: True, 3: False, 4: False}
    shares = {r.scene_id: r.coverage_percent for r in geometry.meet_viewports(views, scenes).collect()}
    assert abs(shares[1] - shares[3]) < 1e-9 and abs(shares[2] - shares[3]) < 1e-9
    assert 0 < shares[4] < shares[1] < 26


def degree_grid(spark):
    return spark.createDataFrame(
        [(1, 4326, 1.0, 0.0, 0.0, 0.0, -1.0, 10.0, 0, 0, 10, 10)],
        "grid_no long, epsg long, a double, b double, c double, d double, e double, f double, row0 long, col0 long, height long, width long",
    )


def test_points_are_placed_once_and_laid_over_the_scenes_of_their_grid(spark):
    geometry_ = poly.rectangle(F.lit(0.0), F.lit(0.0), F.lit(5.0), F.lit(5.0))
    points = spark.createDataFrame([(7, 1, 2.5, 2.5), (8, 1, 7.5, 2.5)], "request_id long, grid_no long, lon double, lat double").withColumn("geometry", geometry_)
    scenes = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "scene_id long, grid_no long")
    codes = spark.createDataFrame([(10, 7, 2, 2500), (10, 7, 7, 1)], "scene_id long, rw long, cl long, code int")
    found = georef.sample_points(codes, points, degree_grid(spark), scenes).collect()
    assert sorted((r.request_id, r.scene_id, r.value, r.masked) for r in found if r.value is not None) == [(7, 10, 0.25, False)]
    assert sorted((r.request_id, r.scene_id) for r in found if r.masked) == [(7, 11), (8, 10), (8, 11)]


def test_projecting_is_spread_also_where_grids_are_few(spark):
    fields = spark.createDataFrame([(1, 1.0, 1.0, 4.0, 4.0)], "field_id long, lon0 double, lat0 double, lon1 double, lat1 double")
    met = georef.on_grids(georef.lonlat_boxes(fields, keep=("field_id",)), degree_grid(spark))
    assert "SortMergeJoin" in plan(met) and "BroadcastHashJoin" not in plan(met)
    assert met.count() == 1


def test_fixed_dimensions_are_broadcast_so_that_a_source_is_not_one_task(spark):
    tune(spark)
    rows = spark.range(1 << 40).select((c("id") % 7).alias("source_no"), "id")
    for dim in (dims.source_dim, dims.index_role_dim, dims.mask_policy_dim, dims.threshold_profiles_dim):
        joined = plan(rows.join(dim(spark).select("*"), "source_no"))
        assert "BroadcastHashJoin" in joined and "SortMergeJoin" not in joined


def test_a_scan_task_reads_no_more_of_a_larger_file(spark, tmp_path):
    tune(spark)
    # 8 cores, 160 MB: by bytes per core a task would read 20 MB.
    spark.range(8).repartition(1).select("id", F.expr("repeat('x', 8)").alias("t")).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("*.parquet"))
    with part.open("r+b") as f:
        body = f.read()
        f.seek(0)
        f.write(body[:4] + b"\0" * (160 << 20) + body[4:])
    assert spark.read.schema("id long, t string").parquet(str(tmp_path / "t")).rdd.getNumPartitions() >= 10


def test_radar_medians_are_taken_in_the_row_of_their_field_and_scene(spark):
    rows = [(1, 1, -12.5, -20.0), (1, 1, -11.0, None), (1, 1, -10.0, -21.0), (1, 1, None, -23.0), (1, 2, None, None), (2, 1, -7.000001, -9.0), (2, 1, -7.0, -9.0)]
    pixels = spark.createDataFrame(rows, "field_id long, scene_id long, hh double, hv double")
    got = zonal.sar_common_coverage(pixels)
    assert "Window" not in plan(got)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == [
        (1, 1, 4, 2, 50.0, -11.0, -21.0, 10.0), (1, 2, 1, 0, 0.0, None, None, None), (2, 1, 2, 2, 100.0, -7.0000005, -9.0, 9.0 - 7.0000005),
    ]


def test_the_baseline_brings_a_history_together_once(spark):
    past = spark.createDataFrame(
        [(1, float(v), None if v == 3 else v * 2.0, None) for v in (1, 2, 3, 5, 8, 13)] + [(2, 1.0, 1.0, 1.0)], "request_id long, hh_median double, hv_median double, hh_minus_hv double"
    )
    now = spark.createDataFrame([(1, 6.0, 4.0, 1.0), (2, 1.0, 1.0, 1.0)], past.schema)
    got = temporal.robust_baseline(now, past)
    assert plan(got).count("Join") == 1 and "percentile" not in plan(got) and "median(" not in plan(got)
    found = {(r.request_id, r.feature): (r.baseline_median, r.mad, r.observations) for r in got.collect()}
    assert found == {(1, "hh_median"): (4.0, 2.5, 6), (1, "hv_median"): (10.0, 6.0, 5)}


def test_a_filter_on_sources_reaches_the_scan_of_the_blocks(spark):
    read = World(spark, "/root/testdata/sf0.001").pixels_sar._jdf.queryExecution().optimizedPlan().toString()
    assert read.rindex("Filter") > read.rindex("Aggregate")
    assert "l_suppkey" in read[read.rindex("Filter"):].splitlines()[0] and "IN (5,6)" in read[read.rindex("Filter"):].splitlines()[0]


def test_cells_are_distinct_before_they_meet_fields(spark):
    read = BUILDS["pixel_area"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    cell_join = read.index("cell_key")
    assert "Aggregate [grid_no" in read[cell_join:]


def test_bilinear_brings_targets_and_cells_together_once(spark):
    from agrolume.operators import grid

    values = {(r, q): None if (r * 7 + q) % 11 == 0 else float((r * 31 + q * 17) % 97) for r in range(-3, 21) for q in range(-5, 14) if (r + q) % 13}
    rows = [(1, r, q, v) for (r, q), v in values.items()] + [(1, 2, 3, values[2, 3])]  # a repeated cell weighs twice
    wanted = [(r, q) for r in range(-8, 46) for q in range(-12, 30)]
    targets = spark.createDataFrame([(1, r, q) for r, q in [*wanted, wanted[500]]], "scene_id long, rw long, cl long")
    source = spark.createDataFrame(rows, "scene_id long, rw long, cl long, red double")
    got = grid.resample_bilinear(targets, source, ratio=0.5, shift=0.1, value="red")
    assert "Join" not in plan(got) and plan(got).count("Exchange hashpartitioning") == 1
    expected = {}
    for r, q in wanted:
        y, x = (r + 0.5) * 0.5 + 0.1 - 0.5, (q + 0.5) * 0.5 + 0.1 - 0.5
        wv = w = 0.0
        for dr in (0, 1):
            for dc in (0, 1):
                at = (int(y // 1) + dr, int(x // 1) + dc)
                weight = abs(1 - dr - y % 1) * abs(1 - dc - x % 1) * (2 if at == (2, 3) else 1)
                if values.get(at) is not None:
                    wv, w = wv + weight * values[at], w + weight
        if w:
            expected[r, q] = wv / w
    found = got.collect()
    assert len(found) == len(expected)
    assert all(abs(r.red - expected[r.rw, r.cl]) < 1e-9 for r in found)


def test_derived_rasters_are_ranged_as_pixels_and_not_sorted_again(spark, tmp_path):
    from agrolume.operators import raster
    from agrolume.sources import pixels as pixel_source

    pixels = World(spark, "/root/testdata/sf0.001").pixels.where("ym % 24 = 0").localCheckpoint()
    by_index = raster.by_index(raster.coded(pixels))
    assert "array_compact" not in plan(by_index) and "named_struct" not in plan(by_index).split("Generate")[1].split("\n")[0]
    pixel_source.write_index_partitions(pixels, str(tmp_path / "derived"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    back = spark.read.parquet(str(tmp_path / "derived")).select(by_index.columns)
    expected = by_index.select([c(n).cast(t) for n, t in back.dtypes])
    assert back.count() > 0 and back.exceptAll(expected).isEmpty() and expected.exceptAll(back).isEmpty()


def test_threshold_classes_are_counted_where_pixels_were_gathered(spark):
    text = plan(BUILDS["zonal_class_areas"](spark, "/root/testdata/sf0.001"))
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # The profiles are a broadcast: neither the histogram nor the classes are shuffled.
    assert shuffles and not [line for line in shuffles if "index_name" in line or "class_no" in line]


def test_pixels_of_candidates_are_shuffled_once(spark):
    from agrolume.plans import selection_queries

    w = World(spark, "/root/testdata/sf0.001")
    text = plan(selection_queries.graded_options(w))
    # Scenes are chosen among blocks; no pixel row is shuffled by its scene, and no hash of keys is sent along.
    assert "LeftSemi" in text and "xxhash64" not in text
    assert not [line for line in text.splitlines() if "Exchange hashpartitioning(field_id" in line and "source_no" in line]
    semi = text[text.index("LeftSemi"):]
    left = semi[:semi.index("HashAggregate")]
    assert "explode([0,1,2,3])" not in left and text.index("explode([0,1,2,3])") < text.index("LeftSemi")


def test_the_pairs_of_a_narrow_choice_are_counted_alike(spark):
    from agrolume.operators import raster

    w = World(spark, "/root/testdata/sf0.001")
    wanted = w.fields.join(w.scenes.where("ym % 12 = 3"), "site").select("field_id", "scene_id", "grid_no")
    few = zonal.gate_counts(georef.join_wanted(raster.with_flags(raster.coded(w.pixels_of(wanted))), w.field_spans, wanted, asked_only=True))
    every = zonal.gate_counts(georef.join_pixels(raster.coded(w.pixels), w.field_spans)).join(wanted.drop("grid_no"), ["field_id", "scene_id"]).select(few.columns)
    assert few.count() > 0 and few.exceptAll(every).isEmpty() and every.exceptAll(few).isEmpty()


def test_streamed_histograms_are_shuffled_once_when_read(spark):
    got = BUILDS["stream_zonal_stats"](spark, "/root/testdata/sf0.001")
    shuffles = [line for line in plan(got).splitlines() if "Exchange" in line]
    # As pixels with a code per index: neither a row per index nor a histogram is sent.
    assert len(shuffles) == 1 and "index_name" not in shuffles[0]
    batch = BUILDS["zonal_stats"](spark, "/root/testdata/sf0.001").select(got.columns)
    assert got.count() > 0 and got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def search_world(spark):
    """Viewports from points to half the plane, scenes of all sizes, some of them without a cloud figure."""
    start = datetime.date(2020, 1, 1)
    views, scenes = [], []
    for n in range(60):
        wide, high = ((0.5, 0.25), (2.0, 1.0), (5.0, 5.0), (17.0, 3.0), (3.0, 90.0))[n % 5]
        x, y = (n * 37) % 101 - 50.0, (n * 53) % 97 - 45.0
        first = start + datetime.timedelta(days=(n * 29) % 200)
        views.append((n, n % 2, first, first + datetime.timedelta(days=(n * 11) % 300 - 5), 20.0 + n % 3 * 30, x, y, x + wide, y + high))
    for n in range(900):
        x, y, size = (n * 61) % 103 - 52.0, (n * 43) % 99 - 48.0, (0.0, 1.5, 6.0, 31.0)[n % 4]
        ring = [[[(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]]]
        scenes.append((n % 2, n, start + datetime.timedelta(days=(n * 17) % 500), f"P{n % 400}", "discovered" if n % 9 == 0 else "accepted", None if n % 11 == 0 else float(n * 7 % 101), ring))
    views = spark.createDataFrame(views, "request_id long, source_no long, start_date date, end_date date, max_cloud double, x0 double, y0 double, x1 double, y1 double")
    return views, spark.createDataFrame(scenes, f"source_no long, scene_id long, acq_date date, product_id string, status string, cloud_percent double, footprint {poly.POLYGONS}")


def test_a_search_ranks_pairs_where_they_met(spark):
    tune(spark)
    views, scenes = search_world(spark)
    got = geometry.spatial_search(views, scenes, limit=20)
    expected = selection.ranked_per(geometry.found_scenes(views, scenes), ["request_id"], [c("acq_date").desc(), c("product_id"), c("scene_id")], 20)
    names = ["request_id", "scene_id", "acq_date", "product_id", "coverage_percent", "rank", "within_limit"]
    rows = [tuple(r) for r in got.select(names).collect()]
    assert sorted(rows) == sorted(tuple(r) for r in expected.select(names).collect()) and len(rows) > 100
    # The last shuffle is that of viewports and scenes on their way to each other.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(geometry.spatial_search(views, scenes, limit=20))
    tune(spark)
    top = next(line for line in text.splitlines() if "Exchange hashpartitioning" in line)
    assert "source_no" in top and "cell_x" in top and "NestedLoop" not in text
