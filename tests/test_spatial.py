"""Spans, joins and zonal statistics against brute force, and plan shapes."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agrolume.functions import geo
from agrolume.functions import polygons as poly
from agrolume.operators import georef, geometry, grid, raster, selection, spatial, zonal
from agrolume.plans.world import World
from agrolume.sources import pixels as pixel_source

c = F.col
SF = "/root/testdata/sf0.001"


def inside(rings, x, y):
    crossings = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and ax + (y - ay) * (bx - ax) / (by - ay) <= x:
                crossings += 1
    return crossings % 2 == 1


corner = st.tuples(st.integers(0, 40), st.integers(0, 40)).map(lambda p: (p[0] / 4, p[1] / 4))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(corner, min_size=3, max_size=7, unique=True))
def test_spans_match_point_tests(spark, ring):
    shape = F.array(F.array(poly.ring(*[(F.lit(x), F.lit(y)) for x, y in ring])))
    frame = spark.range(1).select(F.lit(1).alias("field_id"), shape.alias("geometry"))
    cells = {(r.rw, col) for r in spatial.spans(frame).collect() for col in range(r.c0, r.c1)}
    expected = {(y, x) for y in range(11) for x in range(11) if inside([ring], x + 0.5, y + 0.5)}
    assert cells == expected


def random_world(spark, rng, rows=3000):
    data = [
        (int(s), int(y), int(x), int(v))
        for s, y, x, v in zip(rng.integers(0, 5, rows), rng.integers(0, 40, rows), rng.integers(0, 40, rows), rng.integers(-10000, 10001, rows))
    ]
    seen = {(s, y, x): v for s, y, x, v in data}
    pixels = [(s, y, x, v if v % 7 else -32768) for (s, y, x), v in seen.items()]
    fields = [(i, float(i * 3), float(i * 2), float(i * 3 + 9), float(i * 2 + 11)) for i in range(8)]
    frame = spark.createDataFrame(pixels, "scene_id long, rw long, cl long, code int").withColumn("code", c("code").cast("short"))
    return pixels, fields, frame, spark.createDataFrame(fields, "field_id long, x0 double, y0 double, x1 double, y1 double")


@pytest.mark.parametrize("salt", [1, 4])
def test_zonal_statistics_match_numpy(spark, salt):
    pixels, fields, frame, field_frame = random_world(spark, np.random.default_rng(7))
    joined = spatial.join_field_pixels(frame, field_frame, salt=salt)
    got = {(r.field_id, r.scene_id): r for r in zonal.zonal_stats(joined).collect()}
    for fid, x0, y0, x1, y1 in fields:
        for scene in range(5):
            values = [v for s, y, x, v in pixels if s == scene and x0 <= x + 0.5 < x1 and y0 <= y + 0.5 < y1]
            if not values:
                assert (fid, scene) not in got
                continue
            row, good = got[fid, scene], np.array([v for v in values if v != -32768]) / 10000
            assert (row.field_px, row.valid_px) == (len(values), len(good))
            assert row.mean == pytest.approx(good.mean()) and row.median == pytest.approx(np.median(good))
            assert row.stddev == pytest.approx(good.std()) and (row["min"], row["max"]) == (good.min(), good.max())
            assert 0 <= row.usable_percent <= 100


def test_partitioning_does_not_change_answers(spark):
    _, _, frame, fields = random_world(spark, np.random.default_rng(3))

    def run(n):
        rows = zonal.zonal_stats(spatial.join_field_pixels(frame.repartition(n), fields)).collect()
        return sorted(tuple(r) for r in rows)

    assert run(1) == run(7)


def test_radar_percentiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(-15, 4, 301), 6)
    rows = [(1, 1, float(v), None) for v in values]
    frame = spark.createDataFrame(rows, "field_id long, scene_id long, hh double, hv double")
    got = zonal.sar_band_stats(frame).where("polarization = 'HH'").first()
    for p in (10, 25, 75, 90):
        assert got[f"p{p}"] == pytest.approx(np.percentile(values, p), abs=1e-6)
    assert got.stddev == pytest.approx(values.std(), abs=1e-6)
    empty = zonal.sar_band_stats(frame).where("polarization = 'HV'").first()
    assert (empty.valid_px, empty["median"], empty.field_px) == (0, None, 301)


def test_top_class_is_half_open(spark):
    frame = spark.createDataFrame([(1, 1, 0, 10000), (1, 1, 0, 7500)], "field_id long, scene_id long, source_no long, code int").withColumn(
        "code", c("code").cast("short")
    )
    profiles = spark.createDataFrame([(0, 0, "top", 0.75, 1.0, 100.0), (0, 1, "low", -1.0, 0.2, 100.0)],
                                     "source_no long, class_no int, label string, lower double, upper double, pixel_area double")
    got = {r.label: (r.area_m2, r.area_percent) for r in zonal.class_areas(frame, profiles).collect()}
    assert got == {"top": (100.0, 50.0), "low": (0.0, 0.0)}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_never_fall_back_to_nested_loops(spark):
    w = World(spark, SF)
    frames = lambda: (
        georef.join_pixels(w.pixels, w.field_spans),
        selection.join_request_scenes(w.requests, w.catalog, on=("source_no", "aoi_no")),
        selection.nearest_scene(w.requests, w.catalog, on=("source_no", "aoi_no")),
        geometry.join_boxes(w.fields, w.fields.selectExpr("field_id as other", "x0 as bx0", "y0 as by0", "x1 as bx1", "y1 as by1"), on=[]),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            for df in frames():
                text = plan(df)
                assert "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_window_scan_prunes_partitions_rows_and_columns(spark, tmp_path):
    w = World(spark, SF)
    pixel_source.write_pixels(w.pixels, f"{tmp_path}/px", tile=8)
    stored = pixel_source.read_pixels(spark, f"{tmp_path}/px")
    scan = pixel_source.scan_window(stored, source_no=0, ym=(23952, 23960), rows=(0, 5), columns=["scene_id", "rw", "cl", "red_dn"])
    text = plan(scan)
    assert "PartitionFilters: [isnotnull(source_no" in text
    assert "GreaterThanOrEqual(rw,0)" in text and "LessThanOrEqual(rw,5)" in text
    assert "nir_dn" not in text.split("ReadSchema")[1]
    assert scan.count() == w.pixels.where("source_no = 0 and ym between 23952 and 23960 and rw between 0 and 5").count()


def test_candidates_leave_none_out(spark):
    w = World(spark, SF)
    keys = ("source_no", "aoi_no")
    pairs = selection.join_request_scenes(w.requests, w.catalog, on=keys)
    ranked = selection.candidates(w.requests, w.catalog, on=keys, limit=3)
    assert ranked.count() == pairs.count() > ranked.where("within_limit").count() > 0
    assert ranked.where("within_limit <> (rank <= 3)").count() == 0


def test_geo_accuracy(spark):
    cell = poly.rectangle(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    got = spark.range(1).select(geo.area_km2(cell).alias("a"), geo.utm_epsg(F.lit(77.6), F.lit(12.97)).alias("e")).first()
    # Numeric integral of the cell between parallels, and the published geodesic
    # area of the same corners: edges differ by 2.6e-5 at one degree, and by the
    # square of the edge length below that (5e-8 for a 5 km field).
    lat = np.radians((np.arange(100000) + 0.5) / 100000)
    strip = geo.A_METRES**2 * (1 - geo.E2) * np.cos(lat) / (1 - geo.E2 * np.sin(lat) ** 2) ** 2
    assert got.a == pytest.approx(strip.mean() * np.radians(1) ** 2 / 1e6, rel=1e-9)
    assert got.a == pytest.approx(12308.778, rel=3e-5)
    assert got.e == 32643
    pts = spark.createDataFrame([(float(x) / 10, float(y)) for x in range(-1795, 1800, 137) for y in range(-80, 81, 13)], "lon double, lat double")
    zone = geo.utm_zone(c("lon"))
    e, n = geo.utm_forward(c("lon"), c("lat"), zone)
    lon, lat = geo.utm_inverse(c("e"), c("n"), c("z"), c("lat") < 0)
    err = pts.select("lon", "lat", zone.alias("z"), e.alias("e"), n.alias("n")).select(
        F.max(F.greatest(F.abs(lon - c("lon")), F.abs(lat - c("lat")))).alias("m")
    ).first().m
    assert err < 1e-9


def test_clip_matches_rectangles_and_triangles(spark):
    lit = F.lit
    square = poly.ring((lit(0.0), lit(0.0)), (lit(4.0), lit(0.0)), (lit(4.0), lit(4.0)), (lit(0.0), lit(4.0)))
    triangle = poly.ring((lit(0.0), lit(0.0)), (lit(8.0), lit(0.0)), (lit(0.0), lit(8.0)))
    far = poly.ring((lit(9.0), lit(9.0)), (lit(10.0), lit(9.0)), (lit(10.0), lit(10.0)))
    got = spark.range(1).select(
        geometry.overlap_ratio(square, triangle).alias("t"), geometry.overlap_ratio(square, far).alias("f"),
        geometry.overlap_ratio(triangle, square).alias("s"),
    ).first()
    assert (got.t, got.f, got.s) == (1.0, 0.0, 0.5)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(corner, min_size=3, max_size=6, unique=True), st.tuples(st.integers(0, 20), st.integers(0, 20)))
def test_clipped_area_is_additive(spark, ring, at):
    """A ring that bends or crosses itself as it likes: two halves of a box cut from it what the whole box does."""
    x, y = at[0] / 4, at[1] / 4
    box = lambda a, b, p, q: poly.ring((F.lit(a), F.lit(b)), (F.lit(p), F.lit(b)), (F.lit(p), F.lit(q)), (F.lit(a), F.lit(q)))
    subject = poly.ring(*[(F.lit(float(a)), F.lit(float(b))) for a, b in ring])
    signed = lambda clip: geometry._twice_area(geometry.clipped(subject, clip))
    got = spark.range(1).select(
        signed(box(x, y, x + 4, y + 3)).alias("whole"), signed(box(x, y, x + 1.5, y + 3)).alias("left"), signed(box(x + 1.5, y, x + 4, y + 3)).alias("right"),
        signed(poly.ring((F.lit(x), F.lit(y)), (F.lit(x), F.lit(y + 3)), (F.lit(x + 4), F.lit(y + 3)), (F.lit(x + 4), F.lit(y)))).alias("other_way"),
        signed(box(-1.0, -1.0, 12.0, 12.0)).alias("all"),
    ).first()
    area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))
    assert got.left + got.right == pytest.approx(got.whole, abs=1e-9) and got.other_way == pytest.approx(got.whole, abs=1e-9)
    assert got.all == pytest.approx(area, abs=1e-9)


def test_two_zones_and_two_resolutions(spark):
    """One field across the border of two zones, on rasters of 10 m and 30 m: pixel for pixel as a point-by-point projection."""
    lon0, lat0, lon1, lat1 = 77.9985, 17.0, 78.0015, 17.0025
    grids = []
    for no, (zone, res) in enumerate([(43, 10.0), (43, 30.0), (44, 10.0), (44, 30.0)]):
        z = F.lit(zone)
        e, n = (c.alias(k) for c, k in zip(geo.utm_forward(F.lit(lon0), F.lit(lat1), z), "en"))
        corner_ = spark.range(1).select(e, n).first()
        grids.append((no, 32600 + zone, res, 0.0, corner_.e // res * res - 5 * res, 0.0, -res, corner_.n // res * res + 5 * res, 0, 0, 40, 45))
    frame = spark.createDataFrame(grids, "grid_no long, epsg long, a double, b double, c double, d double, e double, f double, row0 long, col0 long, height long, width long")
    field = spark.createDataFrame([(7, lon0, lat0, lon1, lat1)], "field_id long, lon0 double, lat0 double, lon1 double, lat1 double")
    spans = georef.field_spans(georef.lonlat_boxes(field, keep=("field_id",)), frame)
    got = {(r.grid_no, r.rw, x) for r in spans.collect() for x in range(r.c0, r.c1)}
    cells = frame.select("*", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("rw")).select("*", F.explode(F.sequence(F.lit(0), F.lit(44))).alias("cl"))
    x, y = c("c") + c("a") * (c("cl") + 0.5), c("f") + c("e") * (c("rw") + 0.5)
    lon, lat = geo.utm_inverse(x, y, (c("epsg") % 100).cast("int"), F.lit(False))
    inside_ = cells.select("grid_no", "rw", "cl", lon.alias("lon"), lat.alias("lat")).where((c("lon") >= lon0) & (c("lon") < lon1) & (c("lat") >= lat0) & (c("lat") < lat1))
    want = {(r.grid_no, r.rw, r.cl) for r in inside_.collect()}
    assert got and len(got ^ want) <= 0.002 * len(want)  # edges are straight in the raster's projection
    assert {g for g, _, _ in got} == {0, 1, 2, 3}
    pixels = spark.createDataFrame([(g, g, r, k) for g, r, k in sorted(want)], "scene_id long, grid_no long, rw long, cl long")
    joined = georef.join_pixels(pixels, spans)
    assert joined.count() == len(got & want) and "NestedLoop" not in plan(joined)


def test_only_wanted_pairs_are_read(spark):
    w = World(spark, SF)
    wanted = w.fields.join(w.scenes.where("ym % 12 = 3"), "site").select("field_id", "scene_id", "grid_no")
    text = plan(zonal.gate_counts(georef.join_wanted(raster.coded(w.pixels), w.field_spans, wanted)))
    assert "LeftSemi" in text and "NestedLoop" not in text
    every = georef.join_pixels(raster.coded(w.pixels), w.field_spans).join(wanted.drop("grid_no"), ["field_id", "scene_id"])
    assert georef.join_wanted(raster.coded(w.pixels), w.field_spans, wanted).count() == every.count() > 0


def test_axis_steps_cross_chunk_borders(spark):
    good = [("a", i, i * 2.0) for i in range(50)]
    bad = [("b", i, i * 2.0 + (0.5 if i >= 20 else 0.0)) for i in range(50)]
    frame = spark.createDataFrame(good + bad, "k string, p long, v double")
    got = {r.k: (r.steps, r.spacing, r.uniform) for r in grid.axis_regularity(frame, key="k", position="p", value="v", chunk=10).collect()}
    assert got == {"a": (49, 2.0, True), "b": (49, 2.0, False)}


def test_no_registered_plan_degenerates(spark):
    """Without broadcasts every join is still an equi-join and nothing meets in one task."""
    import __spark_entry__ as entry

    runs_on_build = ("stream_", "write_derived", "op", "pipeline")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key, build in entry.queries().items():
            if key.startswith(runs_on_build):
                continue
            text = plan(build(spark, SF))
            for word in ("NestedLoop", "Cartesian", "SinglePartition", "BatchEvalPython"):
                assert word not in text, (key, word)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
