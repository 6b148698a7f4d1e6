"""Small known answers of pixel maths, masks, composites, radar and text."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agrolume.functions import bands, indices, masks, render, sar, text
from agrolume.operators import catalog, composite, temporal

c = F.col


def one(spark, **columns):
    row = spark.range(1).select(*[value.alias(name) for name, value in columns.items()]).first()
    return row.asDict()


def test_index_values(spark):
    lit = F.lit
    got = one(
        spark,
        code=indices.encode(indices.normalized_difference(lit(0.6), lit(0.2))),
        flat=indices.encode(indices.normalized_difference(lit(1e-7), lit(1e-7))),
        reci=indices.encode_reci(indices.reci(lit(0.6), lit(0.3))),
        floor=indices.encode_reci(indices.reci(lit(0.6), lit(0.00001))),
        clipped=indices.encode(lit(1.7)),
        nothing=indices.decode(lit(-32768).cast("short")),
        back=indices.decode(lit(6500).cast("short")),
    )
    assert got == {
        "code": 5000, "flat": -32768, "reci": 1.0, "floor": -9999.0, "clipped": 10000, "nothing": None, "back": 0.65,
    }
    with pytest.raises(ValueError):
        indices.index_value("unknown", lit(1.0), lit(1.0))


def test_landsat_reflectance(spark):
    rows = spark.createDataFrame([(0,), (1,), (7273,), (18639,)], "dn long").select(
        bands.reflectance_landsat(c("dn")).alias("r")
    )
    got = [r.r for r in rows.collect()]
    assert got[0] is None
    assert got[1] == pytest.approx(-0.1999725)
    assert got[2] == pytest.approx(7273 * 2.75e-5 - 0.2)


def test_landsat_classes(spark):
    words = [0, 1 << 7, 1 << 5, 1 << 4, 1 << 3, (1 << 7) | (1 << 3), 1]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w long")
    got = rows.select("i", masks.landsat_class(c("w"), F.lit(0)).alias("m")).orderBy("i").collect()
    assert [r.m for r in got] == [1, 4, 5, 3, 2, 2, 0]
    assert one(spark, m=masks.landsat_class(F.lit(0), F.lit(1 << 11)))["m"] == 0


def test_resourcesat_water_beats_cloud_only_with_short_wave(spark):
    def cls(g, r, n, s, has):
        return one(spark, m=masks.resourcesat_class(F.lit(g), F.lit(r), F.lit(n), F.lit(s), F.lit(has)))["m"]

    assert cls(6000, 2000, 2000, 2500, True) == 4
    assert cls(4000, 3000, 3500, 2500, True) == 2
    assert cls(800, 800, 800, 800, True) == 3
    assert cls(0, 800, 800, 800, True) == 0
    assert cls(3000, 3000, 4000, 0, False) == 2
    assert cls(1000, 900, 4000, 0, False) == 1


def test_composite_prefers_newest_valid_pixel(spark):
    older, newer = dt.date(2026, 3, 5), dt.date(2026, 3, 19)
    rows = [
        (0, 0, 1, older, 1, 10), (0, 1, 1, older, 2, 20), (1, 0, 1, older, 0, 30), (1, 1, 1, older, 3, 40),
        (0, 0, 2, newer, 1, 50), (0, 1, 2, newer, 1, 60), (1, 0, 2, newer, 4, 70), (1, 1, 2, newer, 0, 80),
    ]
    aoi = spark.createDataFrame(rows, "rw int, cl int, scene_id long, acq_date date, mask int, b long").where(
        "not (rw = 1 and cl = 1)"
    )
    made = composite.best_available(aoi, keys=["rw", "cl"], bands=["b"])
    assert {(r.rw, r.cl): (r.b, r["mask"]) for r in made.collect()} == {(0, 0): (50, 1), (0, 1): (60, 1), (1, 0): (70, 4)}
    measured = composite.metrics(made.withColumn("k", F.lit(1)), keys=["k"]).first()
    assert (measured.aoi_px, measured.coverage_percent, measured.usable_percent) == (3, 100.0, 100.0)
    # Covered but never valid: the earliest covered pixel stays.
    cloudy = spark.createDataFrame([(0, 1, older, 3, 1), (0, 2, newer, 2, 2)], "rw int, scene_id long, acq_date date, mask int, b long")
    assert composite.best_available(cloudy, keys=["rw"], bands=["b"]).first().b == 1


def test_robust_baseline(spark):
    history = [(1, float(v), None, None) for v in (-10, -10.5, -9.5, -11, -9)]
    past = spark.createDataFrame(history, "request_id long, hh_median double, hv_median double, hh_minus_hv double")
    now = spark.createDataFrame([(1, -8.0, None, None)], past.schema)
    got = temporal.robust_baseline(now, past).first()
    assert (got.baseline_median, got.mad) == (-10.0, 0.5)
    assert got.robust_deviation == pytest.approx(0.67448975 * 2.0 / 0.5)
    assert temporal.robust_baseline(now, past, minimum=6).count() == 0
    same = spark.createDataFrame([(1, -10.0, None, None)] * 5, past.schema)
    assert temporal.robust_baseline(now, same).first().robust_deviation is None


def test_radar_scalars(spark):
    got = one(
        spark,
        db=sar.gamma0_db(F.lit(10.0), 0.0, 3.0), none=sar.gamma0_db(F.lit(2.0), 4.0, 0.0),
        zero=sar.power_db(F.lit(0.0)), high=sar.confidence(F.lit(-3), F.lit(95.0)),
        low=sar.confidence(F.lit(12), F.lit(96.0)), no=sar.confidence(F.lit(1), F.lit(94.9)),
    )
    assert got == {"db": 17.0, "none": None, "zero": None, "high": "high", "low": "low", "no": "none"}


def test_tolerances_are_strict(spark):
    base = {n: "x" for n in temporal.REQUIRED} | {"incidence_deg": 30.0, "pixel_spacing_m": 18.0, "complete": True}

    def reasons(**changes):
        both = {"a": base, "b": base | changes}
        cols = [F.struct(*[F.lit(v).alias(k) for k, v in both[s].items()]).alias(s) for s in ("a", "b")]
        return spark.range(1).select(*cols).select(temporal.comparison_reasons("a", "b").alias("r")).first().r

    assert reasons() == []
    assert reasons(incidence_deg=31.0, pixel_spacing_m=18.5) == []
    assert reasons(incidence_deg=31.01) == ["INCIDENCE_ANGLE_MISMATCH"]
    assert reasons(software="y", track_key="z") == ["PROCESSING_SOFTWARE_MISMATCH", "TRACK_MISMATCH"]
    assert reasons(complete=False, track_key="z") == ["METADATA_INCOMPLETE"]


def test_rendering(spark):
    lit = F.lit
    got = one(
        spark, end=render.ndvi_colour(lit(1.4)), start=render.ndvi_colour(lit(-2.0)), mid=render.ndvi_colour(lit(0.45)),
        top=render.gray_level(lit(9.0)), half=render.gray_level(lit(-10.0)), edge=render.contrast_colour(lit(1.0), lit(0.0), lit(1.0)),
    )
    assert got == {"end": "#005825", "start": "#13187d", "mid": "#fac909", "top": 255, "half": 128, "edge": "#0b5d37"}


def test_text_cleaning(spark):
    lit = F.lit
    got = one(
        spark,
        stamp=F.date_format(text.provider_datetime(lit("07-Mar-2024 05:06:07.123456789")), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        bad=text.provider_datetime(lit("soon")), missing=text.clean_text(lit(" n/a ")), number=text.number(lit("-9999")),
        count=text.positive_integer(lit("12.0")), half=text.positive_integer(lit("1.5")),
        pols=text.normalize_polarizations(lit("vv;HH xx,hv")),
        url=text.redact_url(lit("https://h/p?sig=abc&x=1&X-Amz-Date=2")), plain=text.redact_url(lit("https://h/p")),
        note=text.redact_text(lit("Cookie: a=b; c=d")), tile=text.mgrs_tile(lit(None), lit("MGRS-43PGQ"), lit(1), lit("P"), lit("GR")),
    )
    assert got == {
        "stamp": "2024-03-07 05:06:07.123456", "bad": None, "missing": None, "number": None, "count": 12, "half": None,
        "pols": ["HH", "HV", "VV"], "url": "https://h/p?sig=[REDACTED]&x=1&X-Amz-Date=[REDACTED]", "plain": "https://h/p",
        "note": "Cookie: [REDACTED]", "tile": "T43PGQ",
    }


def test_upsert_keeps_identity_and_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, 10, "x"), ("b", 1, 11, "y")], "k string, version int, id int, status string")
    new = spark.createDataFrame([("a", 2, 99, "z"), ("c", 2, 12, "w")], old.schema)
    once = catalog.upsert(old, new, keys=["k"], version="version", keep_first=["id"])
    got = {r.k: (r.id, r.status) for r in once.collect()}
    assert got == {"a": (10, "z"), "b": (11, "y"), "c": (12, "w")}
    twice = catalog.upsert(once.select(*old.columns), new, keys=["k"], version="version", keep_first=["id"])
    # A replay keeps the status; the id was already settled in the first run.
    assert {r.k: r.status for r in twice.collect()} == {k: v[1] for k, v in got.items()}
