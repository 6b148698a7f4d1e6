"""Rules of item and metadata profiles, one fault at a time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from agrolume.operators import validation as v

GOOD = {"ProductType": "L2B-ARD-PRODUCT", "SatID": " eos-04 ", "Sensor": "SAR", "ImagingMode": "MRS", "RTC_Apply_Flag": "1", "Missing_Frames_Flag": "0",
        "NoOfPolarizations": "2", "TxRxPol1": "hh", "TxRxPol2": "HV", "IncidenceAngle": "35.5", "OutputPixelSpacing": "18"}
FAULTS = [
    ({}, []), ({"ProductType": "L1"}, ["ProductType"]), ({"SatID": None}, ["SatID"]), ({"Sensor": "X", "RTC_Apply_Flag": "0"}, ["Sensor", "RTC_Apply_Flag"]),
    ({"Missing_Frames_Flag": "1"}, ["Missing_Frames_Flag"]), ({"NoOfPolarizations": "x"}, ["NoOfPolarizations"]), ({"NoOfPolarizations": "0"}, ["NoOfPolarizations"]),
    ({"NoOfPolarizations": "3"}, ["TxRxPol unknown"]), ({"TxRxPol2": "HH"}, ["TxRxPol repeated"]), ({"TxRxPol1": "XX"}, ["TxRxPol unknown"]),
    ({"NoOfPolarizations": "1", "TxRxPol2": "XX"}, []), ({"IncidenceAngle": "-9999"}, ["IncidenceAngle"]), ({"OutputPixelSpacing": "-1"}, ["OutputPixelSpacing"]),
]


def test_eos04(spark):
    rows = [(k, {**GOOD, **change}) for k, (change, _) in enumerate(FAULTS)]
    df = spark.createDataFrame(rows, "k int, m map<string,string>")
    got = {r.k: r.p for r in df.select("k", v.problems(v.eos04_rules(F.col("m"))).alias("p")).collect()}
    assert got == {k: want for k, (_, want) in enumerate(FAULTS)}


SCHEMA = (
    "k int, product_id string, platform string, collection_number string, category string, correction string, "
    "assets array<struct<key:string,common_name:string,scale:double,offset:double,nodata:double,resolution:double,media_type:string>>"
)
COG = "image/tiff; application=geotiff; profile=cloud-optimized"


def item(k, drop=(), product="LC08_L2SP_146039_20240105_02_T1", platform="landsat-8", number=None, category=None, correction=None, **facts):
    assets = []
    for key in (*v.LANDSAT_REFLECTANCE, *v.LANDSAT_QUALITY):
        one = {"key": key, "common_name": key, "scale": 2.75e-5, "offset": -0.2, "nodata": 0.0, "resolution": 30.0, "media_type": COG}
        assets += [] if key in drop else [{**one, **(facts if key in ("red", "qa_pixel") else {})}]
    return (k, product, platform, number, category, correction, assets)


def test_landsat(spark):
    cases = [
        (item(0), []), (item(1, number="2", category="t1", correction="L2SP"), []), (item(2, platform="landsat-7"), ["unsupported platform"]),
        (item(3, product=None), ["product id is not collection 2 tier 1 level 2"]), (item(4, platform="landsat-9"), ["product id conflicts with platform"]),
        (item(5, number="01", category="T2", correction="L2SR"), ["not collection 2", "not category T1", "product id conflicts with correction"]),
        (item(6, drop=("red", "blue")), ["missing assets: blue, red"]), (item(7, scale=None), ["invalid scale: red"]), (item(8, scale=2.7500001e-5), []),
        (item(9, offset=0.0, nodata=None), ["invalid offset: red", "invalid nodata: red"]), (item(10, resolution=60.0), ["not 30 m: qa_pixel, red"]),
        (item(11, media_type="image/tiff"), ["not a cloud optimized GeoTIFF: qa_pixel, red"]), (item(12, common_name=None), ["invalid common name: red"]),
    ]
    df = spark.createDataFrame([row for row, _ in cases], SCHEMA)
    got = {r.k: r.p for r in df.select("k", v.problems(v.landsat_rules()).alias("p")).collect()}
    assert got == {row[0]: want for row, want in cases}


@pytest.mark.parametrize("empty", [None, {}])
def test_nothing_declared(spark, empty):
    df = spark.createDataFrame([(empty,)], "m map<string,string>")
    got = df.select(v.problems(v.eos04_rules(F.col("m"))).alias("p")).first().p
    assert got == [*v.EOS04_DECLARED, "NoOfPolarizations", *v.EOS04_NUMBERS]
