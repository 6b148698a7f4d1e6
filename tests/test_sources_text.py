"""Text metadata files, GeoJSON parts, nested redaction and ranks in bins."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from agrolume.functions import text
from agrolume.functions.redaction import redact_json
from agrolume.operators import catalog, selection
from agrolume.sources import textmeta

c = F.col


def test_key_value_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("﻿SatID = EOS-04 // platform\n\n# note = x\nno pair\nSensor=SAR=X\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("K=1\nL=2\nK=1\n")
    values = textmeta.read_key_values(spark, str(tmp_path))
    rows = {r.file.rsplit("/", 1)[1]: r for r in textmeta.band_metadata(values, file="file").collect()}
    assert rows["a.txt"].metadata == {"SatID": "EOS-04", "Sensor": "SAR=X"} and rows["a.txt"].failure is None
    assert (rows["b.txt"].metadata, rows["b.txt"].failure, rows["b.txt"].reason) == (None, "INVALID_PRODUCT", "duplicate key: K")


def test_polygon_parts(spark):
    square, hole = [[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1, 9], [2, 1, 9], [1, 1, 9]]
    rows = [("Polygon", json.dumps([square, hole])), ("MultiPolygon", json.dumps([[square], [square, hole]])), ("Point", "[1, 2]"), ("Polygon", None)]
    got = [r.g for r in spark.createDataFrame(rows, "kind string, at string").select(textmeta.polygons_of(c("kind"), c("at")).alias("g")).collect()]
    shape = [g and [[len(ring) for ring in part] for part in g] for g in got]
    assert shape == [[[4, 3]], [[4], [4, 3]], None, None]


def test_nested_redaction(spark):
    flat = {"name": "a", "Api_Key": "s", "note": "Basic dXNlcg== end", "go": "https://h/p?sig=1&x=2#sig=3", "my-download-href": "x"}
    deep = {"a": [{"password": {"x": 1}}, [["Bearer abc.def"]], 7, None], "Set-Cookie": "s", "b": {"c": {"AWSAccessKeyId": "https://h?AWSAccessKeyId=k"}}}
    rows = [json.dumps(flat), json.dumps(deep), "Cookie: a=b; c=d", None, "[]", "x" * 100_000, "[" * 30 + "1" + "]" * 30]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, doc string")
    got = {r.k: r.doc for r in df.select("k", redact_json(c("doc")).alias("doc")).collect()}
    native = df.where("k = 0").select(text.redact_map(F.from_json("doc", "map<string,string>")).alias("m")).first().m
    assert json.loads(got[0]) == native == {
        "name": "a", "Api_Key": "[REDACTED]", "note": "Basic [REDACTED] end", "go": "https://h/p?sig=[REDACTED]&x=2#sig=3", "my-download-href": "[REDACTED]",
    }
    assert json.loads(got[1]) == {
        "a": [{"password": "[REDACTED]"}, [["Bearer [REDACTED]"]], 7, None], "Set-Cookie": "[REDACTED]", "b": {"c": {"AWSAccessKeyId": "https://h?AWSAccessKeyId=[REDACTED]"}},
    }
    assert got[2] == "Cookie: [REDACTED]" and got[3] is None and got[4] == "[]" and got[5] == rows[5] and "REDACTED" in got[6] and "1" not in got[6]


def test_ranks_in_bins_are_plain_ranks(spark):
    rows = spark.range(3000).select(
        (c("id") % 2).alias("g"), c("id"), ((c("id") * 37 % 11) * 0.9).alias("overlap_area"),
        F.when(c("id") % 7 > 0, F.concat(F.lit("2020-01-0"), c("id") % 5 + 1, F.when(c("id") % 3 == 0, "T05").otherwise(""))).alias("acq_date"), c("id").alias("product_id"),
    ).withColumn("g", F.when(c("g") == 1, 1))
    binned = selection.top_by_overlap(rows, ["g"], 3, by_product=True)
    order = [c("overlap_area").desc(), c("acq_date").desc_nulls_last(), c("product_id").desc()]
    plain = selection.ranked_per(rows, ["g"], order, 3)
    as_set = lambda df: {(r.g, r.id, r["rank"], r.within_limit) for r in df.collect()}
    assert as_set(binned) == as_set(plain)


def test_dates_with_all_required_indices(spark):
    rows = [(1, 1, "d", "ndvi"), (1, 1, "d", "msavi"), (1, 1, "d", "msavi"), (1, 1, "e", "ndvi"), (2, 1, "e", "ndvi"), (9, 1, "e", "ndvi"), (2, 1, "f", "msavi")]
    df = spark.createDataFrame(rows, "source_no int, aoi_no int, acq_date string, index_name string")
    got = catalog.complete_dates(df, {1: ("ndvi", "msavi"), 2: ("ndvi",)}).collect()
    assert sorted(map(tuple, got)) == [(1, 1, "d"), (2, 1, "e")]
