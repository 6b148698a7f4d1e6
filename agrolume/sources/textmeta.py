"""Text metadata and GeoJSON sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolume.functions.text import band_token

c = F.col


def parse_key_values(lines: DataFrame, *, file: str, line: str) -> DataFrame:
    """``KEY=VALUE`` lines with ``//`` comments: (file, key, value, duplicate).

    ``lines`` is one row per line, for example from ``spark.read.text`` with
    ``input_file_name()``. A key that occurs twice in a file is flagged.
    """
    stripped = F.trim(c(line))
    parsed = lines.select(file, stripped.alias("l")).where(
        (c("l") != "") & ~c("l").startswith("#") & c("l").contains("=")
    ).select(
        file,
        F.trim(F.substring_index("l", "=", 1)).alias("key"),
        F.trim(F.substring_index(F.regexp_replace("l", "^[^=]*=", ""), "//", 1)).alias("value"),
    )
    return parsed.groupBy(file, "key").agg(
        F.min("value").alias("value"), (F.count("*") > 1).alias("duplicate")
    )


FEATURES = (
    "struct<bbox:array<double>,features:array<struct<id:string,bbox:array<double>,"
    "properties:struct<role:string>,geometry:struct<type:string,coordinates:string>>>>"
)
# Feature roles that are areas of interest.
ROLES = ("aoi_polygon", "sample_field")


def load_features(documents: DataFrame, *, key: str, column: str) -> DataFrame:
    """Areas of a GeoJSON FeatureCollection, collection bbox as fallback."""
    parsed = documents.select(key, F.from_json(c(column), FEATURES).alias("fc"))
    rows = parsed.select(key, c("fc.bbox").alias("all_bbox"), F.explode("fc.features").alias("f"))
    return rows.where(c("f.properties.role").isin(*ROLES)).select(
        key, c("f.id").alias("aoi_id"),
        F.initcap(F.translate("f.id", "_", " ")).alias("name"),
        c("f.geometry.type").alias("geometry_type"),
        F.coalesce("f.bbox", "all_bbox").alias("bbox"),
        polygons_of(c("f.geometry.type"), c("f.geometry.coordinates")).alias("geometry"),
    )


def polygons_of(kind: Column, coordinates: Column) -> Column:
    """GeoJSON coordinates (JSON text) of a Polygon or MultiPolygon -> the package's polygon column.

    Positions may carry a height, which is left out. Null for other kinds and for coordinates that do not parse.
    """
    ring = lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    part = lambda p: F.transform(p, ring)
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return F.when(kind == "Polygon", F.when(one.isNotNull(), F.array(part(one)))).when(kind == "MultiPolygon", F.transform(many, part))


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """``KEY=VALUE`` text files: (file, key, value, duplicate), as parse_key_values gives them.

    A folder or a pattern is read as one table of lines with the path of each; a byte order mark is left out.
    """
    lines = spark.read.text(path).select(c("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\\uFEFF", "").alias("line"))
    return parse_key_values(lines, file="file", line="line")


def band_metadata(values: DataFrame, *, file: str) -> DataFrame:
    """One row per file: ``metadata`` map, or null with the typed ``failure`` of a file that repeats a key.

    ``values`` is what parse_key_values gives. The repeated keys are named in order.
    """
    repeated = F.array_sort(F.collect_set(F.when(c("duplicate"), c("key"))))
    entries = F.collect_list(F.struct("key", "value"))
    files = values.groupBy(file).agg(repeated.alias("repeated"), entries.alias("entries"))
    broken = F.size("repeated") > 0
    return files.select(
        file,
        F.when(~broken, F.map_from_entries("entries")).alias("metadata"),
        F.when(broken, "INVALID_PRODUCT").alias("failure"),
        F.when(broken, F.concat(F.lit("duplicate key: "), F.array_join("repeated", ", "))).alias("reason"),
    )


# Date keys of band metadata, best first.
BAND_DATE_KEYS = ("acquisition_datetime", "acquisition_at", "datetime", "date", "acquisitionDate")


def metadata_datetime(metadata: Column) -> Column:
    """First usable date of a string map by the fallback keys."""
    return F.coalesce(*[F.nullif(F.try_element_at(metadata, F.lit(k)), F.lit("")) for k in BAND_DATE_KEYS])


def match_band_files(files: DataFrame, bands: dict[str, tuple[str, ...]], *, product: str) -> DataFrame:
    """First file (by path) of each product whose name contains the band token.

    ``bands`` lists the required bands of each profile: a handful of constants,
    held in the expression, so no join is needed.
    """
    pairs: list[Column] = []
    for profile, names in bands.items():
        pairs += [F.lit(profile), F.array(*[F.lit(n) for n in names])]
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    is_raster = F.lower(F.substring_index("path", ".", -1)).isin("tif", "tiff")
    tokens = files.where(is_raster).select(
        product, "path", band_token(stem).alias("token"), F.try_element_at(F.create_map(*pairs), c("profile")).alias("names")
    )
    found = F.filter("names", lambda n: F.contains(c("token"), band_token(n)))
    return tokens.select(product, "path", F.explode(found).alias("band")).groupBy(product, "band").agg(
        F.min("path").alias("path")
    )
