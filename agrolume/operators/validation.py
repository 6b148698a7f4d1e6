"""Item and metadata validation: rules as rows, all reasons of an item as one typed array."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume.functions import text

c = F.col


@dataclass(frozen=True)
class Rule:
    """A typed reason and when a row breaks it; ``detail`` is an array of what breaks it, where one rule has many."""

    reason: str
    broken: Column | None = None
    detail: Column | None = None


def problems(rules: list[Rule]) -> Column:
    """Reasons of all broken rules, in the order of the rules; a null test counts as kept."""

    def said(r: Rule) -> Column:
        if r.detail is None:
            return F.when(r.broken, F.lit(r.reason))
        return F.when(F.size(r.detail) > 0, F.concat(F.lit(r.reason + ": "), F.array_join(F.array_sort(r.detail), ", ")))

    return F.array_compact(F.array(*[said(r) for r in rules]))


# Product ids of a collection 2, tier 1, level 2 scene, and the prefix of each platform.
LANDSAT_PRODUCT = "^LC0[89]_L2S[PR]_[0-9]{6}_[0-9]{8}_02_T1$"
LANDSAT_PREFIX = {"landsat-8": "LC08", "landsat-9": "LC09"}
# Reflectance assets with their common names, and quality assets.
LANDSAT_REFLECTANCE = {"blue": "blue", "green": "green", "red": "red", "nir08": "nir08", "swir16": "swir16"}
LANDSAT_QUALITY = ("qa_pixel", "qa_radsat")
# Scale, offset and nodata of reflectance, metres of a pixel.
LANDSAT_SCALE, LANDSAT_OFFSET, LANDSAT_NODATA, LANDSAT_METRES = 2.75e-5, -0.2, 0.0, 30.0


def _differs(value: Column, expected: float) -> Column:
    return value.isNull() | (F.abs(value - expected) > 1e-8 + 1e-5 * abs(expected))


def landsat_rules() -> list[Rule]:
    """Rules over product_id, platform, collection_number, category, correction and assets (an array of structs).

    An asset has key, common_name, scale, offset, nodata, resolution and media_type. Facts that an item leaves out
    (collection number, category, correction) are not held against it; values of its assets are.
    """
    prefix = F.lit(None).cast("string")
    for platform, start in LANDSAT_PREFIX.items():
        prefix = F.when(F.lower("platform") == platform, start).otherwise(prefix)
    fits = F.coalesce(c("product_id").rlike(LANDSAT_PRODUCT), F.lit(False))
    level = F.concat(F.lit("L2"), F.substring("product_id", 8, 2))
    number = F.lpad(F.trim("collection_number"), 2, "0")

    def assets(keys: tuple[str, ...], broken) -> Column:
        return F.transform(F.filter("assets", lambda a: a["key"].isin(*keys) & broken(a)), lambda a: a["key"])

    bands, every = tuple(LANDSAT_REFLECTANCE), (*LANDSAT_REFLECTANCE, *LANDSAT_QUALITY)
    common = F.create_map(*[F.lit(x) for pair in LANDSAT_REFLECTANCE.items() for x in pair])
    media = lambda a: F.coalesce(F.lower(a["media_type"]), F.lit(""))
    missing = F.array_except(F.array(*map(F.lit, every)), F.transform("assets", lambda a: a["key"]))
    return [
        Rule("unsupported platform", prefix.isNull()),
        Rule("product id is not collection 2 tier 1 level 2", ~fits),
        Rule("product id conflicts with platform", fits & ~c("product_id").startswith(prefix)),
        Rule("not collection 2", number != "02"),
        Rule("not category T1", F.upper(F.trim("category")) != "T1"),
        Rule("product id conflicts with correction", fits & (F.upper(F.trim("correction")) != level)),
        Rule("missing assets", detail=missing),
        Rule("invalid common name", detail=assets(bands, lambda a: ~a["common_name"].eqNullSafe(F.try_element_at(common, a["key"])))),
        Rule("invalid scale", detail=assets(bands, lambda a: _differs(a["scale"], LANDSAT_SCALE))),
        Rule("invalid offset", detail=assets(bands, lambda a: _differs(a["offset"], LANDSAT_OFFSET))),
        Rule("invalid nodata", detail=assets(bands, lambda a: ~a["nodata"].eqNullSafe(F.lit(LANDSAT_NODATA)))),
        Rule("not 30 m", detail=assets(every, lambda a: _differs(a["resolution"], LANDSAT_METRES))),
        Rule("not a cloud optimized GeoTIFF", detail=assets(every, lambda a: ~(media(a).contains("image/tiff") & media(a).contains("cloud-optimized")))),
    ]


# Metadata that an EOS-04 product of the validated profile declares.
EOS04_DECLARED = {
    "ProductType": "L2B-ARD-PRODUCT", "SatID": "EOS-04", "Sensor": "SAR", "ImagingMode": "MRS", "RTC_Apply_Flag": "1", "Missing_Frames_Flag": "0",
}
EOS04_NUMBERS = {"IncidenceAngle": None, "OutputPixelSpacing": 0.0}


def eos04_rules(metadata: Column) -> list[Rule]:
    """Rules over a string map of KEY=VALUE metadata; a key that is absent counts as empty."""

    def value(key: str) -> Column:
        return F.upper(F.trim(F.coalesce(F.try_element_at(metadata, F.lit(key)), F.lit(""))))

    count = text.positive_integer(value("NoOfPolarizations"))
    listed = F.slice(F.array(*[value(f"TxRxPol{k}") for k in range(1, 5)]), 1, F.least(F.coalesce(count, F.lit(0)), F.lit(4)).cast("int"))
    unknown = F.exists(listed, lambda p: ~p.isin(*text.POLARIZATIONS))
    rules = [Rule(key, value(key) != expected) for key, expected in EOS04_DECLARED.items()]
    rules += [
        Rule("NoOfPolarizations", count.isNull() | (count > 4)),
        Rule("TxRxPol unknown", unknown),
        Rule("TxRxPol repeated", F.size(F.array_distinct(listed)) < F.size(listed)),
    ]
    for key, least in EOS04_NUMBERS.items():
        number = text.number(value(key))
        rules.append(Rule(key, number.isNull() if least is None else number.isNull() | (number < least)))
    return rules
