"""Fixed dimension values: sources, index roles, mask classes, profiles.

Everything in this module is a small constant table. The DataFrame builders turn
them into broadcast-sized dimensions whose row counts do not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source number, id, native metres, search window days, family.
SOURCES = (
    (0, "sentinel-2-l2a", 10.0, 7, "s2"),
    (1, "landsat-c2-l2", 30.0, 180, "landsat"),
    (2, "resourcesat-2a-liss3-boa", 23.5, 30, "resourcesat"),
    (3, "resourcesat-2a-liss4-mx70-l2", 5.8, 365, "resourcesat"),
    (4, "resourcesat-2a-awifs-boa", 56.0, 365, "resourcesat"),
    (5, "eos-04-sar-mrs-l2b", 18.0, 21, "sar"),
    (6, "nisar-ssar-beta-gcov", 20.0, 21, "sar"),
)

# Scale and offset that turn a digital number into reflectance.
REFLECTANCE = {
    "s2": (1e-4, -0.1),
    "landsat": (2.75e-5, -0.2),
    "resourcesat": (1e-4, 0.0),
}

# Index -> (first role, second role) per source family.
INDEX_ROLES = {
    "s2": {
        "ndvi": ("nir", "red"),
        "msavi": ("nir", "red"),
        "ndmi": ("nir08", "swir16"),
        "ndbi": ("swir16", "nir08"),
        "ndre": ("nir08", "rededge1"),
        "reci": ("nir08", "rededge1"),
    },
    "landsat": {
        "ndvi": ("nir08", "red"),
        "msavi": ("nir08", "red"),
        "ndmi": ("nir08", "swir16"),
        "ndwi_green_nir": ("green", "nir08"),
    },
    "resourcesat": {
        "ndvi": ("NIR", "RED"),
        "msavi": ("NIR", "RED"),
        "ndmi": ("NIR", "SWIR1"),
        "ndwi_green_nir": ("GREEN", "NIR"),
    },
}

# Which physical pixel column plays each band role.
ROLE_COLUMNS = {
    "blue": "blue", "green": "green", "red": "red", "nir": "nir", "nir08": "nir",
    "rededge1": "rededge", "swir16": "swir",
    "GREEN": "green", "RED": "red", "NIR": "nir", "SWIR1": "swir",
}

# Sources without a short-wave infrared band.
NO_SWIR_SOURCES = (3,)

#: Every index with the pixel columns it reads (the same in all families) and the sources that have it.
INDEX_PAIRS = {
    name: (ROLE_COLUMNS[first], ROLE_COLUMNS[second]) for roles in INDEX_ROLES.values() for name, (first, second) in roles.items()
}
INDEX_SOURCES = {
    name: tuple(
        no for no, _, _, _, family in SOURCES
        if name in INDEX_ROLES.get(family, {}) and not (no in NO_SWIR_SOURCES and "swir" in pair)
    )
    for name, pair in INDEX_PAIRS.items()
}

# Indices that a date must have to count as ready, per source family.
REQUIRED_INDICES = {"s2": ("ndvi",), "landsat": ("ndvi", "msavi", "ndmi", "ndwi_green_nir"), "resourcesat": ("ndvi",)}

# Usable / cloud / shadow / nodata mask classes per family.
MASK_POLICY = {
    "s2": ((4, 5, 6), (8, 9, 10), (3,), (0,)),
    "landsat": ((1, 4), (2, 5), (3,), (0,)),
    "resourcesat": ((1, 4), (2,), (3,), (0,)),
}

# Encoded index rasters.
INDEX_SCALE = 10000
INDEX_NODATA = -32768
RECI_NODATA = -9999.0
#: RECI is a float32 raster without a scale; its statistics are taken on this lattice.
RECI_SCALE = 100000
SAR_NODATA = -9999.0

# Default threshold classes (label, lower, upper), half open.
_VEGETATION = (
    ("Bare or stressed", -1.0, 0.2),
    ("Moderate vegetation", 0.2, 0.5),
    ("Healthy crop", 0.5, 0.75),
    ("Dense vegetation", 0.75, 1.0),
)
_MSAVI = (
    ("Low vegetation cover", -1.0, 0.2),
    ("Moderate vegetation cover", 0.2, 0.5),
    ("High vegetation cover", 0.5, 1.0),
)
_NDMI = (
    ("Dry vegetation", -1.0, -0.1),
    ("Moderate moisture", -0.1, 0.3),
    ("High moisture", 0.3, 1.0),
)
_NDWI = (
    ("Low water signal", -1.0, -0.1),
    ("Mixed moisture signal", -0.1, 0.2),
    ("Water or high moisture", 0.2, 1.0),
)
THRESHOLD_CLASSES = {
    "ndvi": _VEGETATION,
    "msavi": _MSAVI,
    "ndmi": _NDMI,
    "ndwi_green_nir": _NDWI,
}

# Display ranges and legend stops per index.
VISUALIZATION = {
    "ndvi": ("ndvi-default-v1", -0.2, 0.9,
             ((-0.2, "#8c510a"), (0.2, "#f6e8c3"), (0.5, "#80cdc1"), (0.9, "#01665e"))),
    "msavi": ("msavi-default-v1", -0.1, 0.8,
              ((-0.1, "#8c510a"), (0.2, "#f6e8c3"), (0.5, "#7fbf7b"), (0.8, "#1b7837"))),
    "ndmi": ("ndmi-default-v1", -0.6, 0.8,
             ((-0.6, "#8c510a"), (-0.1, "#dfc27d"), (0.3, "#80cdc1"), (0.8, "#01665e"))),
    "ndwi_green_nir": ("ndwi-green-nir-default-v1", -0.6, 0.6,
                       ((-0.6, "#a6611a"), (-0.1, "#dfc27d"), (0.2, "#80cdc1"), (0.6, "#018571"))),
}

# NDVI colour bins (lower, upper, hex); ends are clamped.
NDVI_COLOURS = (
    (-1.0, 0.0, "#13187d"),
    (0.0, 0.15, "#80461a"),
    (0.15, 0.30, "#d50023"),
    (0.30, 0.45, "#ff530d"),
    (0.45, 0.60, "#fac909"),
    (0.60, 0.75, "#6fca07"),
    (0.75, 0.90, "#16992b"),
    (0.90, 1.0, "#005825"),
)

# Six colours of the scene-relative contrast profile.
CONTRAST_COLOURS = ("#6e3b1f", "#b86b2c", "#e7c64b", "#9bcf53", "#3f9f4a", "#0b5d37")
CONTRAST_INDICES = ("ndvi", "ndmi", "ndwi_green_nir", "msavi", "ndbi", "ndre", "reci")

# Limits of field questions.
MAX_CANDIDATE_SCENES = 20
FIELD_MIN_COVERAGE = 95.0
FIELD_MIN_USABLE_PIXELS = 1
FIELD_MAX_VERTICES = 5000
FIELD_MAX_AREA_KM2 = 25.0
SAR_MAX_CANDIDATES = 12


def index_scale(index_name: str) -> int:
    return RECI_SCALE if index_name == "reci" else INDEX_SCALE


# Provider route, atmospheric correction, family part of the formula version and warning of each optical source.
PROVENANCE = {
    0: ("earthsearch:sentinel-2-l2a", "vendor-l2a", "s2-v1", None),
    1: (
        "planetary-computer:landsat-c2-l2", "usgs-landsat-collection-2-level-2-surface-reflectance", "landsat-c2-v1",
        "Landsat surface-reflectance analytics use 30 m pixels.",
    ),
    2: ("bhoonidhi:ResourceSat-2A_LISS3_BOA", "bhoonidhi-boa", "resourcesat-v1", None),
    3: ("bhoonidhi:ResourceSat-2A_LISS4-MX70_L2", "bhoonidhi-l2", "resourcesat-v1", None),
    4: (
        "bhoonidhi:ResourceSat-2A_AWIFS_BOA", "bhoonidhi-boa", "resourcesat-v1",
        "AWiFS native resolution is coarse for field-scale analytics.",
    ),
}


def formula_version(source_no: int, index_name: str) -> str:
    """The published version name of an index formula (fixed values)."""
    family = PROVENANCE[source_no][2]
    if family == "landsat-c2-v1":
        return f"{index_name}-{family}"
    if family == "resourcesat-v1" and index_name == "ndwi_green_nir":
        return "ndwi-green-nir-default-v1"
    return f"{index_name.replace('_', '-')}-{family}"


def optical_indices() -> list[tuple[int, str]]:
    return [(no, name) for name, sources in INDEX_SOURCES.items() for no in sources]


def _constant(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A dimension of fixed rows, always broadcast: its size is not known to the planner, and a shuffle on a handful of sources would put a table into a handful of tasks."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def source_dim(spark: SparkSession) -> DataFrame:
    schema = "source_no long, source_id string, native_m double, window_days int, family string"
    return _constant(spark, [tuple(row) for row in SOURCES], schema)


def index_role_dim(spark: SparkSession) -> DataFrame:
    """One row per supported (source, index) with the two pixel columns it reads."""
    rows = []
    for source_no, _, _, _, family in SOURCES:
        for index_name, (first, second) in INDEX_ROLES.get(family, {}).items():
            if source_no in NO_SWIR_SOURCES and "SWIR1" in (first, second):
                continue
            rows.append((source_no, index_name, ROLE_COLUMNS[first], ROLE_COLUMNS[second]))
    return _constant(
        spark, rows, "source_no long, index_name string, first_band string, second_band string"
    )


def mask_policy_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType(
        [T.StructField("source_no", T.LongType())]
        + [
            T.StructField(name, T.ArrayType(T.IntegerType()))
            for name in ("usable_classes", "cloud_classes", "shadow_classes", "nodata_classes")
        ]
    )
    rows = [
        (source_no, *[list(classes) for classes in MASK_POLICY[family]])
        for source_no, _, _, _, family in SOURCES
        if family in MASK_POLICY
    ]
    return _constant(spark, rows, schema)


def profiled_indices(source_no: int, family: str) -> list[str]:
    """Indices of a source that have default threshold classes."""
    if family == "s2":
        return ["ndvi"]
    if family == "resourcesat":
        return [n for n in INDEX_ROLES[family] if source_no in INDEX_SOURCES[n]]
    return []


def threshold_profiles_dim(spark: SparkSession) -> DataFrame:
    """Default threshold profiles: every index of each optical source, per class."""
    rows = []
    for source_no, _, _, _, family in SOURCES:
        version = "resourcesat-thresholds-v1" if family == "resourcesat" else "ndvi-generic-v1"
        for name in profiled_indices(source_no, family):
            for position, (label, lower, upper) in enumerate(THRESHOLD_CLASSES[name]):
                rows.append((source_no, name, version, position, label, lower, upper))
    return _constant(
        spark,
        rows,
        "source_no long, index_name string, profile_version string, class_no int, "
        "label string, lower double, upper double",
    )
