"""Pixel tables -> reflectance, index and backscatter tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume import dims
from agrolume.functions import bands, indices, masks, sar

c = F.col


def optical(pixels: DataFrame) -> DataFrame:
    """Reflectance per band plus the mask class, optical sources only."""
    valid = masks.scl_valid(c("scl"))
    return pixels.where("source_no <= 4").select(
        "scene_id", "grid_no", "source_no", "ym", "rw", "cl",
        *[bands.reflectance(c(f"{b}_dn"), c("source_no"), valid).alias(b) for b in bands.BANDS],
        masks.source_mask().alias("mask"),
    )


def index_raster(pixels: DataFrame, index_name: str) -> DataFrame:
    """Encoded int16 raster of one index whose bands every source names alike.

    For ``ndvi``, ``msavi`` the pair is (nir, red) in all optical sources; use
    ``all_indices`` where the pair depends on the source.
    """
    usable = masks.is_usable()
    value = indices.index_value(index_name, c("nir"), c("red"))
    return optical(pixels).select(
        "scene_id", "grid_no", "source_no", "ym", "rw", "cl", "mask",
        indices.encode(F.when(usable, value)).alias("code"),
    )


def all_indices(pixels: DataFrame) -> DataFrame:
    """Every supported index of every source, one row per pixel and index."""
    roles = dims.index_role_dim(pixels.sparkSession)
    usable = masks.is_usable()
    picked = (
        optical(pixels)
        .withColumn("bands", bands.band_map())
        .join(roles, "source_no")
        .select(
            "scene_id", "grid_no", "source_no", "ym", "rw", "cl", "mask", "index_name",
            F.when(usable, F.element_at("bands", c("first_band"))).alias("a"),
            F.when(usable, F.element_at("bands", c("second_band"))).alias("b"),
        )
    )
    value = indices.index_value_by_name(c("index_name"), c("a"), c("b"))
    return picked.select(
        "scene_id", "grid_no", "source_no", "ym", "rw", "cl", "mask", "index_name", value.alias("value")
    )


def code_column(index_name: str, value: Column) -> Column:
    """A value as an integer of its index's scale, NULL for nodata; RECI is not clipped."""
    if index_name == "reci":
        return F.rint(value.cast("float").cast("double") * float(dims.RECI_SCALE)).cast("long")
    clipped = F.least(F.greatest(value, F.lit(-1.0)), F.lit(1.0))
    return F.when(value.isNotNull(), F.rint(clipped * float(dims.INDEX_SCALE)).cast("long"))


def coded(pixels: DataFrame) -> DataFrame:
    """Optical pixels with a code column per index (``code_<name>``), NULL where a source lacks it or has no data."""
    usable = masks.is_usable()
    codes = []
    for name, (first, second) in dims.INDEX_PAIRS.items():
        value = indices.index_value(name, c(first), c(second))
        codes.append(code_column(name, F.when(usable & c("source_no").isin(*dims.INDEX_SOURCES[name]), value)).alias(f"code_{name}"))
    return optical(pixels).select("scene_id", "grid_no", "source_no", "ym", "rw", "cl", "mask", *codes)


def with_flags(codes: DataFrame) -> DataFrame:
    """``coded`` rows whose codes say only whether there is one, for counts: a flag is smaller than a code in every later shuffle."""
    flags = {n: F.when(c(n).isNotNull(), F.lit(True)) for n in codes.columns if n.startswith("code_")}
    return codes.withColumns(flags)


def by_index(codes: DataFrame) -> DataFrame:
    """A row per pixel and index its source has: ``code_<name>`` columns become index_name and code."""

    def of_source(entry: Callable[[str], Column]) -> Column:
        # Plain arrays, one per source: neither structs nor lambdas in the row of a pixel.
        out = F.lit(None)
        for no in sorted({no for sources in dims.INDEX_SOURCES.values() for no in sources}):
            out = F.when(c("source_no") == no, F.array(*[entry(name) for name, sources in dims.INDEX_SOURCES.items() if no in sources])).otherwise(out)
        return out

    keep = [n for n in codes.columns if not n.startswith("code_")]
    rows = codes.select(*keep, F.posexplode(of_source(lambda name: c(f"code_{name}"))).alias("place", "code"))
    return rows.select(*keep, F.get(of_source(F.lit), c("place")).alias("index_name"), "code")


def of_index(index_name: Column) -> Column:
    """The code of the index that a row asks for."""
    out = F.lit(None).cast("long")
    for name in dims.INDEX_PAIRS:
        out = F.when(index_name == name, c(f"code_{name}")).otherwise(out)
    return out


def scale_of(index_name: Column) -> Column:
    return F.when(index_name == "reci", float(dims.RECI_SCALE)).otherwise(float(dims.INDEX_SCALE))


def backscatter(pixels_sar: DataFrame, *, power_source: int = 6, power_scale: float = 1e-3) -> DataFrame:
    """Decibels per polarization, NULL where the mask is not valid.

    EOS-04 amplitudes are calibrated with their scene's ``noise`` and ``calibration_db``, mask 128 is valid;
    NISAR (``power_source``) has linear power, and the numbers 1 to ``subswaths`` are valid.
    """
    is_power = c("source_no") == power_source
    valid = F.when(is_power, c("valid_mask").between(F.lit(1), c("subswaths"))).otherwise(c("valid_mask") == 128)
    return pixels_sar.select(
        "scene_id", "grid_no", "source_no", "ym", "rw", "cl",
        *[
            F.when(
                valid,
                sar.quantised_db(
                    F.when(is_power, sar.power_db(c(f"{b}_dn") * power_scale)).otherwise(sar.gamma0_db(c(f"{b}_dn"), c("noise"), c("calibration_db")))
                ),
            ).alias(b)
            for b in ("hh", "hv")
        ],
    )


def summary(codes: DataFrame, keys: list[str]) -> DataFrame:
    """Type, valid count, minimum and maximum of each raster of ``by_index`` rows, nodata ignored."""
    scale = scale_of(c("index_name"))
    return codes.groupBy(*keys, "index_name").agg(F.count("code").alias("valid_count"), F.min("code").alias("lo"), F.max("code").alias("hi")).select(
        *keys, "index_name", F.when(c("index_name") == "reci", "float32").otherwise("int16").alias("dtype"), "valid_count",
        (c("lo") / scale).alias("min_value"), (c("hi") / scale).alias("max_value"),
    )


def overview_pyramid(codes: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Coarser levels of ``coded`` rasters: mean of each index, first cell (row, column) of the mask.

    Each level is taken from the finest level's sums, so every level is exact
    and all levels and indices share one scan and one shuffle; a coarse cell
    becomes a row per index only after it has been summed.
    """
    level = F.explode(F.array(*[F.lit(n) for n in levels])).alias("level")
    names = list(dims.INDEX_PAIRS)
    cells = codes.select("scene_id", "source_no", "rw", "cl", "mask", *[f"code_{n}" for n in names], level)
    size = F.pow(F.lit(2.0), c("level"))
    summed = cells.groupBy(
        "level", "scene_id", "source_no", F.floor(c("rw") / size).alias("out_r"), F.floor(c("cl") / size).alias("out_c")
    ).agg(
        # A plain number as the order keeps this a hash aggregate.
        F.min_by("mask", F.shiftleft(c("rw"), 31) + c("cl")).alias("mask"),
        *[F.sum(f"code_{n}").alias(f"sum_{n}") for n in names], *[F.count(f"code_{n}").alias(f"n_{n}") for n in names],
    )
    entries = [
        F.when(c("source_no").isin(*sources), F.struct(
            F.lit(n).alias("index_name"), F.when(c(f"n_{n}") > 0, c(f"sum_{n}") / (c(f"n_{n}") * float(dims.index_scale(n)))).alias("mean_value")
        ))
        for n, sources in dims.INDEX_SOURCES.items()
    ]
    return summed.select("level", "scene_id", c("out_r").alias("rw"), c("out_c").alias("cl"), "mask", F.explode(F.array_compact(F.array(*entries))).alias("e")).select(
        "level", "scene_id", "rw", "cl", "mask", "e.index_name", "e.mean_value"
    )
