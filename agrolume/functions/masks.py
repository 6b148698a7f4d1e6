"""Quality masks and the per-source meaning of their classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume import dims

# Classes of the decoded Landsat and ResourceSat masks.
NODATA, CLEAR, CLOUD, SHADOW, WATER, SNOW = 0, 1, 2, 3, 4, 5

# QA_PIXEL bits and the QA_RADSAT bits that invalidate a pixel.
QA_FILL = 1 << 0
QA_CLOUD = (1 << 1) | (1 << 2) | (1 << 3)
QA_SHADOW = 1 << 4
QA_SNOW = 1 << 5
QA_WATER = 1 << 7
RADSAT_INVALID = sum(1 << bit for bit in range(1, 7)) | (1 << 11)


def scl_valid(scl: Column) -> Column:
    return scl.isin(4, 5, 6)


def landsat_class(qa_pixel: Column, qa_radsat: Column, analytic_valid: Column | None = None) -> Column:
    """Decode QA words; the first matching class in priority order wins."""

    def has(word: Column, bits: int) -> Column:
        return word.bitwiseAND(F.lit(bits)) != 0

    invalid = has(qa_pixel, QA_FILL) | has(qa_radsat, RADSAT_INVALID)
    if analytic_valid is not None:
        invalid = invalid | ~analytic_valid
    return (
        F.when(invalid, NODATA)
        .when(has(qa_pixel, QA_CLOUD), CLOUD)
        .when(has(qa_pixel, QA_SHADOW), SHADOW)
        .when(has(qa_pixel, QA_SNOW), SNOW)
        .when(has(qa_pixel, QA_WATER), WATER)
        .otherwise(CLEAR)
    )


def resourcesat_class(green: Column, red: Column, nir: Column, swir: Column, has_swir: Column) -> Column:
    """Threshold mask on integer digital numbers (reflectance x 10000).

    Water beats shadow beats cloud. With a short-wave band, cloud does not
    exclude water; without it, water and cloud exclude each other. Thresholds
    are compared as integers, so exact ties do not depend on float rounding.
    """
    visible_gap = (green == 0) | (red == 0) | (nir == 0)
    gap = visible_gap | (has_swir & (swir == 0))
    water = ((green - nir) * 5 >= green + nir) & (green + nir > 0) & (nir <= 2000)
    bright = green + red + nir >= 9600
    cloud = F.when(has_swir, bright & (swir >= 2000)).otherwise(
        bright & ((nir - red) * 5 <= nir + red)
    )
    dark_swir = (nir <= 800) & (swir <= 800) & (red <= 800)
    dark_visible = (green <= 800) & (red <= 800) & (nir <= 800)
    shadow = F.when(has_swir, dark_swir).otherwise(dark_visible & ~cloud)
    return F.when(gap, NODATA).when(water, WATER).when(shadow, SHADOW).when(cloud, CLOUD).otherwise(CLEAR)


def clear_or_water(mask: Column) -> Column:
    """Analytic-valid classes of the decoded Landsat and ResourceSat masks."""
    return mask.isin(CLEAR, WATER)


def source_mask(p_scl: str = "scl") -> Column:
    """Mask class of a pixel row from whichever columns its source uses."""
    c = F.col
    return (
        F.when(c("source_no") == 0, c(p_scl).cast("int"))
        .when(c("source_no") == 1, landsat_class(c("qa_pixel"), c("qa_radsat")))
        .when(
            c("source_no").isin(2, 3, 4),
            resourcesat_class(
                c("green_dn"), c("red_dn"), c("nir_dn"), c("swir_dn"),
                ~c("source_no").isin(*dims.NO_SWIR_SOURCES),
            ),
        )
    )


def _policy_flag(position: int) -> Column:
    flag = None
    for source_no, _, _, _, family in dims.SOURCES:
        if family not in dims.MASK_POLICY:
            continue
        test = F.col("mask").isin(*dims.MASK_POLICY[family][position])
        condition = F.col("source_no") == source_no
        flag = F.when(condition, test) if flag is None else flag.when(condition, test)
    return flag


def is_usable() -> Column:
    return _policy_flag(0)


def is_cloud() -> Column:
    return _policy_flag(1)


def is_shadow() -> Column:
    return _policy_flag(2)


def is_nodata() -> Column:
    return _policy_flag(3)
