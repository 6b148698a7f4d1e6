"""Colour tables of the map layers (values, not images)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume import dims


def ndvi_colour(value: Column) -> Column:
    """Eight NDVI colours; values beyond either end take the end colour."""
    bins = dims.NDVI_COLOURS
    colour = F.when(value < bins[0][1], bins[0][2])
    for _, upper, hexcode in bins[1:-1]:
        colour = colour.when(value < upper, hexcode)
    return colour.when(value.isNotNull(), bins[-1][2])


def contrast_profile(index_name: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """(applied profile, fallback reason) for a requested contrast rendering."""
    reason = (
        F.when(~F.lower(index_name).isin(*dims.CONTRAST_INDICES), "unsupported_index")
        .when(low.isNull() | high.isNull(), "missing_statistics")
        .when(low == high, "constant_scene")
    )
    return F.when(reason.isNull(), "contrast").otherwise("standard"), reason


def contrast_break(low: Column, high: Column, n: int) -> Column:
    return low + F.lit(float(n)) * (high - low) / 5.0


def contrast_colour(value: Column, low: Column, high: Column) -> Column:
    """One of six colours by the five equal breaks between scene min and max."""
    colours = dims.CONTRAST_COLOURS
    colour = F.when(value < contrast_break(low, high, 1), colours[0])
    for n in range(2, 6):
        colour = colour.when(value < contrast_break(low, high, n), colours[n - 1])
    return colour.when(value.isNotNull(), colours[5])


def gray_level(value: Column, low: float = -25.0, high: float = 5.0) -> Column:
    """Linear 0..255 ramp, clamped, half-even rounded."""
    share = F.least(F.greatest((value - F.lit(low)) / F.lit(high - low), F.lit(0.0)), F.lit(1.0))
    return F.rint(share * 255.0).cast("int")
