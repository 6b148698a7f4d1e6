"""Radar backscatter in decibels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gamma0_db(dn: Column, noise: Column | float, calibration_db: Column | float) -> Column:
    """10 log10(dn^2 - noise) - calibration; NULL where the power is not positive."""
    power = dn * dn - F.lit(noise)
    return F.when(power > 0, F.lit(10.0) * F.log10(power) - F.lit(calibration_db))


def power_db(power: Column) -> Column:
    return F.when(power > 0, F.lit(10.0) * F.log10(power))


def quantised_db(db: Column, decimals: int = 6) -> Column:
    """Decibels to 1e-6, about the precision of a float32 raster, as a fixed lattice."""
    return F.round(db, decimals)


def confidence(days_from_target: Column, coverage_percent: Column) -> Column:
    offset = F.abs(days_from_target)
    covered = coverage_percent >= 95.0
    return (
        F.when((offset <= 3) & covered, "high")
        .when((offset <= 7) & covered, "medium")
        .when((offset <= 12) & covered, "low")
        .otherwise("none")
    )
