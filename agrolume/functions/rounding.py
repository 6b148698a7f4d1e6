"""Rounding used for every published float."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(value: Column) -> Column:
    return F.round(value, 6)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where the whole is empty."""
    return F.when(whole > 0, part.cast("double") * 100.0 / whole).otherwise(F.lit(0.0))
