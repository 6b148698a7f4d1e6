"""Vegetation index formulas, their encoding, and a registry for new ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume import dims

Formula = Callable[[Column, Column], Column]

NORMALIZED = ("ndvi", "ndmi", "ndbi", "ndre", "ndwi_green_nir")


def normalized_difference(a: Column, b: Column) -> Column:
    """(a-b)/(a+b), NULL where |a+b| <= 1e-6."""
    total = a + b
    return F.when(F.abs(total) > 1e-6, (a - b) / total)


def msavi(a: Column, b: Column) -> Column:
    """Modified soil-adjusted index, NULL where the radicand is negative."""
    base = a * 2.0 + 1.0
    radicand = base * base - (a - b) * 8.0
    return F.when(radicand >= 0, (base - F.sqrt(radicand)) * 0.5)


def reci(a: Column, b: Column) -> Column:
    """Red-edge chlorophyll index a/b - 1, NULL unless b > 1e-4."""
    return F.when(b > 1e-4, a / b - 1.0)


_FORMULAS: dict[str, Formula] = {name: normalized_difference for name in NORMALIZED}
_FORMULAS["msavi"] = msavi
_FORMULAS["reci"] = reci


def register_index(name: str, formula: Formula) -> None:
    """Make a user's formula available under ``name`` (lower case)."""
    _FORMULAS[name.lower()] = formula


def index_value(name: str, a: Column, b: Column) -> Column:
    try:
        formula = _FORMULAS[name.lower()]
    except KeyError:
        raise ValueError(f"unsupported index: {name}") from None
    return formula(a, b)


def index_value_by_name(name: Column, a: Column, b: Column) -> Column:
    """Formula choice per row, for long tables with an index_name column."""
    return (
        F.when(name.isin(*NORMALIZED), normalized_difference(a, b))
        .when(name == "msavi", msavi(a, b))
        .when(name == "reci", reci(a, b))
    )


def encode(value: Column) -> Column:
    """Clip to [-1, 1], times 10000, half-even to int16; NULL -> -32768."""
    clipped = F.least(F.greatest(value, F.lit(-1.0)), F.lit(1.0))
    code = F.rint(clipped * float(dims.INDEX_SCALE)).cast("short")
    return F.coalesce(F.when(value.isNotNull(), code), F.lit(dims.INDEX_NODATA).cast("short"))


def encode_reci(value: Column) -> Column:
    """Float32 without clipping; NULL -> -9999."""
    return F.coalesce(value.cast("float"), F.lit(dims.RECI_NODATA).cast("float"))


def decode(code: Column, scale: float = float(dims.INDEX_SCALE)) -> Column:
    return F.nullif(code, F.lit(dims.INDEX_NODATA).cast("short")).cast("double") / F.lit(scale)
