"""Digital number -> reflectance, and the band roles of each source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume import dims

BANDS = ("blue", "green", "red", "nir", "swir", "rededge")


def reflectance_s2(dn: Column, valid: Column, scale: float = 1e-4, offset: float = -0.1) -> Column:
    """DN * scale + offset where the pixel is valid, NULL elsewhere."""
    return F.when(valid & dn.isNotNull(), dn * F.lit(scale) + F.lit(offset))


def reflectance_landsat(dn: Column, valid: Column | None = None) -> Column:
    """Collection-2 scaling; DN 0 is nodata, negative reflectance is kept."""
    scale, offset = dims.REFLECTANCE["landsat"]
    usable = dn != 0 if valid is None else (dn != 0) & valid
    return F.when(usable, dn * F.lit(scale) + F.lit(offset))


def reflectance_resourcesat(dn: Column, valid: Column | None = None) -> Column:
    scale, _ = dims.REFLECTANCE["resourcesat"]
    usable = dn.isNotNull() if valid is None else dn.isNotNull() & valid
    return F.when(usable, dn * F.lit(scale))


def reflectance(dn: Column, source_no: Column, s2_valid: Column) -> Column:
    """Source-aware reflectance for the optical sources 0..4."""
    return (
        F.when(source_no == 0, reflectance_s2(dn, s2_valid))
        .when(source_no == 1, reflectance_landsat(dn))
        .when(source_no.isin(2, 3, 4), reflectance_resourcesat(dn))
    )


def band_map(columns: tuple[str, ...] = BANDS) -> Column:
    """Role column name -> reflectance, for data-driven band choice."""
    pairs: list[Column] = []
    for name in columns:
        pairs += [F.lit(name), F.col(name)]
    return F.create_map(*pairs)
