"""Field polygons meet pixels.

A polygon is turned into *spans*: for each pixel row the half-open column
intervals whose centres lie inside. Spans join pixels on (row, column tile), an
equi-join, and the span bounds are checked on the joined rows. A pure range join
would be planned as a nested loop; and testing every pixel against every edge
would repeat work that depends on the row only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.functions import polygons as poly
from agrolume.operators.geometry import once

c = F.col
TILE = 16


def with_rectangle(fields: DataFrame, name: str = "geometry") -> DataFrame:
    return fields.withColumn(name, poly.rectangle(c("x0"), c("y0"), c("x1"), c("y1")))


def spans(
    fields: DataFrame, *, key: str | tuple[str, ...] = "field_id", geometry: str = "geometry", extent: tuple[str, str, str, str] | None = None
) -> DataFrame:
    """(key, rw, c0, c1): columns c0 <= cl < c1 of row rw lie inside the polygon.

    A pixel centre on an edge counts as inside on the left and bottom edges
    only, so neighbouring fields never share a pixel. ``extent`` names the first
    row and column, height and width of a raster that spans are clipped to.
    """
    keys = [key] if isinstance(key, str) else list(key)
    box = poly.bounds(c(geometry))
    first, past = F.ceil(c("box.y0") - 0.5), F.ceil(c("box.y1") - 0.5)
    if extent:
        row0, col0, height, width = (c(n) for n in extent)
        first, past = F.greatest(first, row0), F.least(past, row0 + height)
    rows = (
        fields.select(*keys, *(extent or ()), once(F.struct(poly.edges(c(geometry)).alias("edges"), box.alias("box"))).alias("s"))
        .select(*keys, *(extent or ()), "s.edges", "s.box")
        .select(*keys, *(extent or ()), "edges", first.alias("first"), past.alias("past"))
        .where("past > first")
        .select(*keys, *(extent or ()), "edges", F.explode(F.sequence(c("first"), c("past") - 1)).alias("rw"))
        .select(*keys, *(extent or ()), "rw", poly.crossings(c("edges"), c("rw") + 0.5).alias("xs"))
    )

    def pair(x: Column, i: Column) -> Column:
        # Crossings come in pairs: even positions open a span, odd ones close it.
        close = F.get("xs", i + 1)
        return F.struct(
            F.ceil(x - 0.5).alias("c0"),
            F.when(i % 2 == 0, F.ceil(close - 0.5)).alias("c1"),
        )

    pairs = F.transform("xs", pair)
    out = rows.select(*keys, *(extent or ()), "rw", F.inline(pairs))
    if extent:
        # An odd crossing opens nothing: its NULL must not become the edge of the raster.
        out = out.where("c1 is not null").withColumns({"c0": F.greatest(c("c0"), col0), "c1": F.least(c("c1"), col0 + width)})
    return out.select(*keys, "rw", "c0", "c1").where("c1 > c0")


def join_spans(
    pixels: DataFrame, field_spans: DataFrame, *, tile: int = TILE, salt: int = 1, on: tuple[str, ...] = ()
) -> DataFrame:
    """Pixels inside spans: equi-join on (row, column tile), then the bounds.

    ``on`` names further columns that must be equal, such as the grid. Spark's
    own size check decides whether the spans are broadcast; otherwise it is a
    shuffle join whose hot partitions AQE splits. ``salt`` > 1 spreads one pixel
    row segment over that many extra keys (the spans are repeated), for tables
    where a single place holds a large share of all pixels.
    """
    # Row and ``on`` are keys of their own by the test below: a hash of all would be eight more bytes a row that do not compress.
    keyed = pixels.withColumn("cell_key", F.floor(c("cl") / tile))
    parts = field_spans.withColumn("cell_key", F.explode(F.sequence(F.floor(c("c0") / tile), F.floor((c("c1") - 1) / tile))))
    parts = parts.withColumnsRenamed({"rw": "span_rw", **{n: f"span_{n}" for n in on}})
    keys = ["cell_key"]
    if salt > 1:
        keyed = keyed.withColumn("salt", F.pmod(F.xxhash64("scene_id", "cl"), F.lit(salt)).cast("int"))
        parts = parts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys.append("salt")
    inside = (c("cl") >= c("c0")) & (c("cl") < c("c1")) & (c("rw") == c("span_rw"))
    for name in on:
        inside = inside & (c(name) == c(f"span_{name}"))
    return keyed.join(parts, keys).where(inside).drop("cell_key", "span_rw", "c0", "c1", "salt", *[f"span_{n}" for n in on])


def join_field_pixels(
    pixels: DataFrame, fields: DataFrame, *, geometry: str | None = None, tile: int = TILE, salt: int = 1
) -> DataFrame:
    """Every (field, pixel) pair whose pixel centre lies inside the field."""
    shaped = fields if geometry else with_rectangle(fields)
    return join_spans(
        pixels, spans(shaped, geometry=geometry or "geometry"), tile=tile, salt=salt
    )


def pixel_window(fields: DataFrame, *, width: int, height: int) -> DataFrame:
    """Whole-pixel read window of each field: floor/ceil, one pixel of padding, clamped.

    Fields that miss the raster entirely get NULL bounds.
    """
    row0, col0 = F.floor(c("y0")) - 1, F.floor(c("x0")) - 1
    row1, col1 = F.ceil(c("y1")) + 1, F.ceil(c("x1")) + 1
    clamped = fields.select(
        "*",
        F.greatest(row0, F.lit(0)).alias("row_start"),
        F.least(row1, F.lit(height)).alias("row_stop"),
        F.greatest(col0, F.lit(0)).alias("col_start"),
        F.least(col1, F.lit(width)).alias("col_stop"),
    )
    overlaps = (c("row_stop") > c("row_start")) & (c("col_stop") > c("col_start"))
    names = ("row_start", "row_stop", "col_start", "col_stop")
    return clamped.select(*fields.columns, *[F.when(overlaps, c(n)).alias(n) for n in names])


def sample_points(codes: DataFrame, points: DataFrame) -> DataFrame:
    """Raster value under each point, masked when outside field, raster or data.

    ``points`` carries scene_id, x, y and its field's ``geometry``. The join is
    an equi-join on (scene_id, rw, cl).
    """
    inside = poly.contains(poly.edges(c("geometry")), c("x"), c("y"))
    located = points.select(
        *[n for n in points.columns if n != "geometry"],
        inside.alias("inside"),
        F.floor("y").alias("rw"), F.floor("x").alias("cl"),
    )
    cells = codes.select("scene_id", "rw", "cl", "code")
    value = F.when(c("inside") & (c("code") != -32768), c("code") / 10000.0)
    return located.join(cells, ["scene_id", "rw", "cl"], "left").select(
        *[n for n in points.columns if n != "geometry"],
        value.alias("value"),
        value.isNull().alias("masked"),
    )
