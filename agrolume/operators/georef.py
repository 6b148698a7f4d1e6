"""Rasters that have grids of their own, and fields in the pixel coordinates of each.

A *grid* is a projection and an affine transform with the rows and columns its
rasters have: grid_no, epsg, a..f (x = a col + b row + c, y = d col + e row + f),
row0, col0, height, width. Fields are longitude/latitude polygons. A field meets
the grids whose footprints it touches, is projected into each one's projection
and brought to its rows and columns, and only then cut into spans. From there on
the join with pixels is an equality of grid, row and column tile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolume.functions import geo
from agrolume.functions import polygons as poly
from agrolume.operators import geometry, spatial
from agrolume.operators.geometry import once

c = F.col
EXTENT = ("row0", "col0", "height", "width")
AFFINE = ("a", "b", "c", "d", "e", "f")
#: Points along each side of a raster that its footprint is measured by: parallels are bowed in metres.
SIDE_POINTS = 8
#: Pixels that footprints are widened by: the padding of a read window and what the bow leaves.
MARGIN = 3
#: Degrees of the cells in which fields and footprints meet.
CELL = 0.0125


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once, however often it is used (SQL text)."""
    return f"transform(array({value}), {name} -> {body})[0]"


_K = f"{geo._SCALE * geo._RECTIFYING!r}D"
_RADIUS = f"{geo.A_METRES!r}D"
_MERIDIAN = "radians(cast({0} % 100 as double)*6D - 183D)"


def _series(coefficients: tuple[float, ...], first: str, second: str, xi: str, eta: str) -> str:
    return " + ".join(f"{v!r}D*{first}({2 * j}D*{xi})*{second}({2 * j}D*{eta})" for j, v in enumerate(coefficients, start=1))


def project(lon: str, lat: str, epsg: str) -> str:
    """SQL text of struct(x, y): degrees (4326), web Mercator (3857) or a UTM zone (326zz, 327zz) of a point."""
    e = f"{geo.E!r}D"
    t = f"sinh(atanh(sin(radians({lat}))) - {e}*atanh({e}*sin(radians({lat}))))"
    east = f"({_series(geo._ALPHA, 'cos', 'sinh', 'g.xi', 'g.eta')} + g.eta)*{_K} + 500000D"
    # A zone has its own false northing, also for a point beyond the equator.
    north = f"({_series(geo._ALPHA, 'sin', 'cosh', 'g.xi', 'g.eta')} + g.xi)*{_K} + if({epsg} >= 32700, 1e7D, 0D)"
    angles = "named_struct('xi', atan2(h.t, cos(h.dl)), 'eta', atanh(sin(h.dl)/sqrt(h.t*h.t + 1D)))"
    utm = _let(f"named_struct('t', {t}, 'dl', radians({lon}) - {_MERIDIAN.format(epsg)})", "h", _let(angles, "g", f"named_struct('x', {east}, 'y', {north})"))
    mercator = f"named_struct('x', radians({lon})*{_RADIUS}, 'y', asinh(tan(radians({lat})))*{_RADIUS})"
    return f"case when {epsg} = 4326 then named_struct('x', {lon}, 'y', {lat}) when {epsg} = 3857 then {mercator} else {utm} end"


def unproject(x: str, y: str, epsg: str) -> str:
    """SQL text of struct(x, y): longitude and latitude of projected coordinates."""
    flat = f"named_struct('xi', ({y} - if({epsg} >= 32700, 1e7D, 0D))/{_K}, 'eta', ({x} - 500000D)/{_K})"
    back = f"named_struct('xi', h.xi - ({_series(geo._BETA, 'sin', 'cosh', 'h.xi', 'h.eta')}), 'eta', h.eta - ({_series(geo._BETA, 'cos', 'sinh', 'h.xi', 'h.eta')}))"
    turn = " + ".join(f"{v!r}D*sin({2 * j}D*chi)" for j, v in enumerate(geo._DELTA, start=1))
    lat = _let("asin(sin(g.xi)/cosh(g.eta))", "chi", f"degrees(chi + {turn})")
    utm = _let(flat, "h", _let(back, "g", f"named_struct('x', degrees({_MERIDIAN.format(epsg)} + atan2(sinh(g.eta), cos(g.xi))), 'y', {lat})"))
    mercator = f"named_struct('x', degrees({x}/{_RADIUS}), 'y', degrees(atan(sinh({y}/{_RADIUS}))))"
    return f"case when {epsg} = 4326 then named_struct('x', {x}, 'y', {y}) when {epsg} = 3857 then {mercator} else {utm} end"


def to_pixel(at: str) -> str:
    """SQL text of struct(x: column, y: row) of projected coordinates: the affine transform inverted, rotations included."""
    return f"named_struct('x', (({at}.x - c)*e - ({at}.y - f)*b)/(a*e - b*d), 'y', (({at}.y - f)*a - ({at}.x - c)*d)/(a*e - b*d))"


def pixel_polygons(lonlat: str) -> Column:
    """A longitude/latitude geometry with x as columns and y as rows of the grid on the same row."""
    point = _let(project("v.x", "v.y", "epsg"), "o", to_pixel("o"))
    return F.expr(f"transform({lonlat}, p -> transform(p, r -> transform(r, v -> {point})))")


def footprints(grids: DataFrame) -> DataFrame:
    """Grids with the longitude/latitude box (bx0, by0, bx1, by1) of their rasters, widened by MARGIN pixels."""
    n = SIDE_POINTS
    along = f"(i % {n})/{float(n)}D"
    col = f"(col0 - {MARGIN}) + (width + {2 * MARGIN})*case floor(i/{n}) when 0 then {along} when 1 then 1D when 2 then 1D - {along} else 0D end"
    row = f"(row0 - {MARGIN}) + (height + {2 * MARGIN})*case floor(i/{n}) when 0 then 0D when 1 then {along} when 2 then 1D else 1D - {along} end"
    place = _let(f"named_struct('col', {col}, 'row', {row})", "q", "named_struct('x', a*q.col + b*q.row + c, 'y', d*q.col + e*q.row + f)")
    corner = _let(place, "u", unproject("u.x", "u.y", "epsg"))
    ring = grids.select("*", once(F.expr(f"transform(sequence(0, {4 * n - 1}), i -> {corner})")).alias("outline"))
    sides = {"bx0": "array_min(transform(outline, v -> v.x))", "by0": "array_min(transform(outline, v -> v.y))", "bx1": "array_max(transform(outline, v -> v.x))", "by1": "array_max(transform(outline, v -> v.y))"}
    return ring.select(*grids.columns, *[F.expr(e).alias(name) for name, e in sides.items()])


def lonlat_boxes(fields: DataFrame, *, keep: tuple[str, ...]) -> DataFrame:
    """Fields given by lon0, lat0, lon1, lat1 as polygons."""
    return fields.select(*keep, poly.rectangle(c("lon0"), c("lat0"), c("lon1"), c("lat1")).alias("geometry"))


def on_grids(fields: DataFrame, grids: DataFrame, *, key: str = "field_id", geometry_column: str = "geometry", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, grid_no, geometry in its pixels, extent) for every grid whose footprint the box of a field touches.

    Boxes meet in cells of the longitude/latitude plane, so this is an equi-join too. It is shuffled also where the
    grids are small: projecting is the work here, and a broadcast would leave it to the few tasks that read the fields.
    """
    shaped = fields.select(key, *keep, once(c(geometry_column)).alias("lonlat"))
    boxed = shaped.select(key, *keep, "lonlat", once(poly.bounds(c("lonlat"))).alias("box")).select(key, *keep, "lonlat", "box.*")
    met = geometry.join_boxes(boxed, footprints(grids).hint("merge"), on=[], cell=CELL)
    pixels = pixel_polygons("lonlat")
    return met.select(key, *keep, "grid_no", *EXTENT, once(pixels).alias("geometry"))


def grid_spans(pairs: DataFrame, *, key: str = "field_id") -> DataFrame:
    """(key, grid_no, rw, c0, c1): what of each field lies on the rasters of each grid."""
    return spatial.spans(pairs, key=(key, "grid_no"), extent=EXTENT)


def field_spans(fields: DataFrame, grids: DataFrame, *, key: str = "field_id") -> DataFrame:
    return grid_spans(on_grids(fields, grids, key=key), key=key)


def windows(pairs: DataFrame, *, key: str = "field_id", padding: int = 1) -> DataFrame:
    """Whole-pixel read window of each field on each grid it meets: floor/ceil, padded, clamped; none where it misses the raster."""
    box = pairs.select(key, "grid_no", *EXTENT, poly.bounds(c("geometry")).alias("p"))
    row1, col1 = c("row0") + c("height"), c("col0") + c("width")
    cut = box.select(
        key, "grid_no",
        F.greatest(F.floor("p.y0") - padding, c("row0")).alias("row_start"),
        F.least(F.ceil("p.y1") + padding, row1).alias("row_stop"),
        F.greatest(F.floor("p.x0") - padding, c("col0")).alias("col_start"),
        F.least(F.ceil("p.x1") + padding, col1).alias("col_stop"),
    )
    return cut.where("row_stop > row_start and col_stop > col_start")


def join_pixels(pixels: DataFrame, found: DataFrame, *, tile: int = spatial.TILE, salt: int = 1) -> DataFrame:
    """Pixels (grid_no, rw, cl) inside the spans of fields on their own grid."""
    return spatial.join_spans(pixels, found, tile=tile, salt=salt, on=("grid_no",))


def join_wanted(pixels: DataFrame, found: DataFrame, wanted: DataFrame, *, tile: int = spatial.TILE, asked_only: bool = False) -> DataFrame:
    """Pixels of the wanted (field_id, scene_id) pairs only.

    ``wanted`` has distinct field_id, scene_id, grid_no (and other columns of a
    pair). The pairs are laid over the spans first; scenes that nobody asks for
    leave the pixel table before anything is joined, and the spans then meet
    pixels of their own scene only, so no other pixel is ever paired with a field.
    ``asked_only`` says that ``pixels`` hold no such scenes any more: leaving them out earlier,
    where rows are fewer and smaller, spares a shuffle of all pixels.
    """
    laid = found.join(wanted, ["field_id", "grid_no"])
    asked = pixels if asked_only else pixels.join(wanted.select("scene_id").distinct(), "scene_id", "left_semi")
    return spatial.join_spans(asked.drop("grid_no"), laid, tile=tile, on=("scene_id",))


def sample_points(codes: DataFrame, points: DataFrame, grids: DataFrame, scenes: DataFrame) -> DataFrame:
    """Raster value under each point in every scene of its grid, masked when outside its field, the raster or the data.

    ``points`` carries grid_no, lon, lat and its field's longitude/latitude
    ``geometry``, ``scenes`` scene_id and grid_no. A point is tested and brought to
    its grid once, then laid over the scenes; the join with pixels is an
    equi-join on (scene_id, rw, cl).
    """
    keep = [n for n in points.columns if n not in ("geometry", "lon", "lat", "grid_no")]
    inside = poly.contains(poly.edges(c("geometry")), c("lon"), c("lat"))
    placed = (
        points.join(grids.select("grid_no", "epsg", *AFFINE), "grid_no")
        .select(*keep, "grid_no", *AFFINE, once(inside).alias("inside"), "lon", "lat", "epsg")
        .select(*keep, "grid_no", *AFFINE, "inside", once(F.expr(project("lon", "lat", "epsg"))).alias("at"))
        .select(*keep, "grid_no", "inside", once(F.expr(to_pixel("at"))).alias("p"))
        .select(*keep, "grid_no", "inside", F.floor("p.y").alias("rw"), F.floor("p.x").alias("cl"))
    )
    located = placed.join(scenes.select("scene_id", "grid_no"), "grid_no").select(*keep, "scene_id", "inside", "rw", "cl")
    value = F.when(c("inside") & (c("code") != -32768), c("code") / 10000.0)
    return located.join(codes.select("scene_id", "rw", "cl", "code"), ["scene_id", "rw", "cl"], "left").select(
        *keep, "scene_id", value.alias("value"), value.isNull().alias("masked")
    )
