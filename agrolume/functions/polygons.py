"""Polygons as ``array<polygon: array<ring: array<struct<x,y>>>>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring(*points: tuple[Column, Column]) -> Column:
    """A closed ring from its corners; the first corner is repeated at the end."""
    return F.array(*[vertex(x, y) for x, y in (*points, points[0])])


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(F.array(ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))))


def vertices(polygons: Column) -> Column:
    return F.flatten(F.flatten(polygons))


def vertex_count(polygons: Column) -> Column:
    return F.size(vertices(polygons))


def bounds(polygons: Column) -> Column:
    """struct(x0, y0, x1, y1) over every vertex, NULL for an empty geometry."""
    xs = F.transform(vertices(polygons), lambda v: v["x"])
    ys = F.transform(vertices(polygons), lambda v: v["y"])
    box = F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )
    return F.when(vertex_count(polygons) > 0, box)


def ring_edges(points: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.size(points) - 1),
        lambda i: F.struct(
            F.element_at(points, i)["x"].alias("x1"), F.element_at(points, i)["y"].alias("y1"),
            F.element_at(points, i + 1)["x"].alias("x2"), F.element_at(points, i + 1)["y"].alias("y2"),
        ),
    )


def edges(polygons: Column) -> Column:
    """All edges of all rings; even-odd filling then handles holes and parts."""
    return F.flatten(F.transform(F.flatten(polygons), ring_edges))


def crossings(edge_list: Column, y: Column) -> Column:
    """Sorted x positions where the horizontal line at ``y`` meets the edges."""
    hit = F.filter(edge_list, lambda e: (e["y1"] > y) != (e["y2"] > y))
    xs = F.transform(
        hit, lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
    )
    return F.array_sort(xs)


def contains(edge_list: Column, x: Column, y: Column) -> Column:
    """Even-odd test of one point, left and bottom edges inside."""
    return F.size(F.filter(crossings(edge_list, y), lambda at: at <= x)) % 2 == 1


def ring_area(points: Column) -> Column:
    """Absolute shoelace area of one ring in its own units."""
    twice = F.aggregate(
        ring_edges(points), F.lit(0.0), lambda acc, e: acc + (e["x1"] * e["y2"] - e["x2"] * e["y1"])
    )
    return F.abs(twice) / 2.0


def area(polygons: Column) -> Column:
    """Outer rings minus holes."""

    def one(polygon: Column) -> Column:
        holes = F.aggregate(
            F.slice(polygon, 2, F.size(polygon)), F.lit(0.0), lambda acc, r: acc + ring_area(r)
        )
        return ring_area(polygon[0]) - holes

    return F.aggregate(polygons, F.lit(0.0), lambda acc, p: acc + one(p))


def is_box(polygons: Column) -> Column:
    """Whether a geometry is one closed ring of four corners with sides along the axes."""
    p = [F.get(F.get(F.get(polygons, F.lit(0)), F.lit(0)), F.lit(k)) for k in range(5)]

    def runs(first: str, second: str) -> Column:
        return (p[0][first] == p[1][first]) & (p[1][second] == p[2][second]) & (p[2][first] == p[3][first]) & (p[3][second] == p[0][second])

    closed = (F.size(polygons) == 1) & (F.size(F.flatten(polygons)) == 1) & (vertex_count(polygons) == 5) & (p[0] == p[4])
    return F.coalesce(closed & (runs("x", "y") | runs("y", "x")), F.lit(False))
