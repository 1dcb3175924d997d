"""Polygons as arrays of rings: edges, point-in-polygon test, boxes, areas.

A ring is ``array<struct<x:double,y:double>>`` with its first point repeated at
the end; a polygon is an array of rings read by the even-odd rule, so holes and
several parts need no marking.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.missing import as_column

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def _ring_edges(ring: Column) -> Column:
    pairs = F.arrays_zip(
        F.slice(ring, F.lit(1), F.size(ring) - 1).alias("a"),
        F.slice(ring, F.lit(2), F.size(ring) - 1).alias("b"),
    )
    return F.transform(
        pairs,
        lambda p: F.struct(
            p["a"]["x"].alias("x1"),
            p["a"]["y"].alias("y1"),
            p["b"]["x"].alias("x2"),
            p["b"]["y"].alias("y2"),
        ),
    )


def edges(rings: Column | str) -> Column:
    """All sides of all rings as one array of segments."""
    usable = F.filter(as_column(rings), lambda ring: F.size(ring) >= 2)
    return F.flatten(F.transform(usable, _ring_edges))


def edges_in_band(sides: Column, low: Column, high: Column) -> Column:
    """Segments that share some height with the band; the others cannot matter
    to a ray cast sideways from a point inside it."""
    return F.filter(
        sides,
        lambda s: (F.greatest(s["y1"], s["y2"]) >= low) & (F.least(s["y1"], s["y2"]) <= high),
    )


def crossings(x: Column, y: Column, sides: Column) -> Column:
    """Segments that a ray from the point to the right crosses."""

    def crosses(s: Column) -> Column:
        at = (s["x2"] - s["x1"]) * (y - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"]
        return F.when((s["y1"] > y) != (s["y2"] > y), x < at).otherwise(False)

    return F.size(F.filter(sides, crosses))


def on_a_side(x: Column, y: Column, sides: Column) -> Column:
    def touches(s: Column) -> Column:
        turn = (s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"])
        return (
            (turn == 0)
            & x.between(F.least(s["x1"], s["x2"]), F.greatest(s["x1"], s["x2"]))
            & y.between(F.least(s["y1"], s["y2"]), F.greatest(s["y1"], s["y2"]))
        )

    return F.exists(sides, touches)


def strictly_inside(x: Column, y: Column, sides: Column) -> Column:
    """Even-odd test over the segments; points on a side are outside."""
    return (crossings(x, y, sides) % 2 == 1) & ~on_a_side(x, y, sides)


def box(rings: Column | str) -> Column:
    """Bounding box as a struct of xmin, ymin, xmax, ymax."""
    points = F.flatten(as_column(rings))
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def signed_ring_area(ring: Column) -> Column:
    """Shoelace formula; positive for counter-clockwise rings."""
    return F.aggregate(
        _ring_edges(ring),
        F.lit(0.0),
        lambda total, s: total + (s["x1"] * s["y2"] - s["x2"] * s["y1"]),
        lambda total: total / F.lit(2.0),
    )


def closed_rings(rings: Column | str) -> Column:
    """The rings that enclose something: fewer than four points do not."""
    return F.filter(as_column(rings), lambda ring: F.size(ring) >= 4)


def _turned(ring: Column, outer: Column) -> Column:
    sign = F.when(outer, F.lit(1)).otherwise(F.lit(-1))
    return F.when(sign * signed_ring_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def orient(rings: Column | str) -> Column:
    """Turn the first ring counter-clockwise and the others (holes) clockwise; rings of
    fewer than four points are left out."""
    return F.transform(closed_rings(rings), lambda ring, i: _turned(ring, i == 0))


def orient_nested(rings: Column | str) -> Column:
    """Turn rings of any order and turn by their nesting: counter-clockwise outside all
    others or inside an even number of them, else clockwise (holes).

    A ring lies in another one if its first corner or middle of a side off the other's sides
    does; of rings with the same corners the later lies in the earlier. Rings of fewer than
    four points are left out. The work grows with the corners times the rings whose box
    covers theirs.
    """
    closed = closed_rings(rings)
    known = F.transform(
        closed,
        lambda ring: F.struct(ring.alias("ring"), box(F.array(ring)).alias("box"), _ring_edges(ring).alias("sides")),
    )

    def covers(other: Column, mine: Column) -> Column:
        low = (other["xmin"] <= mine["xmin"]) & (other["ymin"] <= mine["ymin"])
        return low & (other["xmax"] >= mine["xmax"]) & (other["ymax"] >= mine["ymax"])

    def inside(mine: Column, other: Column) -> Column:
        """The first corner or middle off the other ring's sides decides; rings do not cross."""

        def decided(side: Column, at: Column, x: Column, y: Column) -> Column:
            near = edges_in_band(other["sides"], y, y)
            place = F.when(on_a_side(x, y, near), 0).when(crossings(x, y, near) % 2 == 1, 1).otherwise(-1)
            return F.when(at != 0, at).otherwise(place)

        def step(at: Column, s: Column) -> Column:
            corner = decided(s, at, s["x1"], s["y1"])
            return F.when(at != 0, at).otherwise(
                decided(s, corner, (s["x1"] + s["x2"]) / 2, (s["y1"] + s["y2"]) / 2)
            )

        return F.aggregate(mine["sides"], F.lit(0), step) == 1

    def corners(ring: Column) -> Column:
        return F.array_sort(F.array_distinct(ring))

    def turned(all_rings: Column) -> Column:
        def one(mine: Column, i: Column) -> Column:
            around = F.filter(
                all_rings,
                lambda other, j: (i != j)
                & covers(other["box"], mine["box"])
                & (
                    inside(mine, other)
                    | ((j < i) & (other["box"] == mine["box"]) & (corners(other["ring"]) == corners(mine["ring"])))
                ),
            )
            return _turned(mine["ring"], F.size(around) % 2 == 0)

        return F.transform(all_rings, one)

    # A one-element array names the rings with their boxes, which are then found once.
    return F.when(F.size(closed) == 1, F.transform(closed, lambda r: _turned(r, F.lit(True)))).otherwise(
        F.get(F.transform(F.array(known), turned), F.lit(0))
    )


def polygon_area(rings: Column | str) -> Column:
    """Area of oriented rings in squared coordinate units; holes subtract."""
    return F.abs(
        F.aggregate(as_column(rings), F.lit(0.0), lambda total, r: total + signed_ring_area(r))
    )


def parts(rings: Column | str) -> Column:
    """Oriented rings as separate polygons: each counter-clockwise ring starts one
    and takes the clockwise rings (holes) after it."""
    column = as_column(rings)

    def add(done: Column, ring: Column) -> Column:
        opened = F.concat(done, F.array(F.array(ring)))
        grown = F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.concat(F.element_at(done, -1), F.array(ring))),
        )
        starts = (F.size(done) == 0) | (signed_ring_area(ring) >= 0)
        return F.when(starts, opened).otherwise(grown)

    return F.aggregate(column, F.array().cast(f"array<{RINGS_TYPE}>"), add)
