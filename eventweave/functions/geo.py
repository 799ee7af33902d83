"""Coordinates and simple geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dms_to_decimal(text: Column) -> Column:
    """Degrees, minutes and seconds with a letter to signed degrees; null where a part is missing. Decimal commas are read as points."""
    parts = F.filter(F.split(F.replace(text, F.lit(","), F.lit(".")), "[°′″]"), lambda p: p != "")
    n = F.size(parts)
    number = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    value = number(0) + F.when(n > 2, number(1) / 60).otherwise(0.0) + F.when(n > 3, number(2) / 3600).otherwise(0.0)
    letter = F.upper(F.element_at(parts, -1))
    sign = F.when(letter.isin("W", "S"), -1.0).when(letter.isin("N", "E"), 1.0)
    return F.when(n.between(2, 4), value * sign)


def _let(value: Column, body) -> Column:
    """body(value) with value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def rings(wkt: Column) -> Column:
    """All rings of a WKT POLYGON or MULTIPOLYGON, holes too, as arrays of struct(x, y); a POINT is a ring of one; null stays null."""
    pair = lambda p: F.split(F.trim(p), r"\s+")
    point = lambda p: F.struct(F.get(pair(p), F.lit(0)).try_cast("double").alias("x"), F.get(pair(p), F.lit(1)).try_cast("double").alias("y"))
    return F.transform(F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda r: F.transform(F.split(r, ","), point))


def _edges(ring: Column) -> Column:
    n = F.size(ring) - 1
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def edges_of(shape: Column) -> Column:
    """The edges struct(a, b) of all rings."""
    return F.flatten(F.transform(shape, _edges))


def _crossing(e: Column, y: Column) -> Column:
    a, b = e["a"], e["b"]
    return (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] != a["y"], b["y"] - a["y"]).otherwise(1.0) + a["x"]


def within(x: Column, y: Column, edges: Column) -> Column:
    """Is the point inside, not on, a shape: a ray to the right crosses an odd number of all rings' edges, so holes are outside."""

    def crosses(e: Column) -> Column:
        return ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < _crossing(e, y))

    def touches(e: Column) -> Column:
        a, b = e["a"], e["b"]
        level = (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"])
        return level & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    return (F.size(F.filter(edges, crosses)) % 2 == 1) & ~F.exists(edges, touches)


def _extent(shape: Column, c: str) -> tuple[Column, Column]:
    values = F.transform(F.flatten(shape), lambda p: p[c])
    return F.array_min(values), F.array_max(values)


def box_area(wkt: Column) -> Column:
    def area(shape: Column) -> Column:
        (x0, x1), (y0, y1) = _extent(shape, "x"), _extent(shape, "y")
        return (x1 - x0) * (y1 - y0)

    return _let(rings(wkt), area)


def inner_point(wkt: Column) -> Column:
    """struct(x, y) inside a shape: the middle of the widest inner stretch among the lines halfway between corners' heights (a POINT: itself)."""

    def widest(xs: Column, y: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest((F.size(xs) / 2).cast("int") - 1, F.lit(0)))
        spans = F.transform(places, lambda i: F.struct((F.get(xs, i * 2 + 1) - F.get(xs, i * 2)).alias("w"), ((F.get(xs, i * 2 + 1) + F.get(xs, i * 2)) / 2).alias("x")))
        return _let(F.array_max(spans), lambda s: F.struct(s["w"].alias("w"), s["x"].alias("x"), y.alias("y")))

    def at_height(edges: Column, y: Column) -> Column:
        crossed = F.filter(edges, lambda e: (e["a"]["y"] > y) != (e["b"]["y"] > y))
        return _let(F.array_sort(F.transform(crossed, lambda e: _crossing(e, y))), lambda xs: widest(xs, y))

    def between(corners: Column) -> Column:
        return F.zip_with(F.slice(corners, F.lit(1), F.size(corners) - 1), F.slice(corners, F.lit(2), F.size(corners) - 1), lambda a, b: (a + b) / 2)

    def of(shape: Column) -> Column:
        single = F.get(F.get(shape, F.lit(0)), F.lit(0))
        heights = _let(F.array_sort(F.array_distinct(F.transform(F.flatten(shape), lambda p: p["y"]))), between)
        best = _let(edges_of(shape), lambda edges: F.array_max(F.transform(heights, lambda y: at_height(edges, y))))
        found = F.struct(best["x"].alias("x"), best["y"].alias("y"))
        return F.when(F.size(F.flatten(shape)) == 1, F.struct(single["x"].alias("x"), single["y"].alias("y"))).otherwise(found)

    return _let(rings(wkt), of)


def _boxed(shape: Column) -> Column:
    (x0, x1), (y0, y1) = _extent(shape, "x"), _extent(shape, "y")
    return F.struct(edges_of(shape).alias("edges"), x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))


def points_in_regions(points: DataFrame, regions: DataFrame, cell: float = 0.25) -> DataFrame:
    """(columns of points, region) for points (x, y) within regions (region, wkt).

    Both sides meet on grid cells: a region is listed once for each cell of its
    bounding box, a point falls into one, and only those pairs are tested.
    """
    shaped = regions.select("region", F.inline(F.array(_let(rings(F.col("wkt")), _boxed))))
    span = lambda c: F.sequence(F.floor(F.col(f"{c}0") / cell), F.floor(F.col(f"{c}1") / cell))
    cells = shaped.select("region", F.col("edges").alias("edges_"), "y0", "y1", F.explode(span("x")).alias("cx_"))
    cells = cells.select("region", "edges_", "cx_", F.explode(span("y")).alias("cy_"))
    placed = points.withColumns({"cx_": F.floor(F.col("x") / cell), "cy_": F.floor(F.col("y") / cell)})
    met = placed.join(cells, ["cx_", "cy_"]).where(within(F.col("x"), F.col("y"), F.col("edges_")))
    return met.select(*points.columns, "region")
