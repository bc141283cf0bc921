"""Points and polygons (edge tables x1, y1, x2, y2): which polygon holds a point, and which is nearest to one that none holds.

Edges are dealt into the square cells that they cross. A cell has a reference
point whose polygons are known from the edges that cross its row, so a point
meets only the edges of its own cell: it is inside where its way to the
reference point crosses an odd number of edges more or less.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.operators.nearest import descend, extent
from fluvion.session import materialise

#: Place of the reference point in its cell, off the round numbers that data lie on. Edges may meet it all the same; half-open rules settle that.
REFERENCE = (0.5182871, 0.4871353)
EDGE = ("x1", "y1", "x2", "y2")
#: Parts that the points of a cell are dealt into, each with a copy of the cell's edges.
SALT = 8


def edge_cells(edges: DataFrame, size: float) -> DataFrame:
    """Each edge with the cells ``_cx, _cy`` that it crosses or touches: column by column, the rows between its heights there."""
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    columns = edges.withColumn("_cx", F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size))))
    left, right = F.greatest(lo, F.col("_cx") * size), F.least(hi, (F.col("_cx") + 1) * size)
    slope = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    height = lambda x: F.when(F.col("x1") == F.col("x2"), F.col("y1")).otherwise(F.col("y1") + (x - F.col("x1")) * slope)
    a, b = height(left), F.when(F.col("x1") == F.col("x2"), F.col("y2")).otherwise(height(right))
    # Rounding may put a height on the wrong side of a cell's edge, but not below or above both ends.
    slack, bottom, top = 1e-9 * size, F.least("y1", "y2"), F.greatest("y1", "y2")
    return columns.withColumn("_cy", F.explode(F.sequence(F.floor(F.greatest(F.least(a, b) - slack, bottom) / size), F.floor(F.least(F.greatest(a, b) + slack, top) / size))))


def reference_cells(edges: DataFrame, polygon: str, size: float) -> DataFrame:
    """``(polygon, _cx, _cy)`` of the cells whose reference point a polygon holds: between the odd and the even crossings of their row's line."""
    rx, ry = REFERENCE
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.where("y1 <> y2").withColumn("_cy", F.explode(F.sequence(F.floor(low / size - ry), F.floor(high / size - ry) + 1)))
    line = (F.col("_cy") + ry) * size
    crossed = rows.where((F.col("y1") > line) != (F.col("y2") > line)).withColumn("_x", (F.col("x2") - F.col("x1")) * (line - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    # Points left of a crossing count it; runs go from each odd crossing to the next even one.
    sorted_ = crossed.groupBy(polygon, "_cy").agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    runs = sorted_.select(polygon, "_cy", F.explode(F.filter(F.transform("_xs", lambda x, i: F.struct(x.alias("a"), F.get("_xs", i + 1).alias("b"), (i % 2).alias("k"))), lambda r: (r["k"] == 0) & r["b"].isNotNull())).alias("_r"))
    # Reference points with a <= x < b.
    first, last = F.ceil(F.col("_r.a") / size - rx), F.ceil(F.col("_r.b") / size - rx) - 1
    return runs.where(first <= last).select(polygon, "_cy", F.explode(F.sequence(first, last)).alias("_cx"))


def in_polygons(points: DataFrame, edges: DataFrame, point: str, polygon: str, x: str, y: str, size: float) -> DataFrame:
    """``(point, polygon)`` of the polygons that hold each point: an odd number of edges lies to its right.

    A point exactly on an edge belongs to one side of it, as by the half-open
    rule: lower ends count and upper ends do not, crossings right of the point
    count and those on it do not. Null coordinates are in no polygon. The
    points of a cell are dealt into parts, so a cell with any share of all
    points spreads.
    """
    rx, ry = REFERENCE
    edges = edges.select(polygon, *[F.col(c).cast("double").alias(c) for c in EDGE])
    at = points.select(F.col(point), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where("_x is not null and _y is not null")
    at = at.select("*", F.monotonically_increasing_id().alias("_row"), F.floor(F.col("_x") / size).alias("_cx"), F.floor(F.col("_y") / size).alias("_cy"), F.pmod(F.xxhash64(point, "_x", "_y"), F.lit(SALT)).alias("_part"))
    held = reference_cells(edges, polygon, size).select(polygon, *[F.lit(None).cast("double").alias(c) for c in EDGE], "_cx", "_cy")
    index = edge_cells(edges, size).select(polygon, *EDGE, "_cx", "_cy").unionByName(held).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    met = at.join(index, ["_cx", "_cy", "_part"])
    to_x, to_y = (F.col("_cx") + rx) * size, (F.col("_cy") + ry) * size
    # The way from the point to the reference point: along its own height, then along the reference point's column.
    crossing_x = (F.col("x2") - F.col("x1")) * (F.col("_y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    level = ((F.col("y1") > F.col("_y")) != (F.col("y2") > F.col("_y"))) & ((crossing_x > F.col("_x")) != (crossing_x > to_x))
    crossing_y = (F.col("y2") - F.col("y1")) * (to_x - F.col("x1")) / (F.col("x2") - F.col("x1")) + F.col("y1")
    upright = ((F.col("x1") > to_x) != (F.col("x2") > to_x)) & ((crossing_y > F.col("_y")) != (crossing_y > to_y))
    crossed = F.when(F.col("x1").isNull(), 1).otherwise(F.coalesce(level, F.lit(False)).cast("int") + F.coalesce(upright, F.lit(False)).cast("int"))
    return met.groupBy("_row", point, polygon).agg(F.sum(crossed).alias("_n")).where("_n % 2 = 1").select(point, polygon).distinct()


def edge_distance(x: Column, y: Column) -> Column:
    """Distance of a point from the segment in the columns x1, y1, x2, y2."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    share = F.coalesce(F.try_divide((x - F.col("x1")) * dx + (y - F.col("y1")) * dy, dx * dx + dy * dy), F.lit(0.0))
    share = F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0))
    off_x, off_y = F.col("x1") + share * dx - x, F.col("y1") + share * dy - y
    return F.sqrt(off_x * off_x + off_y * off_y)


def nearest_edges(points: DataFrame, edges: DataFrame, point: str, polygon: str, x: str, y: str, size: float) -> DataFrame:
    """``(point, polygon, distance)`` of the polygon whose edge is nearest to each point (ties: the smallest polygon)."""
    typed = points.select(F.col(point), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where("_x is not null and _y is not null")
    edges = edges.select(polygon, *[F.col(c).cast("double").alias(c) for c in EDGE])
    ends = reduce(lambda a, b: a.unionByName(b), [edges.select(F.col(a).alias("_x"), F.col(b).alias("_y")) for a, b in (("x1", "y1"), ("x2", "y2"))])
    both = extent([typed, ends], ["_x", "_y"])
    if both is None:
        return typed.select(point).where("false").join(edges.select(polygon).where("false"), F.lit(False), "left").withColumn("distance", F.lit(0.0))
    low = [math.floor(v / size) for v in both[0]]
    bits = max(math.floor(h / size) - lo for h, lo in zip(both[1], low, strict=True)).bit_length()
    spots = materialise(typed.select("_x", "_y", (F.floor(F.col("_x") / size) - low[0]).alias("_q0"), (F.floor(F.col("_y") / size) - low[1]).alias("_q1")).distinct(), "spots")
    placed = materialise(edge_cells(edges, size).select(polygon, *EDGE, (F.col("_cx") - low[0]).alias("_g0"), (F.col("_cy") - low[1]).alias("_g1")), "edges")
    pairs = descend(spots.select(F.col("_q0").alias("_g0"), F.col("_q1").alias("_g1")).distinct(), placed.select("_g0", "_g1").distinct(), bits, 2, [], size)
    met = spots.join(pairs, ["_q0", "_q1"]).join(placed, ["_g0", "_g1"])
    best = met.groupBy("_x", "_y").agg(F.min(F.struct(edge_distance(F.col("_x"), F.col("_y")).alias("distance"), F.col(polygon))).alias("_m"))
    return typed.join(best, ["_x", "_y"]).select(point, F.col(f"_m.{polygon}").alias(polygon), F.col("_m.distance").alias("distance"))


def polygon_or_nearest(points: DataFrame, edges: DataFrame, point: str, polygon: str, x: str, y: str, size: float) -> DataFrame:
    """``(point, polygon, distance)``: the polygon that holds each point (of several the smallest) at distance 0, else the one with the nearest edge.

    Only points that no polygon holds are searched for. Points without
    coordinates, and all if there are no polygons, have nulls.
    """
    inside = materialise(in_polygons(points, edges, point, polygon, x, y, size).groupBy(point).agg(F.min(polygon).alias(polygon)).withColumn("distance", F.lit(0.0)), "inside")
    outside = materialise(points.select(point, x, y).join(inside.select(point), point, "left_anti"), "outside")
    found = inside.unionByName(nearest_edges(outside, edges, point, polygon, x, y, size))
    return points.select(point).distinct().join(found, point, "left")
