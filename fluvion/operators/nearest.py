"""Nearest neighbours by a joint descent of two grids: cells of what is sought for, and cells of what may be found.

All pairs of occupied cells start as one pair of the whole extent. Each step
halves the edge some times, splits both cells of every pair that is left, and
keeps of a cell's pairs those that could still hold the nearest: whose least
distance is at most the smallest greatest distance. So a cell meets the few
cells around its nearest ones, however far those are, and no step joins by
anything but equality.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.session import materialise

#: Different places that a finest cell may hold before cells are made smaller, and the most halvings.
CROWD, MOST_BITS = 64, 28
#: Steps between written tables: longer plans take longer to make than to run.
STEPS = 4


def descend(sought: DataFrame, held: DataFrame, bits: int, axes: int, keys: list[str], size: float, max_distance: float = math.inf, band: float | None = None) -> DataFrame:
    """Pairs of finest cells ``(keys, _q0.., _g0..)`` that can hold a nearest pair; both sides are distinct cells (keys, _g0..).

    Cells are whole numbers below 2**bits with edges of ``size``; the first
    ``axes`` of them count for the distance. With ``band`` (in edges), one more
    axis follows on which partners may not lie farther apart.
    """
    n = axes + (band is not None)
    each = 3 if n < 3 else 2
    cell = lambda name, k, level: F.shiftright(F.col(f"{name}{k}"), bits - level)
    whole = lambda df, name: df.select(*keys, *[F.lit(0).cast("long").alias(f"{name}{k}") for k in range(n)]).distinct()
    # At the top each side has one cell for each key.
    pairs = whole(sought, "_q").join(whole(held, "_c"), keys or F.col("_q0") == F.col("_c0"))
    level, step = 0, 0
    while level < bits:
        up, level, step = level, min(level + each, bits), step + 1
        for name, side in (("_q", sought), ("_c", held)):
            down = side.select(*keys, *[cell("_g", k, up).alias(f"{name}{k}") for k in range(n)], *[cell("_g", k, level).alias(f"{name}n{k}") for k in range(n)]).distinct()
            others = [c for c in pairs.columns if c not in keys and not c.startswith(name)]
            pairs = pairs.join(down, [*keys, *[f"{name}{k}" for k in range(n)]]).select(*keys, *others, *[F.col(f"{name}n{k}").alias(f"{name}{k}") for k in range(n)])
        apart = [F.abs(F.col(f"_q{k}") - F.col(f"_c{k}")).cast("double") for k in range(n)]
        least = reduce(lambda a, b: a + b, [F.pow(F.greatest(apart[k] - 1, F.lit(0.0)), F.lit(2)) for k in range(axes)])
        most = reduce(lambda a, b: a + b, [F.pow(apart[k] + 1, F.lit(2)) for k in range(axes)])
        edge = float(1 << (bits - level))
        pairs = pairs.withColumn("_least", least)
        if band is not None:
            # Only a pair that is surely within the band bounds the others.
            pairs, most = pairs.where((apart[axes] - 1) * edge <= band + 1e-3), F.when((apart[axes] + 1) * edge <= band, most)
        if max_distance < math.inf:
            pairs = pairs.where(F.col("_least") <= ((max_distance / size) / edge) ** 2 * (1 + 1e-9) + 1e-6)
        bound = F.min(most).over(Window.partitionBy(*keys, *[f"_q{k}" for k in range(n)]))
        pairs = pairs.withColumn("_bound", bound).where(F.col("_bound").isNull() | (F.col("_least") <= F.col("_bound") * (1 + 1e-9) + 1e-6)).drop("_least", "_bound")
        if step % STEPS == 0 and level < bits:
            pairs = materialise(pairs, "cells")
    return pairs.select(*keys, *[f"_q{k}" for k in range(n)], *[F.col(f"_c{k}").alias(f"_g{k}") for k in range(n)])


def extent(sides: list[DataFrame], coordinates: list[str]) -> tuple[list[float], list[float]] | None:
    """Least and greatest value of each coordinate over all tables, or None without rows."""
    both = reduce(lambda a, b: a.unionByName(b), [s.select(*coordinates) for s in sides])
    row = both.agg(*[f(c).cast("double") for c in coordinates for f in (F.min, F.max)]).first()
    return None if row[0] is None else (list(row)[::2], list(row)[1::2])


def fine_enough(places: DataFrame, low: list[float], span: float, coordinates: list[str], keys: list[str]) -> int:
    """The fewest halvings of ``span`` after which no cell holds more than CROWD different places (MOST_BITS at most)."""
    levels = F.explode(F.array(*[F.lit(b) for b in range(4, MOST_BITS + 1, 3)])).alias("_bits")
    cells = places.select("*", levels).select("_bits", *keys, *[F.floor((F.col(c) - lo) / span * F.pow(F.lit(2.0), F.col("_bits"))).alias(c) for c, lo in zip(coordinates, low, strict=True)])
    crowds = cells.groupBy("_bits", *keys, *coordinates).agg(F.count("*").alias("_n")).groupBy("_bits").agg(F.max("_n").alias("_most"))
    fine = crowds.where(F.col("_most") <= CROWD).agg(F.min("_bits")).first()[0]
    return fine or MOST_BITS


def nearest(left: DataFrame, right: DataFrame, lid: str, rid: str, coordinates: list[str], max_distance: float = math.inf, equal: list[str] | None = None, band: tuple[str, float] | None = None) -> DataFrame:
    """For each left row the nearest right row (ties: smallest id) as (lid, rid, distance); left rows without one are left out.

    Partners are equal in the columns ``equal``, at most ``max_distance`` apart
    and, with ``band`` (column, width), at most its width apart in that column.
    Rows with a null coordinate have no partner. Equal places are searched for
    once and held once, so crowds on one spot cost no more than a row each.
    """
    keys, axes = equal or [], len(coordinates)
    spread = [*coordinates, *([band[0]] if band else [])]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*spread, *keys]])
    typed = lambda df, name: df.where(known).select(F.col(name), *keys, *[F.col(c).cast("double").alias(c) for c in spread])
    asked, there = typed(left, lid), typed(right, rid).groupBy(*keys, *spread).agg(F.min(rid).alias(rid))
    places = materialise(asked.select(*keys, *spread).distinct(), "asked")
    there = materialise(there, "places")
    both = extent([places, there], spread)
    if both is None or there.isEmpty():
        return asked.select(lid).where("false").join(there.select(rid).where("false"), F.lit(False), "left").withColumn("distance", F.lit(0.0))
    low, high = both
    span = max(*[h - lo for lo, h in zip(low[:axes], high[:axes], strict=True)], 1e-300) * (1 + 1e-9)
    bits = fine_enough(there, low[:axes], span, coordinates, keys)
    size = span / (1 << bits)
    # The band's axis has an edge of its own: one that deals its extent into as many cells.
    sizes = [size] * axes + [max(h - lo, 1e-300) * (1 + 1e-9) / (1 << bits) for lo, h in zip(low[axes:], high[axes:], strict=True)]
    grid = lambda df, name: df.select("*", *[F.floor((F.col(c) - lo) / s).cast("long").alias(f"{name}{k}") for k, (c, lo, s) in enumerate(zip(spread, low, sizes, strict=True))])
    cells = lambda df: grid(df, "_g").select(*keys, *[f"_g{k}" for k in range(len(spread))]).distinct()
    pairs = descend(cells(places), cells(there), bits, axes, keys, size, max_distance, None if band is None else band[1] / sizes[-1])
    names = [f"_g{k}" for k in range(len(spread))]
    right_side = grid(there, "_g").select(*keys, *names, rid, *[F.col(c).alias(f"_b{k}") for k, c in enumerate(spread)])
    met = grid(places, "_q").join(pairs, [*keys, *[f"_q{k}" for k in range(len(spread))]]).join(right_side, [*keys, *names])
    squares = reduce(lambda a, b: a + b, [(F.col(c) - F.col(f"_b{k}")) * (F.col(c) - F.col(f"_b{k}")) for k, c in enumerate(coordinates)])
    met = met.withColumn("distance", F.sqrt(squares)).where(F.col("distance") <= max_distance)
    if band:
        met = met.where(F.abs(F.col(band[0]) - F.col(f"_b{axes}")) <= band[1] + 1e-9)
    best = met.groupBy(*keys, *spread).agg(F.min(F.struct("distance", rid)).alias("_m")).select(*keys, *spread, F.col(f"_m.{rid}").alias(rid), F.col("_m.distance").alias("distance"))
    return asked.join(best, [*keys, *spread]).select(lid, rid, "distance")
