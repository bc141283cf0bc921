"""Points on a river grid: snapping, gauges, one item per cell, serviced reaches.

A grid is a table of cells (row, col, active, area, upstream, ...) whose axes
are regular; a point looks only at the cells around its nearest one, which are
joined by equality.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.functions.physics import area_ratio, great_circle_km
from fluvion.operators.graph import downstream
from fluvion.session import Rounds, materialise, spread



def around(points: DataFrame, lat: str, lon: str, first: tuple[float, float], step: tuple[float, float], n_cols: int, reach: int = 1) -> DataFrame:
    """Each point with the cells (row, col) at most ``reach`` from its nearest one and their ``_order``, the nearest first (0), then by row and column; columns wrap."""
    places = [(0, 0), *[(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if (i, j) != (0, 0)]]
    steps = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"), F.lit(j).alias("j")) for k, (i, j) in enumerate(places)])
    row, col = F.rint((F.col(lat) - first[0]) / step[0]), F.rint((F.col(lon) - first[1]) / step[1])
    moved = points.withColumn("_s", F.explode(steps))
    return moved.select(*points.columns, (row + F.col("_s.i")).cast("long").alias("row"), F.pmod((col + F.col("_s.j")).cast("long"), F.lit(n_cols)).alias("col"), F.col("_s.k").alias("_order"))


def snap(points: DataFrame, cells: DataFrame, item: str, lat: str, lon: str, catchment: str, first: tuple[float, float], step: tuple[float, float], n_cols: int, max_ratio: float = 1.5) -> DataFrame:
    """``(item, row, col, kind, fraction, method, ratio)`` of each point among the active cells around it.

    It starts at its nearest cell or, if that is not active, at the nearest
    active one by great circle. A catchment below the start cell's area makes a
    local point with the fraction of that cell. Any other is global and takes
    the cell whose upstream area is nearest to the catchment (the start wins
    ties), but goes back to the start if even that is off by more than
    ``max_ratio``. ``cells``: row, col, lat, lon, active, area, upstream (km2).
    Without an active cell around it a point has nulls and the method ``none``.
    """
    at = around(points.select(item, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), F.col(catchment).alias("_catch")), "_lat", "_lon", first, step, n_cols)
    near = at.join(cells.where("active").select("row", "col", "area", "upstream", F.col("lat").alias("_clat"), F.col("lon").alias("_clon")), ["row", "col"])
    far = F.when(F.col("_order") == 0, -1.0).otherwise(great_circle_km(F.col("_lat"), F.col("_lon"), F.col("_clat"), F.col("_clon")))
    seen = near.select("*", F.struct(far.alias("far"), F.col("_order").alias("o"), F.col("row").alias("row"), F.col("col").alias("col"), F.col("area").alias("area"), F.col("upstream").alias("up")).alias("_c"))
    # Nine cells a point at most.
    starts = seen.groupBy(item, "_catch").agg(F.min("_c").alias("s"), F.collect_list("_c").alias("_all"))
    off = lambda c: F.struct(F.abs(F.col("_catch") - c["up"]).alias("d"), (c["o"] != F.col("s.o")).alias("x"), c["o"].alias("o"), c["row"].alias("row"), c["col"].alias("col"), c["up"].alias("up"))
    best = starts.select(item, "_catch", "s", F.array_min(F.transform("_all", off)).alias("b"))
    fit = area_ratio(F.col("_catch"), F.col("b.up"))
    local, back = F.coalesce(F.col("_catch") / F.col("s.area") < 1, F.lit(False)), fit > max_ratio
    how = F.when(F.col("s.o") == 0, "nearest").otherwise("nearest_active")
    own = lambda name: F.when(local | back, F.col(f"s.{name}")).otherwise(F.col(f"b.{name}"))
    ending = F.when(local, "_local").when(back, "_global_revert").when(F.col("b.o") == F.col("s.o"), "_global").otherwise("_global_neighbourhood")
    found = best.select(
        item, own("row").alias("row"), own("col").alias("col"), F.when(local, "local").otherwise("global").alias("kind"), F.when(local, F.col("_catch") / F.col("s.area")).otherwise(1.0).alias("fraction"),
        F.concat(how, ending).alias("method"), F.when(~local, F.when(back, area_ratio(F.col("_catch"), F.col("s.up"))).otherwise(fit)).alias("ratio"),
    )
    return points.select(item).join(found, item, "left").withColumn("method", F.coalesce("method", F.lit("none")))


def map_stations(stations: DataFrame, cells: DataFrame, station: str, lat: str, lon: str, area: str, first: tuple[float, float], step: tuple[float, float], n_cols: int, reach: int = 3, max_error: float = 0.3) -> DataFrame:
    """``(station, row, col, upstream, area_error)``: the active cell within ``reach`` whose upstream area has the smallest |log ratio| to the
    station's (ties: nearest rows and columns first). Stations off by more than ``max_error``, or without an area, are left out."""
    known = stations.where(F.col(area) > 0).select(station, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), F.col(area).alias("_area"))
    near = around(known, "_lat", "_lon", first, step, n_cols, reach).join(cells.where("active and upstream > 0").select("row", "col", "upstream"), ["row", "col"])
    error = F.abs(F.log(F.col("upstream") / F.col("_area")))
    best = near.groupBy(station, "_area").agg(F.min(F.struct(error.alias("e"), F.col("_order").alias("o"), F.col("row").alias("row"), F.col("col").alias("col"), F.col("upstream").alias("upstream"))).alias("b"))
    out = best.select(station, "b.row", "b.col", "b.upstream", (F.col("b.upstream") / F.col("_area") - 1).alias("area_error"))
    return out.where(F.abs("area_error") <= max_error)


def place_one_per_cell(df: DataFrame, item: str, cell: str, alternatives: str, order: list[str], future: str, max_rounds: int = 1000) -> DataFrame:
    """``(item, placed, outcome, merged_into)``: in ``order`` (ties: item), each item takes its own cell, else the first free of its alternatives.

    An item without a free cell is ``merged`` into the item on its own cell, or
    ``not_placed`` if ``future`` holds (or if it has no cell). Items that come
    first on all cells they could touch are settled together; whatever comes
    later cannot change them. So a round settles all undisputed items at once,
    and no group of items ever meets in one task.
    """
    by = [*[F.col(c) for c in order], F.col(item)]
    rows = df.select(item, F.col(cell).alias("_cell"), F.coalesce(F.col(alternatives), F.array().cast(df.schema[alternatives].dataType)).alias("_others"), F.coalesce(F.col(future), F.lit(False)).alias("_future"), F.struct(*by).alias("_by"))
    done = Rounds(df.sparkSession, "placed")
    result = lambda d, placed, outcome, host: d.select(item, placed.cast("long").alias("placed"), outcome.alias("outcome"), host.cast(df.schema[item].dataType).alias("merged_into"))
    done.add(result(rows.where("_cell is null"), F.lit(None), F.lit("not_placed"), F.lit(None)))
    rest = materialise(rows.where("_cell is not null"), "placing")
    for _ in range(max_rounds):
        if rest.isEmpty():
            return done.rows()
        touched = rest.select(item, "_by", F.explode(F.array_distinct(F.concat(F.array("_cell"), "_others"))).alias("_c"))
        first = touched.groupBy("_c").agg(F.min("_by").alias("_first"))
        free = touched.join(spread(first), "_c").groupBy(item).agg(F.every(F.col("_by") == F.col("_first")).alias("_ok")).where("_ok").select(item)
        now = materialise(rest.join(spread(free), item, "left_semi"), "settled")
        taken = done.rows().where("outcome in ('placed', 'moved')").select(F.col("placed").alias("_c"), F.col(item).alias("_host"))
        wanted = now.select(item, F.posexplode(F.concat(F.array("_cell"), "_others")).alias("_k", "_c")).join(spread(taken), "_c", "left")
        choice = wanted.groupBy(item).agg(F.min(F.when(F.col("_host").isNull(), F.struct("_k", "_c"))).alias("_best"), F.min(F.when(F.col("_k") == 0, F.col("_host"))).alias("_host"))
        settled = now.join(spread(choice), item)
        spot = F.col("_best._c")
        outcome = F.when(F.col("_best._k") == 0, "placed").when(spot.isNotNull(), "moved").when(F.col("_future"), "not_placed").otherwise("merged")
        done.add(result(settled, spot, outcome, F.when(outcome == "merged", F.col("_host"))))
        rest = materialise(rest.join(spread(free), item, "left_anti"), "placing")
    raise RuntimeError(f"placing did not end in {max_rounds} rounds")


def trace_service(network: DataFrame, seeds: DataFrame, flow: str, active: str, min_fraction: float, max_cells: int, node: str = "cell_id", to: str = "next_id") -> DataFrame:
    """``(seed, node, step, fraction)``: the cells downstream of each seed that it serves, the share of their flow that passed it, one at most.

    A walk ends before a cell without positive flow or below ``min_fraction``;
    inactive cells are passed over; the first ``max_cells`` count. A seed that
    serves none serves itself.
    """
    cells = network.select(F.col(node).alias("node"), F.col(flow).alias("_q"), F.col(active).alias("_on"))
    own = cells.select(F.col("node").alias("seed"), F.col("_q").alias("_q0"))
    good = F.coalesce((F.col("_q0") > 0) & (F.col("_q") > 0) & (F.col("_f") >= min_fraction), F.lit(False))
    found = Rounds(network.sparkSession, "served")
    # Walks are as long as most seeds need; those that neither ended nor served enough go on with longer ones.
    pending, reach = materialise(seeds.select(node).distinct(), "tracing"), 2 * max_cells
    while True:
        walk = downstream(network, pending, node, to, reach).join(spread(cells), "node").join(spread(own), "seed").withColumn("_f", F.try_divide("_q0", "_q"))
        facts = walk.groupBy("seed").agg(F.min(F.when(~good, F.col("step"))).alias("_end"), F.max("step").alias("_far"))
        held = walk.join(spread(facts), "seed").where((F.col("_end").isNull() | (F.col("step") < F.col("_end"))) & F.col("_on"))
        # A walk has no more cells than its bound, and only the first count.
        ranked = held.withColumn("_r", F.row_number().over(Window.partitionBy("seed").orderBy("step"))).where(F.col("_r") <= max_cells)
        ranked = materialise(ranked.select("seed", "node", "step", F.least("_f", F.lit(1.0)).alias("fraction"), "_r"), "ranked")
        full = ranked.where(F.col("_r") == max_cells).select("seed", F.lit(True).alias("_full"))
        open_ = facts.join(spread(full), "seed", "left").where(F.col("_end").isNull() & (F.col("_far") >= reach) & F.col("_full").isNull()).select("seed")
        open_ = materialise(open_, "tracing")
        found.add(ranked.drop("_r").join(open_, "seed", "left_anti"))
        if open_.isEmpty():
            break
        pending, reach = open_.select(F.col("seed").alias(node)), 4 * reach
    served = found.rows()
    none = seeds.select(F.col(node).alias("seed")).distinct().join(served.select("seed"), "seed", "left_anti")
    return served.unionByName(none.select("seed", F.col("seed").alias("node"), F.lit(0).alias("step"), F.lit(1.0).alias("fraction")))


#: Rows of names that one task holds, about.
NAMES_A_TASK = 100_000


def name_candidates(left: DataFrame, right: DataFrame, lid: str, rid: str, name: str, k: int = 3, token_share: float = 0.5) -> DataFrame:
    """``(lid, rid, similarity, rank)``: the ``k`` most similar names on the right that share a word with each name on the left.

    Similarity is 1 less the edit distance over the longer length. Words of at
    most ``token_share`` of the right side join the names, so a word that all
    names hold (dam, lake) makes no pairs by itself.
    """
    words = lambda d, *kept: d.select(*kept, F.explode(F.array_distinct(F.split(F.col(name), " "))).alias("_w")).where("_w <> ''")
    total = right.count()
    # Rows of one id lie in one part, so that their words are counted once without meeting all others.
    dealt = right.select(rid, name).where(F.col(name).isNotNull()).repartition(total // NAMES_A_TASK + 1, rid)
    counts = words(dealt.where(F.col(rid).isNotNull()), rid).distinct().groupBy("_w").agg(F.count("*").alias("_n"))
    usual = counts.where(F.col("_n") <= token_share * total).select("_w")
    # Of equal names only the k smallest ids can be among the first k.
    first = dealt.distinct().withColumn("_i", F.row_number().over(Window.partitionBy(name).orderBy(rid))).where(F.col("_i") <= k)
    r = words(first, F.col(rid), F.col(name).alias("_b")).join(usual, "_w", "left_semi")
    pairs = r.join(spread(words(left, F.col(lid), F.col(name).alias("_a"))), "_w").select(lid, rid, "_a", "_b").distinct()
    longer = F.greatest(F.char_length("_a"), F.char_length("_b"))
    scored = pairs.select(lid, rid, F.round(1 - F.levenshtein("_a", "_b") / longer, 9).alias("similarity"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(lid).orderBy(F.desc("similarity"), rid))).where(F.col("rank") <= k)


def named_region(lat: Column, lon: Column, boxes: list[tuple[str, float, float, float, float]], rest: str = "other") -> Column:
    """Name of the first box (name, south, north, west, east; edges are inside) that holds a point."""
    inside = lambda s, n, w, e: lat.between(s, n) & lon.between(w, e)
    return reduce(lambda c, b: c.when(inside(*b[1:]), b[0]), boxes[1:], F.when(inside(*boxes[0][1:]), boxes[0][0])).otherwise(rest)
