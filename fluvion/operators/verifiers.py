"""Verifiers of whole products: networks, conservation between two grids, recomputed samples, time axes, pruned reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions.physics import great_circle_km
from fluvion.operators.graph import loops
from fluvion.session import spread


def link_geometry(network: DataFrame, cells: DataFrame, n_cols: int, node: str = "cell_id", to: str = "next_id") -> DataFrame:
    """``(node, to, row_step, col_step, neighbour, km)`` of every link between two known, different cells; columns wrap at ``n_cols``.

    ``cells``: node, row, col, lat, lon. A neighbour is one of the eight around.
    """
    at = lambda name, p: cells.select(F.col(node).alias(name), *[F.col(c).alias(f"{p}{c}") for c in ("row", "col", "lat", "lon")])
    links = network.where(F.col(to).isNotNull() & (F.col(to) != F.col(node))).select(F.col(node).alias("node"), F.col(to).alias("to"))
    both = links.join(spread(at("node", "_a")), "node").join(spread(at("to", "_b")), "to")
    half = n_cols // 2
    across = F.pmod(F.col("_bcol") - F.col("_acol") + half, F.lit(n_cols)) - half
    down = F.col("_brow") - F.col("_arow")
    return both.select("node", "to", down.alias("row_step"), across.alias("col_step"), ((F.abs(down) <= 1) & (F.abs(across) <= 1)).alias("neighbour"), great_circle_km(F.col("_alat"), F.col("_alon"), F.col("_blat"), F.col("_blon")).alias("km"))


def network_checks(network: DataFrame, cells: DataFrame, n_cols: int, node: str = "cell_id", to: str = "next_id", active: str = "active") -> DataFrame:
    """``(check, n, first, status)`` of a routing network: repeated nodes, nodes that are no active cells, active cells without a node,
    pointers to unknown nodes, links beyond the eight neighbours, and cells on loops. ``first`` is the smallest node concerned; a check passes with none."""
    ids = network.select(F.col(node).alias("n"), F.col(to).alias("t"))
    on = cells.where(active).select(F.col(node).alias("n")).distinct()
    known = ids.select("n").distinct()
    found = {
        "repeated": ids.groupBy("n").agg(F.count("*").alias("_c")).where("_c > 1").select("n"),
        "not_active": known.join(spread(on), "n", "left_anti"),
        "without_node": on.join(spread(known), "n", "left_anti"),
        "unknown_target": ids.where("t is not null").join(spread(known.select(F.col("n").alias("t"))), "t", "left_anti").select("n"),
        "far_target": link_geometry(network, cells, n_cols, node, to).where("not neighbour").select(F.col("node").alias("n")),
        "loop": loops(network.dropDuplicates([node]), node, to).select(F.col("node").alias("n")),
    }
    each = reduce(lambda a, b: a.unionByName(b), [d.agg(F.count("*").alias("n"), F.min("n").alias("first")).select(F.lit(c).alias("check"), "n", "first") for c, d in found.items()])
    return each.withColumn("status", F.when(F.col("n") == 0, "passed").otherwise("failed"))


def conservation(parents: DataFrame, children: DataFrame, weights: DataFrame, parent: str, child: str, kind: str, amount: str, share: str, tolerance: float = 1e-6) -> DataFrame:
    """Amounts on two grids compared through their overlap, kind by kind, with what is lost told apart: one row per parent and kind.

    ``weights`` (parent, child, share): the share of a child that lies in a
    parent. ``expected`` is the parent's amount, ``held`` the sum of its
    children's shares. ``uncovered`` counts parents' amounts without any child
    there, ``foreign`` amounts of children that no parent of that kind asked
    for; what remains is ``drift``. ``status`` fails beyond the tolerance,
    relative to the larger of both. Children that no weight names are rows with
    a null parent.
    """
    placed = children.join(weights.select(parent, child, F.col(share).alias("_s")), child, "left")
    held = placed.groupBy(parent, kind).agg(F.sum(F.col(amount) * F.coalesce("_s", F.lit(1.0))).alias("held"), F.count("*").alias("n_children"))
    covered = weights.select(F.col(parent).alias("_p")).distinct()
    asked = parents.groupBy(parent, kind).agg(F.sum(amount).alias("expected"))
    # Null parents never meet a row of the other side.
    both = asked.join(held, [parent, kind], "full").join(covered, F.col(parent) == F.col("_p"), "left")
    expected, there = F.coalesce("expected", F.lit(0.0)), F.coalesce("held", F.lit(0.0))
    lost = expected - there
    bare, foreign = F.col("_p").isNull() & F.col("held").isNull(), F.col("expected").isNull()
    return both.select(
        parent, kind, expected.alias("expected"), there.alias("held"), F.coalesce("n_children", F.lit(0)).alias("n_children"), F.when(bare, expected).otherwise(0.0).alias("uncovered"), F.when(foreign, there).otherwise(0.0).alias("foreign"),
        F.when(bare | foreign, 0.0).otherwise(lost).alias("drift"), F.when(F.abs(lost) <= tolerance * F.greatest(F.abs(expected), F.abs(there), F.lit(1e-300)), "passed").otherwise("failed").alias("status"),
    )


def conservation_verdict(checked: DataFrame, kind: str) -> DataFrame:
    """One row per kind: totals of both grids, what was lost and why, and the verdict over all parents."""
    sums = [F.sum(c).alias(c) for c in ("expected", "held", "uncovered", "foreign", "drift")]
    failed = F.count_if(F.col("status") == "failed")
    return checked.groupBy(kind).agg(F.count("*").alias("n_parents"), *sums, failed.alias("n_failed"), F.when(failed == 0, "passed").otherwise("failed").alias("status"))


def drawn(keys: list[str | Column], share: float, seed: int = 0) -> Column:
    """Whether a row belongs to a fixed pseudo-random share, by a digest of its keys: the same rows on every run and on every side."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < int(share * (1 << 32))


def recomputed(unit: DataFrame, source: DataFrame, weights: DataFrame, keys: list[str], time: str, cell: str, coarse: str, value: str, weight: str, tolerance: float) -> DataFrame:
    """Per unit: the values of the days drawn in ``unit`` against the weighted mean of their coarse cells, in one pass.

    ``weights`` (cell, coarse, weight). Columns: n, n_missing (no source),
    slope and intercept of value on recomputed value, worst (largest
    difference) and status. Weights are normalised over the coarse cells that
    have a value.
    """
    # Only the cells and days of the sample meet their sources, so no row is made that the sample does not ask for.
    asked = unit.select(*keys, time, cell).distinct().join(weights.select(cell, coarse, weight), cell)
    fine = asked.join(source.select(*keys, time, coarse, F.col(value).alias("_v")).where("_v is not null"), [*keys, time, coarse])
    means = fine.groupBy(*keys, time, cell).agg((F.sum(F.col(weight) * F.col("_v")) / F.sum(weight)).alias("_again"))
    both = unit.join(means, [*keys, time, cell], "left")
    v, again = F.col(value), F.col("_again")
    worst = F.max(F.abs(v - again))
    return both.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(again.isNull()).alias("n_missing"), F.regr_slope(v, again).alias("slope"), F.regr_intercept(v, again).alias("intercept"), worst.alias("worst"),
        F.when((F.count_if(again.isNull()) == 0) & (worst <= tolerance), "passed").otherwise("failed").alias("status"),
    )


def days_in_year(year: Column, kind: str) -> Column:
    """Days of a year in a calendar: ``proleptic_gregorian``, ``365_day`` or ``360_day``."""
    if kind == "proleptic_gregorian":
        return F.when((F.pmod(year, F.lit(4)) == 0) & ((F.pmod(year, F.lit(100)) != 0) | (F.pmod(year, F.lit(400)) == 0)), 366).otherwise(365)
    return F.lit({"365_day": 365, "360_day": 360}[kind])


def year_axes(days: DataFrame, keys: list[str], year: str, day: str, calendar: str) -> DataFrame:
    """Per key and year of a daily axis: n, n_days, missing (days of the year that lack, ascending), repeated and outside (how many), and complete.

    The days seen are bits of seven numbers, so partial results of any number of
    tasks have 56 bytes and merge by ``bit_or``; ``calendar`` names the column
    with the calendar of a key.
    """
    bit = lambda w: F.when(F.floor((F.col(day) - 1) / 60) == w, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(day) - 1, F.lit(60)).cast("int"))).otherwise(F.lit(0).cast("long"))
    whole = reduce(lambda c, k: c.when(F.col(calendar) == k, days_in_year(F.col(year), k)), ("365_day", "360_day"), F.when(F.col(calendar) == "proleptic_gregorian", days_in_year(F.col(year), "proleptic_gregorian")))
    whole = whole.otherwise(F.raise_error(F.lit("unknown calendar")).cast("int"))
    inside = F.col(day).between(1, F.col("_whole"))
    marked = days.withColumn("_whole", whole)
    seen = marked.groupBy(*keys, year).agg(F.max("_whole").alias("n_days"), F.count("*").alias("n"), F.count_if(~inside).alias("outside"), *[F.bit_or(F.when(inside, bit(w)).otherwise(F.lit(0).cast("long"))).alias(f"_b{w}") for w in range(7)])
    held = reduce(lambda a, b: a + b, [F.bit_count(f"_b{w}") for w in range(7)])
    words = F.array(*[f"_b{w}" for w in range(7)])
    lacks = F.filter(F.sequence(F.lit(1), F.col("n_days")), lambda d: F.getbit(F.element_at(words, (F.floor((d - 1) / 60) + 1).cast("int")), F.pmod(d - 1, F.lit(60)).cast("int")) == 0)
    out = seen.withColumn("missing", lacks).withColumn("repeated", F.col("n") - F.col("outside") - held)
    return out.select(*keys, year, "n", "n_days", "missing", "repeated", "outside", ((F.size("missing") == 0) & (F.col("repeated") == 0) & (F.col("outside") == 0)).alias("complete"))


def write_by_year(df: DataFrame, path: str, run: str, year: str) -> None:
    """A product in folders by run and year; each year's rows are brought together first, so a year has few files."""
    df.repartition(run, year).write.mode("errorifexists").partitionBy(run, year).option("compression", "zstd").parquet(path)


def read_years(spark: SparkSession, path: str, wanted: DataFrame, run: str, year: str) -> DataFrame:
    """The rows of the runs and years in ``wanted``.

    The join is on the folders' columns, so Spark's dynamic pruning reads no
    folder that is not asked for, also where the list is the result of a query.
    """
    return spark.read.parquet(path).join(F.broadcast(wanted.select(run, year).distinct()), [run, year])


def near_cells(cells: DataFrame, seeds: DataFrame, node: str, reach: int, n_cols: int) -> DataFrame:
    """``(node, steps)`` of the cells at most ``reach`` rows and columns (which wrap) from a seed, with the steps to the nearest. ``cells``: node, row, col."""
    at = cells.select(node, "row", "col")
    step = F.sequence(F.lit(-reach), F.lit(reach))
    spread = at.join(seeds.select(node).distinct(), node, "left_semi").select("row", "col", F.explode(step).alias("_i")).select("row", "col", "_i", F.explode(step).alias("_j"))
    around = spread.groupBy((F.col("row") + F.col("_i")).alias("row"), F.pmod(F.col("col") + F.col("_j"), F.lit(n_cols)).alias("col")).agg(F.min(F.greatest(F.abs("_i"), F.abs("_j"))).alias("steps"))
    return at.join(around, ["row", "col"]).select(node, "steps")
