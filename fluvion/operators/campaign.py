"""Campaigns of dependent runs: shared segments, longest chains, run order, and what a spin-up needs next."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.operators.aggregates import prefix_sums
from fluvion.operators.graph import downstream
from fluvion.session import materialise


def segments(experiments: DataFrame, experiment: str, periods: list[str]) -> DataFrame:
    """``(segment, parent, period, n_experiments)`` of experiments that name what each period runs with; equal beginnings are one segment.

    A period whose column is null is left out. A segment's id is the path of
    all periods up to its own, so experiments share a segment only if they
    share all before it, and its parent is unambiguous.
    """
    kept = F.filter(F.array(*[F.when(F.col(p).isNotNull(), F.struct(F.lit(p).alias("period"), F.concat(F.lit(p), F.lit("="), F.col(p)).alias("name"))) for p in periods]), lambda x: x.isNotNull())
    path = experiments.select(F.col(experiment), kept.alias("_k"))
    each = path.select(experiment, "_k", F.posexplode("_k").alias("_i", "_s"))
    upto = lambda n: F.array_join(F.transform(F.slice("_k", F.lit(1), n), lambda x: x["name"]), "/")
    out = each.select(experiment, upto(F.col("_i") + 1).alias("segment"), F.when(F.col("_i") > 0, upto(F.col("_i"))).alias("parent"), F.col("_s.period").alias("period"))
    return out.groupBy("segment", "parent", "period").agg(F.count_distinct(experiment).alias("n_experiments"))


def years_left(runs: DataFrame, run: str, parent: str, years: str) -> DataFrame:
    """``(run, left)``: the years of each run and of the longest chain of runs that follow from it.

    Each run's way up to its first ancestor gives the years from any ancestor
    on; the largest is the longest chain. Ways are found by pointer doubling.
    """
    up = downstream(runs, runs, run, parent)
    own = runs.select(F.col(run).alias("node"), F.col(years).cast("double").alias("_y"))
    passed = up.join(own, "node").select("seed", "node", "step", "_y")
    along = F.sum("_y").over(Window.partitionBy("seed").orderBy("step"))
    return passed.withColumn("_s", along).groupBy(F.col("node").alias(run)).agg(F.max("_s").alias("left"))


def run_order(runs: DataFrame, run: str, parent: str, years: str, priority: str) -> DataFrame:
    """``(run, left, on_longest, position)``: the longest chain first, then by priority, years left and id.

    The longest chain starts at the first run without a parent with most years
    left (ties: priority, id) and goes on to the child with most left. It is an
    error if a run came before its parent.
    """
    left = materialise(runs.select(run, parent, years, priority).join(years_left(runs, run, parent, years), run), "campaign")
    rank = F.row_number().over(Window.partitionBy(parent).orderBy(F.desc("left"), priority, run))
    best = materialise(left.withColumn("_r", rank).where("_r = 1").select(run, parent, "left"), "best-children")
    # Every parent's best child points on: the chain is the walk from the best root.
    onward = left.select(F.col(run).alias("cell_id")).join(best.where(F.col(parent).isNotNull()).select(F.col(parent).alias("cell_id"), F.col(run).alias("next_id")), "cell_id", "left")
    root = best.where(F.col(parent).isNull()).select(F.col(run).alias("cell_id"))
    chain = downstream(onward, root).select(F.col("node").alias(run), F.lit(True).alias("on_longest"))
    flagged = left.join(chain, run, "left").withColumn("on_longest", F.coalesce("on_longest", F.lit(False)))
    ordered = flagged.select(run, parent, "left", "on_longest", (~F.col("on_longest")).cast("int").alias("_a"), F.col(priority).alias("_b"), (-F.col("left")).alias("_c"), F.lit(1).alias("_one"))
    placed = prefix_sums(ordered, [], ["_a", "_b", "_c", run], "_one", "_before").withColumn("position", F.col("_before") + 1)
    placed = materialise(placed.select(run, parent, "left", "on_longest", "position"), "run-order")
    early = placed.join(placed.select(F.col(run).alias(parent), F.col("position").alias("_p")), parent).where("_p > position")
    if not early.isEmpty():
        raise ValueError("the order puts runs before their parents")
    return placed.select(run, "left", "on_longest", "position")


def spinup_next(blocks: DataFrame, segment: str, block: str, completed: str, test: str, max_blocks: int) -> DataFrame:
    """``(segment, action, block)``: what each spin-up needs after its last block.

    ``render`` the first or, after a failed test, the next block; ``converged``
    if the test passed; ``wait`` while the block runs, or its test has not run
    or could not be evaluated; ``stop`` beyond ``max_blocks`` or at an unknown
    verdict. A segment without a block has a row with a null block.
    """
    last = blocks.groupBy(segment).agg(F.max(F.struct(F.col(block).alias("k"), F.col(completed).alias("done"), F.col(test).alias("test"))).alias("_b"))
    k, done, verdict = F.col("_b.k"), F.col("_b.done"), F.col("_b.test")
    rules: list[tuple[Column, str]] = [
        (k.isNull(), "render"), (~F.coalesce(done, F.lit(False)), "wait"), (verdict.isNull() | (verdict == "not_checked"), "wait"), (verdict == "passed", "converged"), (verdict != "failed", "stop"), (k + 1 > max_blocks, "stop"),
    ]
    action = reduce(lambda c, r: c.when(*r), rules[1:], F.when(*rules[0])).otherwise("render")
    return last.select(segment, action.alias("action"), F.when(action == "render", F.coalesce(k + 1, F.lit(1))).otherwise(k).alias("block"))
