"""Volume splits, fallback ratios, closure and capacity-limited allocation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.session import Rounds, materialise


def split_volume(parents: DataFrame, children: DataFrame, parent: str, volume: str, weight: str, active: str) -> DataFrame:
    """Children with their ``share`` of the parent's volume and the parent's split class.

    Weights are clamped at 0 and count on active children only. Class 0: no
    volume; 1: by weight; 2: evenly over the active children, as no weight is
    left; 3: lost, as no child is active. Parents without children have one row
    with null child columns and class 3 (or 0).
    """
    w = F.when(F.col(active), F.greatest(F.coalesce(F.col(weight), F.lit(0.0)), F.lit(0.0))).otherwise(0.0)
    sums = children.withColumn("_w", w).groupBy(parent).agg(F.sum("_w").alias("_sum"), F.count_if(F.col(active)).alias("_n"))
    known = parents.join(sums, parent, "left")
    v = F.greatest(F.coalesce(F.col(volume), F.lit(0.0)), F.lit(0.0))
    kind = F.when(v == 0, 0).when(F.col("_sum") > 0, 1).when(F.col("_n") > 0, 2).otherwise(3)
    joined = known.withColumn("split_class", kind).join(children.withColumn("_w", w), parent, "left")
    share = F.when(F.col("split_class") == 1, v * F.col("_w") / F.col("_sum")).when((F.col("split_class") == 2) & F.col(active), v / F.col("_n")).otherwise(0.0)
    return joined.withColumn("share", share).drop("_w", "_sum", "_n")


def ratio_with_fallback(df: DataFrame, part: str, whole: str, levels: list[str]) -> DataFrame:
    """``ratio`` of part to whole in [0, 1]; where whole is 0, of the sums at the first level that has any, then of all rows.

    Only rows with a positive whole enter the sums, which are partial
    aggregates joined back by level: no level's rows ever meet in one task.
    """
    counted = F.col(whole) > 0
    share = F.try_divide(F.sum(F.when(counted, F.col(part))), F.sum(F.when(counted, F.col(whole))))
    out = df
    for level in levels:
        out = out.join(df.where(F.col(level).isNotNull()).groupBy(level).agg(share.alias(f"_{level}")), level, "left")
    own = F.when(counted, F.col(part) / F.col(whole))
    clamp = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    out = out.crossJoin(F.broadcast(df.agg(share.alias("_all"))))
    return out.withColumn("ratio", clamp(F.coalesce(own, *[F.col(f"_{x}") for x in levels], F.col("_all")))).select(*df.columns, "ratio")


def close_shares(df: DataFrame, cell: str, cls: str, share: str, natural: str) -> DataFrame:
    """Shares of each cell brought to a sum of 1: scaled down above it, else the rest goes to the largest existing class, natural ones first."""
    by = Window.partitionBy(cell)
    total = F.sum(share).over(by)
    scaled = df.withColumn("_total", total).withColumn("_s", F.when(F.col("_total") > 1, F.col(share) / F.col("_total")).otherwise(F.col(share)))
    rank = F.row_number().over(by.orderBy(F.desc(F.col("_s") > 0), F.desc(natural), F.desc("_s"), cls))
    rest = 1 - F.sum("_s").over(by)
    return scaled.withColumn("_r", rank).withColumn("_rest", rest).withColumn("closed", F.col("_s") + F.when((F.col("_r") == 1) & (F.col("_s") > 0), F.col("_rest")).otherwise(0.0)).drop("_total", "_s", "_r", "_rest")


def union_tiles(base: DataFrame, wanted: DataFrame, cell: str, cls: str, share: str, placeholder: float) -> DataFrame:
    """Tiles of ``base`` and all wanted ones: missing tiles get the placeholder share, then each cell is normalised; with the number of tiles."""
    both = base.select(cell, cls, share).join(wanted.select(cell, cls).distinct().withColumn("_wanted", F.lit(True)), [cell, cls], "full")
    held = both.withColumn("_s", F.when(F.coalesce(F.col(share), F.lit(0.0)) > 0, F.col(share)).when(F.col("_wanted"), F.lit(placeholder))).where("_s is not null")
    by = Window.partitionBy(cell)
    return held.select(cell, cls, (F.col("_s") / F.sum("_s").over(by)).alias("share"), F.count("*").over(by).alias("n_tiles"))


def fallback_weights(df: DataFrame, parent: str, child: str, capacity: str, demand: str, chain: list[str], small: float) -> DataFrame:
    """Adds ``weight``, ``weight_level`` and ``single``: the first column of ``chain`` with a positive sum over the parent's children.

    Level 1 is the class's own weight; 9 says that no column has any. Where the
    level is 2 or more and the demand is below the share ``small`` of the
    parent's capacity, all goes to the child with the largest weight (ties: the
    smallest child). The demand holds the parent's value on each of its rows.
    """
    w = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0))
    first = lambda c: F.min_by(F.col(child), F.struct(-w(c), F.col(child)))
    sums = df.groupBy(parent).agg(F.sum(w(capacity)).alias("_cap"), *[F.sum(w(c)).alias(f"_s{i}") for i, c in enumerate(chain)], *[first(c).alias(f"_b{i}") for i, c in enumerate(chain)])
    pick = lambda make, rest: reduce(lambda c, i: c.when(F.col(f"_s{i}") > 0, make(i)), range(1, len(chain)), F.when(F.col("_s0") > 0, make(0))).otherwise(rest)
    level = F.when(F.col(demand) > 0, pick(lambda i: F.lit(i + 1), F.lit(9))).otherwise(0)
    out = df.join(sums, parent).withColumn("weight_level", level).withColumn("single", (F.col("weight_level").between(2, 8)) & (F.col(demand) < small * F.col("_cap")))
    best = pick(lambda i: F.col(f"_b{i}"), F.lit(None))
    value = F.when(F.col("single"), ((F.col(child) == best) & (w(capacity) > 0)).cast("double")).otherwise(pick(lambda i: w(chain[i]), F.lit(0.0)))
    return out.withColumn("weight", F.when(F.col("weight_level").between(1, 8), value).otherwise(0.0)).select(*df.columns, "weight", "weight_level", "single")


def water_fill(df: DataFrame, parent: str, child: str, capacity: str, demands: list[str], weights: list[str], max_rounds: int = 60, least: float = 1e-6) -> DataFrame:
    """``(parent, child, *demands, *unplaced_<demand>)``: demands of each parent spread over its children by weight, all classes at once, never above a child's capacity.

    Demands above the parent's capacity are first scaled down together. Each
    round gives every class its remaining demand by weight over the children
    that are not full; a class without such weight spills by their capacity. A
    child that would overflow takes its increments scaled by one factor and is
    full. A parent is done when each class has at most ``least`` left, when all
    its children are full or after ``max_rounds``; what is left then, and what
    the scaling cut, is returned as unplaced on each of the parent's rows. The
    demand columns hold the parent's value on each of its rows.

    Each round is one grouped sum per parent, with partial sums, joined back:
    a parent with any number of children spreads over the cluster.
    """
    n = range(len(demands))
    cap = F.greatest(F.coalesce(F.col(capacity), F.lit(0.0)), F.lit(0.0))
    ask = lambda i: F.greatest(F.coalesce(F.col(demands[i]), F.lit(0.0)), F.lit(0.0))
    state = df.select(
        parent, child, cap.alias("_cap"), F.lit(False).alias("_full"), *[F.greatest(F.coalesce(F.col(w), F.lit(0.0)), F.lit(0.0)).alias(f"_w{i}") for i, w in enumerate(weights)],
        *[ask(i).alias(f"_t{i}") for i in n], *[F.lit(0.0).alias(f"_a{i}") for i in n],
    )
    state = materialise(state, "filling")
    done = Rounds(df.sparkSession, "filled")
    plus = lambda name: reduce(lambda a, b: a + b, [F.col(f"{name}{i}") for i in n])
    for turn in range(max_rounds + 1):
        open_ = ~F.col("_full")
        sums = state.groupBy(parent).agg(
            F.sum("_cap").alias("_all"), F.sum(F.when(open_, F.col("_cap")).otherwise(0.0)).alias("_open"), *[F.max(f"_t{i}").alias(f"_d{i}") for i in n],
            *[F.sum(F.when(open_, F.col(f"_w{i}")).otherwise(0.0)).alias(f"_s{i}") for i in n], *[F.sum(f"_a{i}").alias(f"_g{i}") for i in n],
        )
        total = plus("_d")
        scale = F.when(total > F.col("_all"), F.col("_all") / total).otherwise(1.0)
        sums = sums.select("*", *[F.greatest(F.col(f"_d{i}") * scale - F.col(f"_g{i}"), F.lit(0.0)).alias(f"_r{i}") for i in n])
        ended = reduce(lambda a, b: a & b, [F.col(f"_r{i}") <= least for i in n]) | (F.col("_open") <= 0)
        both = materialise(state.join(sums.withColumn("_ended", ended if turn < max_rounds else F.lit(True)), parent), "filling")
        done.add(both.where("_ended").select(parent, child, *[F.col(f"_a{i}").alias(d) for i, d in enumerate(demands)], *[(F.col(f"_d{i}") - F.col(f"_g{i}")).alias(f"unplaced_{d}") for i, d in enumerate(demands)]))
        live = both.where("not _ended")
        if live.isEmpty():
            return done.rows()
        by_weight = lambda i: F.when(F.col(f"_s{i}") > 0, F.col(f"_w{i}") / F.col(f"_s{i}")).otherwise(F.col("_cap") / F.col("_open"))
        live = live.select("*", *[F.when(~F.col("_full") & (F.col(f"_r{i}") > 0), by_weight(i) * F.col(f"_r{i}")).otherwise(0.0).alias(f"_i{i}") for i in n])
        over = plus("_a") + plus("_i") > F.col("_cap") + 1e-9
        factor = F.when(over, F.greatest(F.col("_cap") - plus("_a"), F.lit(0.0)) / F.nullif(plus("_i"), F.lit(0.0))).otherwise(1.0)
        state = live.withColumn("_over", over).withColumn("_f", F.coalesce(factor, F.lit(0.0)))
        state = materialise(state.select(parent, child, "_cap", (F.col("_full") | F.col("_over")).alias("_full"), *[f"_w{i}" for i in n], *[f"_t{i}" for i in n], *[(F.col(f"_a{i}") + F.col(f"_i{i}") * F.col("_f")).alias(f"_a{i}") for i in n]), "filling")
    return done.rows()
