"""Graph operators on edge tables: components, outlets, accumulation and levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.session import Rounds, materialise, spread


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an undirected edge table; component is the smallest node reachable.

    Alternates large-star and small-star steps until the edges stay the same;
    each round is written, so the plan never grows. Minima are partial
    aggregates and the joins spread by Spark's skew handling, so a star of any
    size is fine. Self-loops and repeated edges change nothing; a null end is
    no edge.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    named = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    current = materialise(named.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    nodes = current
    current = current.where("a <> b")
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        around = both(current)
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        current = materialise(small, "small-star")
        last, state = state, _state(current)
        if state == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    all_nodes = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return all_nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def outlets(network: DataFrame, node: str = "cell_id", to: str = "next_id", max_rounds: int = 40) -> DataFrame:
    """``(node, outlet)`` of a forest of downstream pointers, by pointer doubling.

    A pointer that is null, its own node or unknown ends at that node. A node
    on, or leading to, a loop has a null outlet. Each round halves what is
    left and is written.
    """
    ids = network.select(F.col(node).alias("node"), F.col(to).alias("_to"))
    known = ids.select(F.col("node").alias("_to"), F.lit(True).alias("_known"))
    jump = ids.join(spread(known), "_to", "left").select("node", F.when(F.col("_known") & (F.col("_to") != F.col("node")), F.col("_to")).otherwise(F.col("node")).alias("to"))
    jump = first = materialise(jump, "outlets")
    # No path without a loop is longer than the number of nodes.
    for _ in range(min(max_rounds, first.count().bit_length())):
        ahead = jump.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        moved = materialise(jump.join(spread(ahead), "to").select("node", F.col("_next").alias("to"), (F.col("to") != F.col("_next")).alias("_moved")), "outlets")
        if moved.where("_moved").isEmpty():
            break
        jump = moved.select("node", "to")
    ends = first.where("node = to").select(F.col("node").alias("to"), F.lit(True).alias("_end"))
    return jump.join(spread(ends), "to", "left").select("node", F.when(F.col("_end"), F.col("to")).alias("outlet"))


def upstream_sum(network: DataFrame, value: str, node: str = "cell_id", to: str = "next_id", max_rounds: int = 40) -> DataFrame:
    """``(node, upstream)``: the sum of ``value`` over each node and all that drains into it.

    Doubling on sums: after round k each node holds the sum over its
    upstream nodes closer than 2**k steps, and pointers reach 2**k steps down.
    Loops are an error.
    """
    ids = network.select(F.col(node).alias("node"), F.col(to).alias("_to"), F.col(value).cast("double").alias("held"))
    known = ids.select(F.col("node").alias("_to"), F.lit(True).alias("_known"))
    state = ids.join(spread(known), "_to", "left").select("node", F.when(F.col("_known") & (F.col("_to") != F.col("node")), F.col("_to")).alias("to"), "held")
    state = materialise(state, "upstream")
    for _ in range(max_rounds):
        live = state.where("to is not null")
        if live.isEmpty():
            return state.select("node", F.col("held").alias("upstream"))
        sent = live.groupBy(F.col("to").alias("node")).agg(F.sum("held").alias("_sent"))
        ahead = state.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        moved = state.join(spread(ahead), "to", "left").select("node", F.col("_next").alias("to"), "held").join(spread(sent), "node", "left")
        state = materialise(moved.select("node", "to", (F.col("held") + F.coalesce("_sent", F.lit(0.0))).alias("held")), "upstream")
    raise ValueError("the network has a loop")


def levels(nodes: DataFrame, edges: DataFrame, node: str = "node", before: str = "before", after: str = "after", max_rounds: int = 10_000) -> DataFrame:
    """``(node, level)``: 0 without predecessors, else one more than the largest level before it; null on and behind a loop.

    A forest, where every node has one successor at most, is solved by pointer
    doubling, in rounds of the logarithm of its depth; any other graph layer by
    layer. Edges from or to a node that is not listed do not count.
    """
    known = materialise(nodes.select(F.col(node).alias("node")).where("node is not null").distinct(), "nodes")
    name = lambda c: known.select(F.col("node").alias(c))
    links = edges.select(F.col(before).alias("before"), F.col(after).alias("after")).where("before <> after").distinct()
    links = materialise(links.join(name("before"), "before", "left_semi").join(name("after"), "after", "left_semi"), "links")
    if links.groupBy("before").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return _forest_levels(known, links)
    return _layers(known, links, max_rounds)


def _forest_levels(known: DataFrame, links: DataFrame) -> DataFrame:
    """Longest way from a source to each node, by doubling: after round k it is right for ways below 2**k steps."""
    state = known.join(links.select(F.col("before").alias("node"), F.col("after").alias("to")), "node", "left").withColumn("level", F.lit(0))
    state = materialise(state, "levels")
    for k in range(known.count().bit_length() + 1):
        live = state.where("to is not null")
        if live.isEmpty():
            break
        sent = live.groupBy(F.col("to").alias("node")).agg(F.max(F.col("level") + (1 << k)).alias("_sent"))
        ahead = live.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        moved = state.join(spread(ahead), "to", "left").join(spread(sent), "node", "left")
        state = materialise(moved.select("node", F.col("_next").alias("to"), F.greatest("level", F.coalesce("_sent", F.lit(0))).alias("level")), "levels")
    # What pointers still reach lies on a loop.
    looped = state.where("to is not null").select(F.col("to").alias("node"), F.lit(True).alias("_loop")).distinct()
    return state.join(spread(looped), "node", "left").select("node", F.when(F.col("_loop").isNull(), F.col("level")).alias("level"))


def _layers(known: DataFrame, links: DataFrame, max_rounds: int) -> DataFrame:
    """Nodes without open predecessors, round by round; each round reads only the links of the nodes it frees."""
    open_ = links.groupBy(F.col("after").alias("node")).agg(F.count("*").alias("_n"))
    done = Rounds(known.sparkSession, "layers")
    ready = done.add(known.join(open_, "node", "left_anti").select("node", F.lit(0).alias("level")))
    waiting = materialise(open_, "waiting")
    for level in range(1, max_rounds):
        freed = links.join(ready.select(F.col("node").alias("before")), "before").groupBy(F.col("after").alias("node")).agg(F.count("*").alias("_freed"))
        left = materialise(waiting.join(freed, "node", "left").select("node", (F.col("_n") - F.coalesce("_freed", F.lit(0))).alias("_n")), "waiting")
        ready = done.add(left.where("_n = 0").select("node", F.lit(level).alias("level")))
        waiting = left.where("_n > 0")
        if ready.isEmpty():
            return done.rows().unionByName(waiting.select("node", F.lit(None).cast("int").alias("level")))
    raise RuntimeError(f"levels did not end in {max_rounds} rounds")


def downstream(network: DataFrame, seeds: DataFrame, node: str = "cell_id", to: str = "next_id", max_steps: int | None = None) -> DataFrame:
    """``(seed, node, step)`` along the pointers from each seed, itself first, to the outlet, to ``max_steps`` or to the first revisit.

    By doubling: round k has the first 2**k places of every walk and adds the
    next as many through pointers of 2**k steps, so a walk of any length takes
    as many rounds as its logarithm. A pointer to a cell that is not in the
    network ends the walk before it.
    """
    ids = network.select(F.col(node).alias("node"), F.col(to).alias("to"))
    jump = ids.where("to is not null and to <> node").join(spread(ids.select(F.col("node").alias("to"))), "to", "left_semi").select("node", "to")
    jump = materialise(jump, "jumps")
    walks = materialise(seeds.select(F.col(node).alias("seed"), F.col(node).alias("node"), F.lit(0).alias("step")), "walks")
    reach = ids.count() if max_steps is None else min(max_steps, ids.count())
    k = 0
    while (1 << k) <= reach and not jump.isEmpty():
        on = walks.join(spread(jump), "node").select("seed", F.col("to").alias("node"), (F.col("step") + (1 << k)).alias("step")).where(F.col("step") <= reach)
        # On a loop a walk meets its own cells again; the first visit counts.
        walks = materialise(walks.unionByName(on).groupBy("seed", "node").agg(F.min("step").alias("step")), "walks")
        jump = materialise(jump.join(spread(jump.select(F.col("node").alias("to"), F.col("to").alias("_next"))), "to").select("node", F.col("_next").alias("to")), "jumps")
        k += 1
    return walks


def follow_chain(edges: DataFrame, starts: DataFrame, target: object, frm: str = "from_code", to: str = "to_code") -> DataFrame:
    """``(start, reached, n_steps)``: whether each start leads to ``target`` over edges that are the only one at each step.

    Pointers with their lengths are doubled; the target and dead ends stay where they are, loops never reach it.
    """
    single = edges.select(F.col(frm).alias("at"), F.col(to).alias("_next")).where(F.col(frm) != target).distinct().groupBy("at").agg(F.count("*").alias("_n"), F.min("_next").alias("_next")).where("_n = 1")
    jump = materialise(single.select("at", F.col("_next").alias("to"), F.lit(1).cast("long").alias("_by")), "chain")
    front = materialise(starts.select("start", F.col("start").alias("at"), F.lit(0).cast("long").alias("n_steps")), "chain")
    for _ in range(jump.count().bit_length() + 1):
        front = materialise(front.join(jump, "at", "left").select("start", F.coalesce("to", "at").alias("at"), (F.col("n_steps") + F.coalesce("_by", F.lit(0))).alias("n_steps")), "chain")
        ahead = jump.select(F.col("at").alias("to"), F.col("to").alias("_next"), F.col("_by").alias("_more"))
        jump = materialise(jump.join(spread(ahead), "to", "left").select("at", F.coalesce("_next", "to").alias("to"), (F.col("_by") + F.coalesce("_more", F.lit(0))).alias("_by")), "chain")
    hit = F.coalesce(F.col("at") == target, F.lit(False))
    return front.select("start", hit.alias("reached"), F.when(hit, F.col("n_steps")).cast("int").alias("n_steps"))


def largest_basins(network: DataFrame, value: str, n: int, node: str = "cell_id", to: str = "next_id") -> DataFrame:
    """``(outlet, total, n_cells, rank)`` of the ``n`` basins with the largest sum of ``value`` (ties: smallest outlet first)."""
    cells = outlets(network, node, to).join(network.select(F.col(node).alias("node"), F.col(value).alias("_v")), "node")
    sums = cells.where("outlet is not null").groupBy("outlet").agg(F.sum("_v").alias("total"), F.count("*").alias("n_cells"))
    # The n largest alone reach the window.
    top = sums.orderBy(F.desc("total"), "outlet").limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), "outlet")))


def crossing_links(links: DataFrame, groups: DataFrame, src: str, dst: str, node: str = "node", group: str = "group") -> DataFrame:
    """Links whose two ends lie in different groups, with both groups; ends without a group belong to none and cross."""
    one = lambda c, g: groups.select(F.col(node).alias(c), F.col(group).alias(g))
    return links.join(one(src, "from_group"), src, "left").join(one(dst, "to_group"), dst, "left").where(~F.col("from_group").eqNullSafe(F.col("to_group")))


def reduce_parents(parents: DataFrame, child: str, parent: str) -> DataFrame:
    """``(node, longest)``: the longest chain of children below each node, 0 where there is none; a loop is an error."""
    nodes = parents.select(F.col(child).alias("node")).union(parents.select(F.col(parent).alias("node"))).where("node is not null").distinct()
    out = levels(nodes, parents.where(F.col(parent).isNotNull()), "node", child, parent)
    return out.select("node", F.coalesce("level", F.raise_error(F.lit("parents form a loop")).cast("int")).alias("longest"))


def loops(network: DataFrame, node: str = "cell_id", to: str = "next_id") -> DataFrame:
    """``(loop, node, place)``: the members of each loop of downstream pointers; its smallest node names it and has place 0.

    Pointers are doubled until they reach past every way that leads to a loop:
    what they still reach lies on loops. The same doubling on those nodes gives
    each the least node ahead of it and the steps to it. A pointer to itself is
    no loop; null and unknown ones end.
    """
    ids = network.select(F.col(node).alias("node"), F.col(to).alias("to")).where("to is not null and to <> node")
    first = materialise(ids.join(spread(ids.select(F.col("node").alias("to"))), "to", "left_semi").select("node", "to"), "pointers")
    rounds = first.count().bit_length()
    jump = first
    for _ in range(rounds):
        jump = materialise(jump.join(spread(jump.select(F.col("node").alias("to"), F.col("to").alias("_next"))), "to").select("node", F.col("_next").alias("to")), "pointers")
        if jump.isEmpty():
            break
    members = jump.select(F.col("to").alias("node")).distinct()
    # (least node met, steps to it) over the next 2**k nodes, itself first; on a loop the way comes round again, and the first meeting counts.
    state = materialise(first.join(spread(members), "node", "left_semi").select("node", "to", F.struct(F.col("node").alias("m"), F.lit(0).cast("long").alias("d")).alias("best")), "loops")
    for k in range(state.count().bit_length()):
        ahead = state.select(F.col("node").alias("to"), F.col("to").alias("_next"), F.struct(F.col("best.m").alias("m"), (F.col("best.d") + (1 << k)).alias("d")).alias("_ahead"))
        state = materialise(state.join(spread(ahead), "to").select("node", F.col("_next").alias("to"), F.least("best", "_ahead").alias("best")), "loops")
    named = state.select("node", F.col("best.m").alias("loop"), F.col("best.d").alias("_d"))
    sizes = named.groupBy("loop").agg(F.count("*").alias("_n"))
    return named.join(spread(sizes), "loop").select("loop", "node", F.pmod(F.col("_n") - F.col("_d"), F.col("_n")).alias("place"))


def downstream_labels(network: DataFrame, seeds: DataFrame, label: str, node: str = "cell_id", to: str = "next_id") -> DataFrame:
    """``(node, label)``: the smallest label among the seeds at or upstream of each node; nodes below no seed are left out.

    By doubling, as in upstream_sum: after round k a node has the least label
    of the seeds closer than 2**k steps above it. Loops are walked round once.
    """
    ids = network.select(F.col(node).alias("node"), F.col(to).alias("_to"))
    known = ids.select(F.col("node").alias("_to"), F.lit(True).alias("_known"))
    first = seeds.groupBy(F.col(node).alias("node")).agg(F.min(label).alias("label"))
    state = ids.join(spread(known), "_to", "left").select("node", F.when(F.col("_known") & (F.col("_to") != F.col("node")), F.col("_to")).alias("to")).join(spread(first), "node", "left")
    state = materialise(state, "labels")
    for _ in range(state.count().bit_length() + 1):
        live = state.where("to is not null")
        if live.isEmpty():
            break
        sent = live.where("label is not null").groupBy(F.col("to").alias("node")).agg(F.min("label").alias("_sent"))
        ahead = state.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        state = materialise(state.join(spread(ahead), "to", "left").join(spread(sent), "node", "left").select("node", F.col("_next").alias("to"), F.least("label", "_sent").alias("label")), "labels")
    return state.where("label is not null").select("node", "label")


def first_hit(network: DataFrame, hit: Column, node: str = "cell_id", to: str = "next_id") -> DataFrame:
    """``(node, found, step)``: the first node for which ``hit`` holds on the way along the pointers, itself included, and the steps to it; nulls where there is none.

    By doubling with the hit carried along: after round k a node knows the first
    hit closer than 2**k steps. Only nodes without one go on, and no walk is
    ever listed.
    """
    ids = network.select(F.col(node).alias("node"), F.col(to).alias("_to"), F.coalesce(hit, F.lit(False)).alias("_hit"))
    known = ids.select(F.col("node").alias("_to"), F.lit(True).alias("_known"))
    ahead = F.when(F.col("_known") & (F.col("_to") != F.col("node")), F.col("_to"))
    own = F.when(F.col("_hit"), F.struct(F.lit(0).cast("long").alias("step"), F.col("node").alias("found")))
    state = materialise(ids.join(spread(known), "_to", "left").select("node", ahead.alias("to"), own.alias("best")), "hits")
    for k in range(state.count().bit_length() + 1):
        if state.where("to is not null and best is null").isEmpty():
            break
        far = state.select(F.col("node").alias("to"), F.col("to").alias("_next"), F.col("best").alias("_far"))
        later = F.when(F.col("_far").isNotNull(), F.struct((F.col("_far.step") + (1 << k)).alias("step"), F.col("_far.found").alias("found")))
        state = materialise(state.join(spread(far), "to", "left").select("node", F.col("_next").alias("to"), F.coalesce("best", later).alias("best")), "hits")
    return state.select("node", F.col("best.found").alias("found"), F.col("best.step").alias("step"))
