"""Hand-computed cases and brute-force comparisons of the core operators."""

import math
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from fluvion.functions import physics, rules
from fluvion.operators import aggregates, allocation, campaign, graph, grid, joins, nearest, placement, records
from fluvion.sources import binary, text


def values(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_split_classes(spark):
    parents = spark.createDataFrame([(1, 36.0), (2, 0.0), (3, 7.0), (4, 10.0), (5, None)], "p int, v double")
    children = spark.createDataFrame([(1, 1, 0.0, True), (1, 2, -5.0, True), (2, 3, 1.0, True), (3, 4, 1.0, False), (4, 5, 1.0, True), (4, 6, 3.0, True), (4, 7, 9.0, False)], "p int, c int, w double, a boolean")
    out = allocation.split_volume(parents, children, "p", "v", "w", "a").select("p", "c", "split_class", "share")
    assert values(out, "p", "c") == [(1, 1, 2, 18.0), (1, 2, 2, 18.0), (2, 3, 0, 0.0), (3, 4, 3, 0.0), (4, 5, 1, 2.5), (4, 6, 1, 7.5), (4, 7, 1, 0.0), (5, None, 0, 0.0)]


def plain_fill(rooms, demands, weights, least=1e-6, rounds=60):
    """Water filling of one parent by its rule, child by child."""
    total = sum(demands)
    scale = min(1.0, sum(rooms) / total) if total else 1.0
    given = [[0.0] * len(demands) for _ in rooms]
    full = [False] * len(rooms)
    for _ in range(rounds):
        left = [max(d * scale - sum(g[i] for g in given), 0.0) for i, d in enumerate(demands)]
        open_ = [k for k in range(len(rooms)) if not full[k]]
        if max(left) <= least or sum(rooms[k] for k in open_) <= 0:
            break
        step = [[0.0] * len(demands) for _ in rooms]
        for i, d in enumerate(left):
            of = {k: weights[k][i] for k in open_}
            if sum(of.values()) <= 0:
                of = {k: rooms[k] for k in open_}
            for k, w in of.items():
                step[k][i] = d * w / sum(of.values()) if d > 0 else 0.0
        for k in range(len(rooms)):
            held, asked = sum(given[k]), sum(step[k])
            over = held + asked > rooms[k] + 1e-9
            factor = max(rooms[k] - held, 0.0) / asked if over and asked else 1.0
            given[k] = [g + s * factor for g, s in zip(given[k], step[k], strict=True)]
            full[k] |= over
    return given, [d - sum(g[i] for g in given) for i, d in enumerate(demands)]


def test_water_fill_equals_the_plain_loop(spark):
    draw = random.Random(21)
    rows, want = [], {}
    for g in range(25):
        n = draw.randint(1, 8)
        rooms = [draw.choice([0.0, draw.uniform(0, 9)]) for _ in range(n)]
        demands = [draw.choice([0.0, draw.uniform(0, 12)]) for _ in range(3)]
        weights = [[draw.choice([0.0, draw.uniform(0, 5)]) for _ in range(3)] for _ in range(n)]
        given, unplaced = plain_fill(rooms, demands, weights)
        for c in range(n):
            rows.append((g, c, rooms[c], *demands, *weights[c]))
            want[g, c] = (*given[c], *unplaced)
    df = spark.createDataFrame(rows, "g int, c int, room double, d0 double, d1 double, d2 double, w0 double, w1 double, w2 double")
    out = allocation.water_fill(df, "g", "c", "room", ["d0", "d1", "d2"], ["w0", "w1", "w2"]).collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r)[2:] == pytest.approx(want[r.g, r.c], abs=2e-5)
        assert r.d0 + r.d1 + r.d2 <= next(x[2] for x in rows if x[:2] == (r.g, r.c)) + 1e-6


def test_fallback_weights_of_small_demands_go_to_one_child(spark):
    rows = [("own", 1, 4.0, 1.0, 2.0, 0.0), ("own", 2, 4.0, 1.0, 0.0, 5.0), ("next", 1, 4.0, 7.0, 0.0, 3.0), ("next", 2, 4.0, 7.0, 0.0, 5.0), ("small", 1, 500.0, 7.0, 0.0, 5.0), ("small", 2, 500.0, 7.0, None, 5.0), ("none", 1, 4.0, 1.0, 0.0, -2.0), ("still", 1, 4.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "p string, c int, room double, d double, a double, b double")
    out = allocation.fallback_weights(df, "p", "c", "room", "d", ["a", "b"], 0.02).select("p", "c", "weight", "weight_level", "single")
    assert values(out, "p", "c") == [
        ("next", 1, 3.0, 2, False), ("next", 2, 5.0, 2, False), ("none", 1, 0.0, 9, False), ("own", 1, 2.0, 1, False), ("own", 2, 0.0, 1, False), ("small", 1, 1.0, 2, True), ("small", 2, 0.0, 2, True), ("still", 1, 0.0, 0, False)
    ]


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 3), ("a", 2), ("a", None), ("b", 5), ("c", None)], "b string, v int")
    assert values(aggregates.block_mode(df, ["b"], "v"), "b") == [("a", 2, 0.5, "mixed"), ("b", 5, 1.0, "uniform"), ("c", None, None, "empty")]
    zeros = spark.createDataFrame([("a", 0), ("a", 0), ("a", 4), ("a", 3), ("b", 0), ("c", None)], "b string, v int")
    assert values(aggregates.window_majority(zeros, ["b"], "v"), "b") == [("a", 3), ("b", 0), ("c", 0)]


def test_trend_rules(spark):
    df = spark.createDataFrame([("const", x, 2.0) for x in range(4)] + [("short", 0, 1.0), ("short", 1, 2.0)] + [("gap", x, None if x == 2 else 1.0) for x in range(5)] + [("noise", x, float(x % 2)) for x in range(8)], "k string, x int, y double")
    out = {r.k: r.passed for r in aggregates.trend(df, ["k"], "x", "y", 0.1).collect()}
    assert out == {"const": True, "short": False, "gap": False, "noise": True}


def test_networks(spark):
    """Two rivers, one of which forks upstream, a cell that drains into nowhere known, and one that drains into itself."""
    rows = [(40, 41, 1.5), (41, 45, 2.0), (42, 45, 0.5), (43, 42, 4.0), (45, None, 3.0), (50, 51, 7.0), (51, 51, 1.0), (60, 99, 2.5)]
    n = spark.createDataFrame(rows, "cell_id long, next_id long, area double")
    assert values(graph.outlets(n), "node") == [(40, 45), (41, 45), (42, 45), (43, 45), (45, 45), (50, 51), (51, 51), (60, 60)]
    assert values(graph.upstream_sum(n, "area"), "node") == [(40, 1.5), (41, 3.5), (42, 4.5), (43, 4.0), (45, 11.0), (50, 7.0), (51, 8.0), (60, 2.5)]
    assert values(graph.largest_basins(n, "area", 2), "rank") == [(45, 11.0, 5, 1), (51, 8.0, 2, 2)]
    loop = spark.createDataFrame([(7, 8, 1.0), (8, 9, 1.0), (9, 7, 1.0), (3, 8, 1.0)], "cell_id long, next_id long, area double")
    assert values(graph.outlets(loop), "node") == [(3, None), (7, None), (8, None), (9, None)]
    with pytest.raises(ValueError):
        graph.upstream_sum(loop, "area", max_rounds=8)


def test_levels_of_forests_graphs_and_loops(spark):
    def layers(nodes, edges):
        level, left = {}, set(nodes)
        while ready := [v for v in left if all(a in level for a, b in edges if b == v)]:
            level |= {v: max([level[a] + 1 for a, b in edges if b == v], default=0) for v in ready}
            left -= set(ready)
        return level

    draw = random.Random(9)
    for degree in (1, 3):
        nodes = list(range(40))
        edges = [(a, b) for a in nodes[:-1] for b in draw.sample(range(a + 1, 40), min(degree, 39 - a)) if draw.random() < 0.9] + [(31, 31)]
        edges += [(38, 37), (37, 38)] if degree == 1 else [(20, 5), (5, 20)]
        if degree == 1:
            edges = [(a, b) for a, b in edges if a not in (37, 38)] + [(38, 37), (37, 38)]
        want = layers(nodes, [e for e in edges if e[0] != e[1]])
        got = dict(values(graph.levels(spark.createDataFrame([(v,) for v in nodes], "node int"), spark.createDataFrame(edges, "before int, after int")), "node"))
        assert got == {v: want.get(v) for v in nodes}


def test_walks_end_at_revisits_and_bounds(spark):
    rows = [(1, 2), (2, 3), (3, 4), (4, 2), (6, 7), (7, None), (8, 44)]
    n = spark.createDataFrame(rows, "cell_id long, next_id long")
    got = values(graph.downstream(n, n.where("cell_id in (1, 3, 6, 8)")), "seed", "step")
    assert got == [(1, 1, 0), (1, 2, 1), (1, 3, 2), (1, 4, 3), (3, 3, 0), (3, 4, 1), (3, 2, 2), (6, 6, 0), (6, 7, 1), (8, 8, 0)]
    assert values(graph.downstream(n, n.where("cell_id = 1"), max_steps=2), "step") == [(1, 1, 0), (1, 2, 1), (1, 3, 2)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(300, 301), (301, 300), (400, 1), (400, 2)], "from_code int, to_code int")
    starts = spark.createDataFrame([(0,), (199,), (200,), (300,), (400,), (201,)], "start int")
    assert values(graph.follow_chain(chain, starts, 200), "start") == [(0, True, 200), (199, True, 1), (200, True, 0), (201, False, None), (300, False, None), (400, False, None)]


def test_longest_chains(spark):
    n = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 1), (5, None)], "run int, parent int")
    assert values(graph.reduce_parents(n, "run", "parent"), "node") == [(1, 2), (2, 1), (3, 0), (4, 0), (5, 0)]


def test_components_against_union_find(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(0, k) for k in range(300, 400)] + [(500, 500)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    out = graph.connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert values(out, "node") == sorted((x, root(x)) for x in parent)


def test_matching_equals_greedy(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(25), draw.randrange(25), float(draw.randrange(8))) for _ in range(160)]
    best = {}
    for a, b, d in pairs:
        best[a, b] = min(d, best.get((a, b), d))
    left, right, want = set(), set(), []
    for d, a, b in sorted((d, a, b) for (a, b), d in best.items()):
        if a not in left and b not in right:
            left.add(a)
            right.add(b)
            want.append((a, b, d))
    out = joins.match_one_to_one(spark.createDataFrame(pairs, "a int, b int, d double"), "a", "b", "d")
    assert values(out, "a") == sorted(want)


def test_nearest_equals_brute_force(spark):
    draw = random.Random(7)
    left = [(i, draw.uniform(-500, 500), draw.uniform(-20, 20)) for i in range(40)]
    right = [(i, draw.uniform(-90, 90), draw.uniform(-20, 20)) for i in range(30)]
    want = [(i, min(right, key=lambda r: ((r[1] - x) ** 2 + (r[2] - y) ** 2, r[0]))[0]) for i, x, y in left]
    out = nearest.nearest(spark.createDataFrame(left, "l int, x double, y double"), spark.createDataFrame(right, "r int, x double, y double"), "l", "r", ["x", "y"])
    assert values(out.select("l", "r"), "l") == want


def test_linear_field_is_reproduced(spark):
    rows = grid.linear_weights(spark.range(0, 13).select(F.col("id").alias("r"), (F.col("id") * 0.25 + 0.5).alias("at")), "at", 0.0, 1.0, 5)
    cols = grid.linear_weights(spark.range(0, 8).select(F.col("id").alias("c"), (F.col("id") * 0.5).alias("at")), "at", 0.0, 1.0, 6)
    field = spark.range(0, 30).select(F.floor(F.col("id") / 6).alias("prow"), (F.col("id") % 6).alias("pcol")).withColumn("v", F.col("prow") * 2.0 + F.col("pcol") * 3.0)
    for r, c, v in values(grid.bilinear(rows, cols, field, "r", "c", "v"), "r", "c"):
        assert v == pytest.approx(2 * (r * 0.25 + 0.5) + 3 * c * 0.5, abs=1e-12)


def test_remap_conserves(spark):
    axis = lambda n, size: spark.range(0, n).select("id", (F.col("id") * size).alias("low"), ((F.col("id") + 1) * size).alias("high"))
    one = spark.range(0, 36).select(F.floor(F.col("id") / 6).alias("row"), (F.col("id") % 6).alias("col"), (F.col("id") * 1.0).alias("v"))
    out = grid.conservative_remap(one, grid.overlap_weights(axis(6, 10.0), axis(4, 15.0)), grid.overlap_weights(axis(6, 1.0), axis(3, 2.0)), "v")
    assert out.agg(F.avg("v")).first()[0] == pytest.approx(17.5)


def test_donors_equal_brute_force(spark):
    draw = random.Random(13)
    point = lambda: (draw.uniform(-80, 80), draw.uniform(-179, 179), draw.randint(0, 3))
    targets, donors = [(i, *point()) for i in range(60)], [(i, *point()) for i in range(25)]

    def km(a, b):
        la, lb, d = math.radians(a[1]), math.radians(b[1]), math.radians(a[2] - b[2])
        return 2 * 6371 * math.asin(math.sqrt(min(1, math.sin((la - lb) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(d / 2) ** 2)))

    want = []
    for t in targets:
        ladder = [[d for d in donors if km(t, d) <= 900], [d for d in donors if t[3] > 0 and d[3] == t[3]], [d for d in donors if abs(t[1] - d[1]) <= 3], donors]
        level = next(k for k, some in enumerate(ladder) if some)
        best = min(ladder[level], key=lambda d: (km(t, d), d[0]))
        want.append((t[0], best[0], pytest.approx(km(t, best), abs=1e-6), level + 2))
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} int, lat double, lon double, kind int")
    out = joins.choose_donors(frame(targets, "t"), frame(donors, "d"), "t", "d", "lat", "lon", "kind", 900.0, 3.0)
    assert values(out, "t") == want
    assert joins.choose_donors(frame(targets, "t"), frame([], "d"), "t", "d", "lat", "lon", "kind", 900.0, 3.0).count() == 0


def test_placement_equals_the_plain_loop(spark):
    draw = random.Random(17)
    items = [(i, draw.choice([None, *range(12)]), draw.sample(range(14), draw.randint(0, 3)) or None, draw.randint(0, 5), draw.random() < 0.3) for i in range(60)]
    taken, want = {}, {}
    for i, cell, others, _, future in sorted(items, key=lambda x: (x[3], x[0])):
        spot = next((c for c in [cell, *(others or [])] if c not in taken), None) if cell is not None else None
        if spot is not None:
            taken[spot] = i
        outcome = "placed" if spot is not None and spot == cell else "moved" if spot is not None else "not_placed" if future or cell is None else "merged"
        want[i] = (spot, outcome, taken[cell] if outcome == "merged" else None)
    df = spark.createDataFrame(items, "item int, cell long, others array<long>, rank int, future boolean")
    got = {r["item"]: (r.placed, r.outcome, r.merged_into) for r in placement.place_one_per_cell(df, "item", "cell", "others", ["rank"], "future").collect()}
    assert got == want and {o for _, o, _ in want.values()} == {"placed", "moved", "merged", "not_placed"}


def test_snapping_by_hand(spark):
    """A grid of two rows and four columns that wraps; the second cell of the first row is not active."""
    cells = [(0, 0, 0.0, 0.0, True, 100.0, 150.0), (0, 1, 0.0, 90.0, False, 100.0, 900.0), (0, 2, 0.0, 180.0, True, 100.0, 400.0), (0, 3, 0.0, 270.0, True, 100.0, 2000.0), (1, 0, 1.0, 0.0, True, 100.0, 800.0)]
    grid_ = spark.createDataFrame(cells, "row long, col long, lat double, lon double, active boolean, area double, upstream double")
    points = [("local", 0.1, 2.0, 60.0), ("fits", 0.0, 0.0, 160.0), ("neighbour", 0.2, 1.0, 790.0), ("back", 0.0, 0.0, 5000.0), ("wrapped", 0.0, 0.0, 2100.0), ("moved", 0.0, 100.0, 390.0), ("far", 40.0, 90.0, 500.0)]
    out = placement.snap(spark.createDataFrame(points, "item string, y double, x double, a double"), grid_, "item", "y", "x", "a", (0.0, 0.0), (1.0, 90.0), 4)
    got = {r["item"]: (r.row, r.col, r.kind, r.method) for r in out.collect()}
    assert got == {
        "local": (0, 0, "local", "nearest_local"), "fits": (0, 0, "global", "nearest_global"), "neighbour": (1, 0, "global", "nearest_global_neighbourhood"), "back": (0, 0, "global", "nearest_global_revert"),
        "wrapped": (0, 3, "global", "nearest_global_neighbourhood"), "moved": (0, 2, "global", "nearest_active_global"), "far": (None, None, None, "none"),
    }


def test_run_order_follows_the_rule(spark):
    rows = [("s1", None, 10, 2), ("s2", None, 10, 1), ("a", "s1", 50, 2), ("b", "s2", 40, 1), ("c", "a", 20, 2), ("d", "a", 20, 2), ("e", "b", 5, 1)]
    runs = spark.createDataFrame(rows, "run string, parent string, years int, priority int")
    assert values(campaign.years_left(runs, "run", "parent", "years"), "run") == [("a", 70.0), ("b", 45.0), ("c", 20.0), ("d", 20.0), ("e", 5.0), ("s1", 80.0), ("s2", 55.0)]
    assert [(r.run, r.on_longest) for r in campaign.run_order(runs, "run", "parent", "years", "priority").orderBy("position").collect()] == [("s1", True), ("a", True), ("c", True), ("s2", False), ("b", False), ("e", False), ("d", False)]
    with pytest.raises(ValueError):
        campaign.run_order(spark.createDataFrame([("p", None, 1, 5), ("q", None, 9, 4), ("r", "p", 1, 1)], "run string, parent string, years int, priority int"), "run", "parent", "years", "priority")


def test_stages_of_a_crosswalk(spark):
    from fluvion.plans.gauges import staged

    draw = random.Random(3)
    one = [(i, draw.uniform(0, 900), draw.uniform(0, 900), i % 7) for i in range(40)]
    two = [(i, draw.uniform(0, 900), draw.uniform(0, 900), i % 11 + 4) for i in range(120)]
    far = lambda a, b: math.hypot(a[1] - b[1], a[2] - b[2])
    left, right, want = {a[0]: a for a in one}, {b[0]: b for b in two}, []
    for name, pairs in (
        ("given", lambda a, b: 0.0 if a[0] % 10 == 0 and a[0] * 10 == b[0] else None), ("code", lambda a, b: far(a, b) if a[3] == b[3] else None), ("place", lambda a, b: far(a, b) if far(a, b) <= 120 else None),
    ):
        for d, i, j in sorted((pairs(a, b), a[0], b[0]) for a in left.values() for b in right.values() if pairs(a, b) is not None):
            if i in left and j in right:
                want.append((i, j, name))
                del left[i], right[j]
    s = spark.createDataFrame(one, "s_suppkey long, x double, y double, code int")
    c = spark.createDataFrame(two, "c_custkey long, x double, y double, code int")
    assert values(staged(s, c).select("s_suppkey", "c_custkey", "stage"), "s_suppkey") == sorted(want)
    assert {n for _, _, n in want} == {"given", "code", "place"}


def test_status_and_ledger(spark):
    s = spark.createDataFrame([("a", "passed"), ("a", "missing"), ("a", "warning"), ("b", None), ("c", "failed")], "k string, s string")
    assert values(records.combine_status(s, ["k"], "s"), "k") == [("a", "not_checked"), ("b", "passed"), ("c", "failed")]
    with pytest.raises(Exception, match="unknown verdict"):
        records.combine_status(spark.createDataFrame([("a", "odd")], "k string, s string"), ["k"], "s").collect()


def test_years(spark):
    out = spark.createDataFrame([(0.0004,), (17.9998,), (95.0,)], "o double").select(physics.years_since_1901(F.col("o")))
    assert [r[0] for r in out.collect()] == [1901, 1919, 1996]
    names = spark.createDataFrame([("a_1999.nc", "1901-1903, 1910,x"), ("b.nc", "")], "n string, l string")
    assert [tuple(r) for r in names.select(rules.year_of_name(F.col("n")), rules.years_of_list(F.col("l"))).collect()] == [(1999, [1901, 1902, 1903, 1910]), (None, [])]


def test_rules(spark):
    df = spark.createDataFrame([(" Große-Dam  No.1 ", 1536), (None, 3)], "n string, s long")
    got = [tuple(r) for r in df.select(rules.normal_name(F.col("n")), rules.human_size(F.col("s")), rules.any_glob(F.coalesce("n", F.lit("x.tmp")), ["*.tmp"])).collect()]
    assert got == [("gro e dam no 1", "1.5 KiB", False), ("", "3.0 B", True)]


def test_binary_readers(spark, tmp_path):
    fields = b"".join(n.encode().ljust(11, b"\0") + b"C\0\0\0\0" + bytes([w]) + b"\0" * 15 for n, w in (("NAME", 6), ("CAP", 4)))
    body = b" dam A 12.5" + b"*gone  -99 " + " Bé     -99".encode("latin-1")
    (tmp_path / "a.dbf").write_bytes(struct.pack("<B3xIHH20x", 3, 3, 32 + len(fields) + 1, 11) + fields + b"\r" + body)
    got = [r.fields for r in binary.read_dbf(spark, str(tmp_path)).orderBy("record").collect()]
    assert got == [{"NAME": "dam A", "CAP": "12.5"}, {"NAME": "Bé", "CAP": "-99"}]
    points = b"".join(struct.pack(">II", i + 1, 10) + struct.pack("<idd", 1, x, y) for i, (x, y) in enumerate([(1.5, -2.0), (3.0, 4.0)]))
    (tmp_path / "a.shp").write_bytes(b"\0" * 100 + points)
    assert values(binary.read_points(spark, str(tmp_path)).select("x", "y"), "x") == [(1.5, -2.0), (3.0, 4.0)]
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>YEAR</t></si><si><t>CAP_MCM</t></si></sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>title</t></is></c></row><row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c></row><row r="3"><c r="A3"><v>1990</v></c><c r="B3"><v>7.5</v></c></row></sheetData></worksheet>')
    assert [r.fields for r in binary.read_xlsx(spark, str(tmp_path), ("YEAR", "CAP_MCM")).collect()] == [{"YEAR": "1990", "CAP_MCM": "7.5"}]


def test_text_readers(spark, tmp_path):
    (tmp_path / "g.txt").write_text("# GRDC-No.: 42\n# Latitude (DD): 50.5\n# Longitude (DD): 7\n# Catchment area (km2): 100\nYYYY-MM-DD;hh:mm;Value\n2001-01-01;--:--;5.5\n2001-01-02;--:--;-999.0\n", encoding="latin-1")
    stations, days = text.read_gauges(spark, str(tmp_path / "g.txt"))
    assert stations.drop("path").first() == ("42", 50.5, 7.0, 100.0)
    assert [(str(r.day), r.q) for r in days.orderBy("day").collect()] == [("2001-01-01", 5.5), ("2001-01-02", None)]
    (tmp_path / "l.tsv").write_text("f\t10\t1.5\ta/b\t\nl\t3\t1.0\ta/c\ta/b\nl\t3\t1.0\ta/d\tnowhere\nbad line\n")
    assert values(text.real_sizes(text.read_listing(spark, str(tmp_path / "l.tsv"))).select("name", "size"), "name") == [("a/b", 10), ("a/c", 10), ("a/d", None)]
    text.write_new(spark.range(3), str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exists"):
        text.write_new(spark.range(3), str(tmp_path / "out"))
