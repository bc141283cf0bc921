"""Nearest neighbours and polygons against brute force, with crowds, ties, bounds and odd rows."""

import math
import random

import pytest

from fluvion.operators import joins, nearest, polygons


def brute(left, right, dims, most=math.inf, equal=False, band=None):
    out = []
    for lid, *a in left:
        best = None
        for rid, *b in right:
            if equal and a[-1] != b[-1] or None in a[:dims] or None in b[:dims]:
                continue
            if band is not None and abs(a[dims] - b[dims]) > band + 1e-9:
                continue
            d = math.sqrt(sum((p - q) * (p - q) for p, q in zip(a[:dims], b[:dims], strict=True)))
            if d <= most and (best is None or (d, rid) < best[:2]):
                best = (d, rid)
        if best:
            out.append((lid, best[1], round(best[0], 9)))
    return sorted(out)


def answers(df):
    return sorted((r[0], r[1], round(r[2], 9)) for r in df.collect())


def clustered(rnd, n, dims, far=1000.0):
    """A third on one spot, a third in a tiny cluster, the rest anywhere."""
    rows = []
    for i in range(n):
        kind = i % 3
        rows.append((i, *[50.0 if kind == 0 else 50 + rnd.gauss(0, 1e-3) if kind == 1 else rnd.uniform(-far, far) for _ in range(dims)], i % 4))
    return rows


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_nearest_of_crowds_and_of_far_points(spark, dims):
    rnd = random.Random(dims)
    schema = "i long, " + ", ".join(f"x{k} double" for k in range(dims)) + ", kind int"
    left, right = clustered(rnd, 240, dims) + [(999, *[None] * dims, 0)], clustered(rnd, 300, dims, 50)
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema).withColumnRenamed("i", "j")
    axes = [f"x{k}" for k in range(dims)]
    assert answers(nearest.nearest(a, b, "i", "j", axes)) == brute(left, right, dims)
    assert answers(nearest.nearest(a, b, "i", "j", axes, 30.0)) == brute(left, right, dims, 30.0)
    assert answers(nearest.nearest(a, b, "i", "j", axes, equal=["kind"])) == brute(left, right, dims, equal=True)


def test_nearest_within_a_band(spark):
    rnd = random.Random(8)
    left = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100), rnd.uniform(-5, 5)) for i in range(80)]
    right = [(i, rnd.uniform(0, 100), rnd.uniform(40, 60), rnd.uniform(-5, 5)) for i in range(60)]
    a, b = spark.createDataFrame(left, "i int, x double, y double, z double"), spark.createDataFrame(right, "j int, x double, y double, z double")
    assert answers(nearest.nearest(a, b, "i", "j", ["x", "y"], band=("z", 0.4))) == brute(left, right, 2, band=0.4)


def test_nearest_without_rows(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "i int, x double"), spark.createDataFrame([(1, 2.0)], "j int, x double")
    assert nearest.nearest(a, b.limit(0), "i", "j", ["x"]).collect() == []
    assert nearest.nearest(a.limit(0), b, "i", "j", ["x"]).collect() == []
    assert answers(nearest.nearest(a, b, "i", "j", ["x"])) == [(1, 1, 0.0)]


def test_donor_ladder_equals_brute_force(spark):
    rnd = random.Random(3)
    point = lambda i: (i, rnd.uniform(-80, 80), rnd.choice([-179.9, 179.9, rnd.uniform(-180, 180)]), rnd.randint(0, 3))
    targets, donors = [point(i) for i in range(60)], [point(i) for i in range(25)]
    out = joins.choose_donors(spark.createDataFrame(targets, "t int, lat double, lon double, kind int"), spark.createDataFrame(donors, "d int, lat double, lon double, kind int"), "t", "d", "lat", "lon", "kind", 900.0, 3.0)

    def km(a, b):
        p, q = math.radians(a[1]), math.radians(b[1])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371 * math.asin(min(1, math.sqrt(h)))

    want = []
    for t in targets:
        for level, ok in ((2, lambda d: km(t, d) <= 900), (3, lambda d: t[3] > 0 and t[3] == d[3]), (4, lambda d: abs(t[1] - d[1]) <= 3), (5, lambda d: True)):
            fits = [(km(t, d), d[0]) for d in donors if ok(d)]
            if fits:
                want.append((t[0], min(fits)[1], level, round(min(fits)[0], 4)))
                break
    assert sorted((r.t, r.d, r.level, round(r.km, 4)) for r in out.collect()) == sorted(want)


def ring(points):
    return list(zip(points, points[1:] + points[:1]))


def star(rnd, cx, cy, n, r):
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + rnd.uniform(0.2, 1) * r * math.cos(a), cy + rnd.uniform(0.2, 1) * r * math.sin(a)) for a in angles]


def by_ray(x, y, edges):
    odd = False
    for (x1, y1), (x2, y2) in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def apart(x, y, edge):
    (x1, y1), (x2, y2) = edge
    dx, dy = x2 - x1, y2 - y1
    s = max(0, min(1, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
    return math.hypot(x1 + s * dx - x, y1 + s * dy - y)


@pytest.mark.parametrize("size", [0.7, 5.0, 400.0])
def test_polygons_hold_or_are_nearest(spark, size):
    rnd = random.Random(4)
    shapes = {k: ring(star(rnd, rnd.uniform(-60, 60), rnd.uniform(-40, 40), rnd.randint(3, 25), rnd.choice([2, 15, 40]))) for k in range(12)}
    # A square with round corners of the grid, and an island within a hole.
    shapes[20] = ring([(70.0, 70.0), (80.0, 70.0), (80.0, 80.0), (70.0, 80.0)]) + ring([(72.0, 72.0), (78.0, 72.0), (78.0, 78.0), (72.0, 78.0)])
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-60, 90)) for i in range(150)] + [(500 + i, 75.1, 71.3) for i in range(200)] + [(900, 3000.0, -2500.0), (901, None, 1.0), (902, 75.0, 75.0), (902, 75.0, 75.0)]
    edges = spark.createDataFrame([(k, *a, *b) for k, e in shapes.items() for a, b in e], "poly int, x1 double, y1 double, x2 double, y2 double")
    df = spark.createDataFrame(points, "p int, x double, y double")
    held = {(p, k) for p, x, y in points if x is not None for k, e in shapes.items() if by_ray(x, y, e)}
    assert {tuple(r) for r in polygons.in_polygons(df, edges, "p", "poly", "x", "y", size).collect()} == held
    want = {}
    for p, x, y in points:
        inside = [k for q, k in held if q == p]
        want[p] = (None, None) if x is None else (min(inside), 0.0) if inside else min((round(min(apart(x, y, e) for e in edges), 9), k) for k, edges in shapes.items())[::-1]
    got = {r.p: (r.poly, r.distance if r.distance is None else round(r.distance, 9)) for r in polygons.polygon_or_nearest(df, edges, "p", "poly", "x", "y", size).collect()}
    assert got == want


def test_no_polygons_and_no_points(spark):
    edges = spark.createDataFrame([], "poly int, x1 double, y1 double, x2 double, y2 double")
    df = spark.createDataFrame([(1, 0.0, 0.0)], "p int, x double, y double")
    assert [tuple(r) for r in polygons.polygon_or_nearest(df, edges, "p", "poly", "x", "y", 1.0).collect()] == [(1, None, None)]
    assert polygons.polygon_or_nearest(df.limit(0), edges, "p", "poly", "x", "y", 1.0).collect() == []


def test_a_long_chain_of_better_neighbours_is_matched(spark):
    chain = [(k // 2 + k % 2, k // 2, float(k)) for k in range(1000)]
    out = joins.match_one_to_one(spark.createDataFrame(chain, "a int, b int, d double"), "a", "b", "d", max_rounds=3)
    assert sorted((r.a, r.b, r.d) for r in out.collect()) == sorted(chain[::2])


@pytest.mark.parametrize("seed", range(3))
def test_matching_equals_the_greedy_loop(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randint(0, 25), rnd.randint(0, 25), float(rnd.randint(0, 6))) for _ in range(250)]
    want, left, right = [], set(), set()
    for d, a, b in sorted((d, a, b) for a, b, d in pairs):
        if a not in left and b not in right:
            want.append((a, b, d))
            left.add(a)
            right.add(b)
    out = joins.match_one_to_one(spark.createDataFrame(pairs, "a int, b int, d double"), "a", "b", "d")
    assert sorted(map(tuple, out.select("a", "b", "d").collect())) == sorted(want)


def test_crowded_cubes_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(joins, "PAIRS", 60)
    rnd = random.Random(8)
    spot = lambda: (rnd.choice([5.0, rnd.uniform(0, 60)]), rnd.choice([5.0, rnd.uniform(-20, 20)]))
    left, right = [(i, *spot()) for i in range(60)], [(i, *spot()) for i in range(90)]
    df = lambda rows, name: spark.createDataFrame(rows, f"{name} int, x double, y double")
    pairs = joins.within_distance(df(left, "l"), df(right, "r"), "l", "r", ["x", "y"], 7.0, also=lambda a, b: a[0] <= b[0])
    assert pairs.rdd.getNumPartitions() >= 10
    assert {(p.l, p.r) for p in pairs.collect()} == {(i, j) for i, x, y in left for j, u, v in right if math.hypot(x - u, y - v) <= 7 and x <= u}


@pytest.mark.parametrize("radius", [6.0, None])
def test_matching_by_lists_equals_the_greedy_loop(spark, radius):
    rnd = random.Random(5)
    spot = lambda: (rnd.choice([3.0, 3.25, rnd.uniform(0, 4), rnd.uniform(0, 40)]), float(rnd.randrange(4)))
    left, right = [(i, *spot(), rnd.randrange(2)) for i in range(70)], [(i, *spot(), rnd.randrange(2)) for i in range(60)]
    left.append((99, None, 1.0, 0))
    equal = None if radius else ["k"]
    want, pairs = {}, []
    for i, x, y, k in left:
        for j, u, v, m in right:
            if x is not None and (radius is None or math.sqrt((x - u) * (x - u) + (y - v) * (y - v)) <= radius) and (equal is None or k == m):
                pairs.append((math.sqrt((x - u) * (x - u) + (y - v) * (y - v)), i, j))
    for _, i, j in sorted(pairs):
        if i not in want and j not in want.values():
            want[i] = j
    df = lambda rows, name: spark.createDataFrame(rows, f"{name} int, x double, y double, k int")
    got = joins.match_nearest(df(left, "l"), df(right, "r"), "l", "r", ["x", "y"], radius, equal)
    assert {r.l: r.r for r in got.collect()} == want
