"""Names, register sources, concurrent extensions, loops, time axes and pruned reads."""

import random
import struct
import threading
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

from fluvion import session
from fluvion.functions import physics
from fluvion.operators import graph, names, placement, verifiers
from fluvion.plans import reports
from fluvion.sources import commits, registers


@pytest.mark.parametrize("least", [0.7, 0.8, 0.95])
def test_similar_names_equal_all_pairs(spark, least):
    rnd = random.Random(int(100 * least))
    words = ["lake", "upper", "lower", "san", "río", "nova", "dam", "st", "x", "grande", "aaaa"]

    def name():
        text = " ".join(rnd.choices(words, k=rnd.randint(1, 4)))
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(text) + 1)
            text = text[:k] + rnd.choice(["", "a", "e", "zz"]) + text[k + rnd.randint(0, 1) :]
        return text

    short = ["a", "b", "ab", "ba", "axb", "abc", "abcd", "abxd", "", None]
    left = [(i, name()) for i in range(60)] + [(100 + i, s) for i, s in enumerate(short)]
    right = [(i, name()) for i in range(90)] + [(200 + i, s) for i, s in enumerate(short)] + [(300 + i, "upper lake") for i in range(6)]
    got = names.similar_names(spark.createDataFrame(left, "l int, name string"), spark.createDataFrame(right, "r int, name string"), "l", "r", "name", least)
    want = []
    for i, a in left:
        scored = sorted((-SequenceMatcher(None, a, b).ratio(), j) for j, b in right if a and b)
        want += [(i, j, -s, k) for k, (s, j) in enumerate([x for x in scored if -x[0] >= least - 1e-12][:3], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_ratio_without_a_bound_is_refused(spark):
    df = spark.createDataFrame([(1, "a")], "l int, name string")
    with pytest.raises(ValueError):
        names.similar_pairs(df, df, "name", 0.6)


def dbf_file(path, rows):
    fields = [("NAME", "C", 10), ("CAP", "N", 8), ("ID", "N", 6)]
    head = struct.pack("<BBBBIHH20x", 3, 24, 1, 1, len(rows), 32 + 32 * len(fields) + 1, 1 + sum(f[2] for f in fields))
    head += b"".join(n.encode().ljust(11, b"\0") + t.encode() + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, t, w in fields) + b"\r"
    body = b"".join((b"*" if gone else b" ") + name.encode("latin-1").ljust(10)[:10] + cap.encode().rjust(8) + str(i).encode().rjust(6) for i, (name, cap, gone) in enumerate(rows))
    path.write_bytes(head + body + b"\x1a")


def test_dbf_is_read_by_ranges_of_records(spark, tmp_path):
    rows = [(f"Dam é{i}"[:10], "" if i % 7 == 0 else f"{i}.5", i % 10 == 3) for i in range(1000)]
    dbf_file(tmp_path / "one.dbf", rows)
    dbf_file(tmp_path / "two.dbf", rows[:10])
    registers.register(spark)
    df = spark.read.format("dbf").option("records", 100).load(f"{tmp_path}/*.dbf")
    assert df.rdd.getNumPartitions() == 11
    assert df.dtypes == [("NAME", "string"), ("CAP", "double"), ("ID", "double")]
    want = sorted((n, None if c == "" else float(c), float(i)) for some in (rows, rows[:10]) for i, (n, c, gone) in enumerate(some) if not gone)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    typed = spark.read.format("dbf").schema("ID long, LACKS string").load(f"{tmp_path}/two.dbf")
    assert sorted(map(tuple, typed.collect())) == [(i, None) for i in range(10) if i != 3]


def shp_file(path, points):
    records = b""
    for i, p in enumerate(points, 1):
        body = struct.pack("<i", 0) if p is None else struct.pack("<idd", 1, *p)
        records += struct.pack(">ii", i, len(body) // 2) + body
    path.write_bytes(struct.pack(">i20xi", 9994, (100 + len(records)) // 2) + struct.pack("<ii64x", 1000, 1) + records)


def test_points_are_read_by_ranges_unless_null_shapes_lie_between(spark, tmp_path):
    registers.register(spark)
    points = [(i * 0.5, -i * 0.25) for i in range(500)]
    shp_file(tmp_path / "even.shp", points)
    shp_file(tmp_path / "odd.shp", [None, *points, None])
    even = spark.read.format("points").option("records", 60).load(f"{tmp_path}/even.shp")
    assert even.rdd.getNumPartitions() == 9
    assert sorted((r.record, r.x, r.y) for r in even.collect()) == [(i, *p) for i, p in enumerate(points)]
    odd = spark.read.format("points").option("records", 60).load(f"{tmp_path}/odd.shp")
    assert odd.rdd.getNumPartitions() == 1
    assert sorted((r.record, r.x, r.y) for r in odd.collect()) == [(0, None, None), *[(i + 1, *p) for i, p in enumerate(points)], (501, None, None)]
    with pytest.raises(Exception, match="missing"):
        spark.read.format("points").load(f"{tmp_path}/missing.shp").collect()


def test_one_of_many_writers_puts_a_file(spark, tmp_path):
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(k) if commits.put_if_absent(spark, f"file://{tmp_path}/a/record", f"writer {k}") else None) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and commits.get(spark, f"file://{tmp_path}/a/record") == f"writer {won[0]}"
    assert commits.get(spark, f"file://{tmp_path}/a/none") is None
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.endswith(".part")]


def test_extensions_at_once_lose_nothing(spark, tmp_path):
    product = commits.Extended(spark, f"file://{tmp_path}/unit", ["year"])
    product.extend(spark.createDataFrame([(2000, 1.0)], "year int, v double"))
    failed = []

    def add(year):
        try:
            commits.Extended(spark, f"file://{tmp_path}/unit", ["year"]).extend(spark.createDataFrame([(year, float(year))], "year int, v double"), {"by": year})
        except commits.Conflict:
            failed.append(year)

    threads = [threading.Thread(target=add, args=(y,)) for y in (2001, 2002, 2003, 2001)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert failed == [2001]
    assert sorted(r.year for r in product.read().collect()) == [2000, 2001, 2002, 2003]
    number, held = product.latest()
    assert number == 4 and len(held["parts"]) == 4
    assert sorted(r.year for r in product.read(1).collect()) == [2000]
    with pytest.raises(FileNotFoundError):
        commits.Extended(spark, f"file://{tmp_path}/none", ["year"]).read()


def test_a_cached_table_has_one_version(spark):
    made = []
    make = lambda k: lambda: (made.append(k), spark.range(k))[1]
    key = f"test {random.random()}"
    assert [session.cached(spark, key, make(k)).count() for k in (3, 5)] == [3, 3] and made == [3]


def test_loops_of_any_length(spark):
    pointers = {1: 1, 2: 3, 3: 2, 4: 2, 5: 6, 6: 7, 7: 8, 8: 9, 9: 5, 10: 4, 11: None, 12: 999, 13: 12, 30: 22, 22: 25, 25: 30}
    out = graph.loops(spark.createDataFrame(list(pointers.items()), "cell_id int, next_id int"))
    assert sorted(map(tuple, out.collect())) == [(2, 2, 0), (2, 3, 1), *[(5, 5 + k, k) for k in range(5)], (22, 22, 0), (22, 25, 1), (22, 30, 2)]
    big = spark.range(1000).select(F.col("id").alias("cell_id"), ((F.col("id") + 1) % 1000).alias("next_id"))
    assert {(r.loop, r.place == r.node) for r in graph.loops(big).collect()} == {(0, True)}
    assert graph.loops(big.where("cell_id > 0")).collect() == []


def test_smallest_label_upstream(spark):
    pointers = [(1, 2), (2, 3), (3, None), (4, 2), (5, 6), (6, 5), (7, 8)]
    out = graph.downstream_labels(spark.createDataFrame(pointers, "cell_id int, next_id int"), spark.createDataFrame([(1, 9), (4, 3), (5, 7)], "cell_id int, tag int"), "tag")
    assert sorted(map(tuple, out.collect())) == [(1, 9), (2, 3), (3, 3), (4, 3), (5, 7), (6, 7)]


def test_axes_name_the_days_that_lack(spark):
    rows = [(k, 2000, d, c) for k, c, n in ((0, "365_day", 365), (1, "360_day", 360), (2, "proleptic_gregorian", 366)) for d in range(1, n + 1) if (k, d) not in ((0, 1), (0, 60), (0, 61), (0, 365), (2, 366))] + [(1, 2000, 5, "360_day"), (1, 2000, 361, "360_day")]
    out = {r.k: r for r in verifiers.year_axes(spark.createDataFrame(rows, "k int, year int, day int, calendar string"), ["k"], "year", "day", "calendar").collect()}
    assert (out[0].missing, out[0].n_days, out[0].complete) == ([1, 60, 61, 365], 365, False)
    assert (out[1].missing, out[1].repeated, out[1].outside, out[1].complete) == ([], 1, 1, False)
    assert (out[2].missing, out[2].n_days) == ([366], 366)
    days = spark.createDataFrame([(1900,), (2000,), (2004,), (2023,)], "y int")
    assert [r[0] for r in days.select(verifiers.days_in_year(F.col("y"), "proleptic_gregorian")).collect()] == [365, 366, 366, 365]


def test_only_wanted_years_are_read(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 5).alias("run"), (1990 + F.col("id") % 20).alias("year"), "id")
    verifiers.write_by_year(df, f"{tmp_path}/runs", "run", "year")
    wanted = spark.createDataFrame([(1, 1991), (1, 1996), (3, 2008)], "run int, year int").where("year > 1990")
    out = verifiers.read_years(spark, f"{tmp_path}/runs", wanted, "run", "year")
    assert sorted(r.id for r in out.select("id").collect()) == sorted(r.id for r in df.where("(run = 1 and year in (1991, 1996)) or (run = 3 and year = 2008)").collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_ellipsoid_areas_sum_to_the_ellipsoid(spark):
    rows = spark.range(360).select(physics.ellipsoid_cell_area(-89.75 + F.col("id") * 0.5, 0.5, 720).alias("a"))
    assert 720 * rows.agg(F.sum("a")).first()[0] == pytest.approx(510065621724088.44, rel=1e-9)
    ball = spark.range(1).select(physics.ellipsoid_cell_area(F.lit(30.0), 1.0, 360, 6371000.0, 1e-9), physics.sphere_cell_area(F.lit(30.0), 1.0, 360)).first()
    assert ball[0] == pytest.approx(ball[1], rel=1e-6)


def test_only_the_settled_table_is_left(spark):
    paths = []

    def make():
        inner = session.settled(spark, lambda: session.materialise(spark.range(10), "deep"), "inner")
        paths.append(session.own_dir(spark))
        return session.materialise(inner.where("id > 2"), "way")

    out = session.settled(spark, make, "result")
    files = spark._jvm.org.apache.hadoop.fs.Path(paths[0])
    assert out.count() == 7 and not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
    with pytest.raises(ZeroDivisionError):
        session.settled(spark, lambda: 1 // 0, "fails")
    assert session.own_dir(spark) != paths[0] and paths[0].startswith(session.own_dir(spark))


def test_only_the_sample_meets_its_sources(spark):
    # Cell 9 is not in the sample: adding up its weights would overflow.
    unit = spark.createDataFrame([("u", 101, 1, 5.0), ("u", 101, 1, 7.0), ("u", 102, 2, 4.0), ("u", 103, 1, 1.0)], "unit string, time int, cell int, v double")
    source = spark.createDataFrame([("u", t, c, float(10 * c + t - 100)) for t in (101, 102) for c in (1, 2)], "unit string, time int, coarse int, v double")
    weights = spark.createDataFrame([(1, 1, 3), (1, 2, 1), (2, 2, 1), (9, 1, 1 << 62), (9, 2, 1 << 62)], "cell int, coarse int, weight long")
    row = verifiers.recomputed(unit, source, weights, ["unit"], "time", "cell", "coarse", "v", "weight", 20.0).first()
    # Recomputed: 13.5 for both values of cell 1 on day 101, 22 for cell 2, none for day 103.
    assert (row.n, row.n_missing, row.worst, row.status) == (4, 1, 18.0, "failed")


def test_service_ends_at_a_cell_without_flow(spark):
    rows = [(1, 2, 4.0, True), (2, 3, 8.0, True), (3, 4, 0.0, True), (4, None, 16.0, True), (5, 4, None, True)]
    n = spark.createDataFrame(rows, "cell_id int, next_id int, flow double, active boolean")
    got = {(r.seed, r.node, r.step, r.fraction) for r in placement.trace_service(n, n, "flow", "active", 0.2, 4).collect()}
    assert got == {(1, 1, 0, 1.0), (1, 2, 1, 0.5), (2, 2, 0, 1.0), (3, 3, 0, 1.0), (4, 4, 0, 1.0), (5, 5, 0, 1.0)}


def test_soils_on_the_edge_of_a_rule_equal_sql(spark, tmp_path):
    rows = [(k, s, 900 + (k % 1000) / 10) for k in range(0, 63000, 5) for s in (8,)]
    spark.createDataFrame(rows, "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = {(r.layer, r["rule"], r.n) for r in reports.soil_problems(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')").fetchall()
    assert got == set(con.execute(reports.ORACLES["soil_problems"]).fetchall())


def test_rounds_send_no_table_to_the_driver(spark):
    n = spark.range(300).select(F.col("id").alias("cell_id"), ((F.col("id") + 1) % 300).alias("next_id"), (F.col("id") % 20).alias("col"), F.floor(F.col("id") / 20).alias("row"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.lit(True).alias("active"))
    plans = [session.spread(n).join(session.spread(n.select("cell_id")), "cell_id"), verifiers.network_checks(n.select("cell_id", "next_id"), n, 20), graph.loops(n.select("cell_id", "next_id")).join(session.spread(n), F.col("node") == F.col("cell_id"))]
    for df in plans:
        df.collect()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
