"""Hand-computed cases of catalogues, series and checks."""

import random

import pytest
from pyspark.sql import functions as F
from test_operators import values

from fluvion import session
from fluvion.functions import rules
from fluvion.operators import aggregates, catalog, checks, grid, placement, series
from fluvion.sources import text


def test_files_of_years(spark):
    files = spark.createDataFrame([("x_tas_1901_1903.nc",), ("y_tas_1903_1904.nc",), ("tas.nc",), ("x_pr_1901_1901.nc",), ("x_pr_1901_1901.txt",)], "f string")
    wanted = spark.createDataFrame([("tas", 1902), ("tas", 1903), ("tas", 1910), ("pr", 1901)], "v string, y int")
    assert values(catalog.file_of_year(files, "f", wanted, "v", "y"), "v", "y") == [("pr", 1901, 1, "x_pr_1901_1901.nc"), ("tas", 1902, 1, "x_tas_1901_1903.nc"), ("tas", 1903, 2, None), ("tas", 1910, 0, None)]


def test_bindings_count_only_for_the_same_data_and_verifier(spark):
    now = spark.createDataFrame([("a", "d1", "v1"), ("b", "d1", "v1"), ("c", "d1", "v1"), ("d", None, "v1")], "k string, data string, verifier string")
    reports = spark.createDataFrame([("a", "d1", "v1", "passed"), ("b", "d0", "v1", "passed"), ("c", "d1", "v1", "failed"), ("c", "d0", "v1", "passed"), ("d", None, "v1", "warning")], "k string, data string, verifier string, s string")
    assert values(catalog.report_counts(reports, now, "k", ["data", "verifier"], "s"), "k") == [("a", "passed"), ("b", "not_checked"), ("c", "failed"), ("d", "warning")]


def test_ids_that_occur_twice_are_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (9,)], "w long")
    ids = spark.createDataFrame([(1, 10), (2, 20)], "id long, i long")
    assert values(catalog.resolve_ids(df, "w", ids, "id", "i"), "w") == [(1, 10), (2, 20), (9, -1)]
    with pytest.raises(Exception, match="occurs twice"):
        catalog.resolve_ids(df, "w", ids.union(ids), "id", "i").collect()


def test_blocks_begin_half_off_in_the_west(spark):
    df = spark.createDataFrame([(-180.0,), (-179.5,), (-179.0,), (-1.5,), (-1.0,), (-0.01,), (0.0,), (1.99,), (2.0,), (179.9,)], "x double")
    assert [r[0] for r in df.select(catalog.longitude_block(F.col("x"), 2.0)).collect()] == [0, 0, 1, 89, 90, 90, 91, 91, 92, 180]
    with pytest.raises(Exception, match="outside"):
        spark.createDataFrame([(180.0,)], "x double").select(catalog.longitude_block(F.col("x"), 2.0)).collect()


def test_points_in_a_star(spark):
    ring = [(0, 0), (10, 0), (10, 10), (5, 3), (0, 10)]
    edges = [("s", *map(float, (*a, *b))) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    points = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 5.0), (3, 9.0, 8.0), (4, -1.0, 1.0), (5, 1.0, 7.5), (6, 20.0, 3.0)], "p int, x double, y double")
    for band in (0.7, 100.0):
        got = values(catalog.in_polygons(points, spark.createDataFrame(edges, "poly string, x1 double, y1 double, x2 double, y2 double"), "p", "poly", "x", "y", band), "p")
        assert got == [(1, "s"), (3, "s"), (5, "s")]


def test_verdicts_of_several_checks(spark):
    one = spark.createDataFrame([("a", "passed"), ("b", "failed"), ("c", "passed")], "k string, status string")
    two = spark.createDataFrame([("a", "passed"), ("b", "warning")], "k string, status string")
    assert values(catalog.combined_checks({"one": one, "two": two}, "k"), "k") == [("a", "passed", ""), ("b", "failed", "one,two"), ("c", "not_checked", "two")]


def test_percentiles_between_ranks(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 2, 2, 10)] + [("b", 7.0), ("c", None)], "k string, v double")
    assert values(aggregates.exact_percentiles(df, ["k"], "v", {"low": 0.1, "mid": 0.5, "high": 0.9}), "k") == [("a", pytest.approx(1.4), 2.0, pytest.approx(6.8)), ("b", 7.0, 7.0, 7.0)]


def test_closure_needs_the_year_before(spark):
    b = spark.createDataFrame([(2001, 10.0, 3.0, 5.0), (2002, 12.0, 4.0, 6.5), (2004, 1.0, None, 2.0), (2005, 9.0, 1.0, 2.5)], "y int, p double, et double, store double")
    got = values(checks.closure(b.withColumn("u", F.lit(1)), ["u"], "y", "p", ["et"], "store").select("y", "storage_change", "residual"), "y")
    assert got == [(2001, None, None), (2002, 1.5, 6.5), (2004, None, None), (2005, 0.5, 7.5)]


def test_annual_means_weigh_months_by_length(spark):
    m = spark.createDataFrame([(y, k, 1.0 if k == 2 else 2.0) for y in (2000, 2001) for k in range(1, 13) if (y, k) != (2001, 7)], "y int, m int, v double").withColumn("u", F.lit(1))
    got = values(checks.annual_means(m, ["u"], "y", "m", "v"), "y")
    assert got == [(1, 2000, 12, pytest.approx(2 - 29 / 366), 1.0, 2.0), (1, 2001, 11, None, None, 2.0)]


def test_series_and_histograms(spark):
    s = spark.createDataFrame([("a", 1, 5.0, 5.0), ("a", 2, 5.0, 5.0), ("b", 1, 0.0, 0.0), ("b", 2, 3.0, None), ("b", 3, 4.0, 4.5)], "k string, t int, x double, y double")
    assert values(series.series_facts(s, ["k"], "t", "x", "y"), "k") == [("a", True, True, None, 2), ("b", False, False, 2, 2)]
    h = spark.createDataFrame([(-5.0,), (0.5,), (3.2,), (99.0,), (None,)], "v double")
    assert values(series.full_histogram(h, F.col("v"), 0.0, 1.0, 5), "bin") == [(0, 0.0, 2), (1, 1.0, 0), (2, 2.0, 0), (3, 3.0, 1), (4, 4.0, 1)]


def test_runs_chunks_and_choices(spark):
    df = spark.createDataFrame([(2001, 2012, "Yes", 100.0, 50.0, 10.0, 30.0), (2005, 2001, None, 400.0, 90.0, 10.0, 30.0), (2001, 2010, "no", 5.0, 90.0, None, 30.0)], "a int, b int, lake string, x double, y double, area double, h double")
    got = df.select(rules.chunks_of(F.col("a"), F.col("b"), 10).alias("c"), rules.capacity_choice(F.col("x"), F.col("y"), F.col("lake"), F.col("area"), F.col("h")).alias("k")).collect()
    assert [[tuple(s) for s in r.c] for r in got] == [[(2001, 2010), (2011, 2012)], [], [(2001, 2010)]]
    assert [r.k for r in got] == ["second:C1", "second:C2", "first:C3"]
    days = spark.sql("select date'2000-12-31' as d union all select date'2000-03-01' union all select date'2001-12-31'").select(rules.restamped(F.col("d"), F.lit(2003))).collect()
    assert sorted(str(r[0]) for r in days) == ["2003-03-02", "2003-12-31", "2003-12-31"]


def test_name_candidates_need_a_common_rare_word(spark):
    left = spark.createDataFrame([(1, "big rock dam"), (2, "dam")], "l int, name string")
    right = spark.createDataFrame([(1, "big rock dam"), (2, "rock lake dam"), (3, "other dam"), (4, "big hill")], "r int, name string")
    got = [(r.l, r.r, r["rank"]) for r in placement.name_candidates(left, right, "l", "r", "name", 2).orderBy("l", "rank").collect()]
    assert got == [(1, 1, 1), (1, 2, 2)]


def test_equal_candidate_names_are_compared_once(spark, monkeypatch):
    """Against the definition, with ids and names that repeat; the comparisons grow with the different names."""
    draw = random.Random(5)
    names = ["old mill dam", "new mill dam", "hill dam", "old hill weir", "dam", "", None]
    right = [(draw.choice([None, *range(300)]), draw.choice(names)) for _ in range(1500)]
    left = [(1, "old mill"), (2, "hill weir"), (3, "dam"), (4, None), (1, "new weir")]
    done = spark.sparkContext.accumulator(0)

    def distance(a, b):
        return abs(len(a) - len(b)) + sum(x != y for x, y in zip(a, b))

    def counted(a, b):
        done.add(1)
        return distance(a, b)

    holders = {w: {i for i, n in right if i is not None and w in (n or "").split()} for w in "old new mill hill dam weir".split()}
    usual = {w for w, ids in holders.items() if 0 < len(ids) <= 0.12 * len(right)}
    assert 0 < len(usual) < len(holders)
    with monkeypatch.context() as patched:
        patched.setattr(placement.F, "levenshtein", placement.F.udf(counted, "int"))
        patched.setattr(placement, "NAMES_A_TASK", 100)
        got = placement.name_candidates(spark.createDataFrame(left, "l int, name string"), spark.createDataFrame(right, "r int, name string"), "l", "r", "name", 2, 0.12).collect()
    pairs = {(i, j, round(1 - distance(a, b) / max(len(a), len(b)), 9), a, b) for i, a in left for j, b in right if a and b and usual & set(a.split()) & set(b.split())}
    expected = []
    for i in {p[0] for p in pairs}:
        own = sorted((p for p in pairs if p[0] == i), key=lambda p: (-p[2], p[1] is not None, p[1] or 0))
        expected += [(i, p[1], p[2], k + 1) for k, p in enumerate(own[:2])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert 0 < done.value <= 4 * len(left) * len(names) < len(pairs)


def test_text_tables_and_reports(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffname;cap \n# a note\nOne; 5\nTwo;\n".encode())
    assert values(text.read_delimited(spark, str(tmp_path / "a.csv"), sep=";"), "name") == [("One", "5"), ("Two", None)]
    (tmp_path / "b.txt").write_text("# id share\n 1  0.5\n2\t0.25\n3 x\n4 1 1\n")
    assert values(text.read_columns(spark, str(tmp_path / "b.txt"), ["id", "share"]), "id") == [(1.0, 0.5), (2.0, 0.25), (3.0, None)]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text('{"run": "a", "directory": "d", "start": 2001, "end": 2002}')
    (tmp_path / "m" / "b.json").write_text('{"run": "b", "chunks": [{"directory": "c1", "start": 1, "end": 1}, {"directory": "c2", "start": 2, "end": 3}]}')
    assert values(text.read_manifests(spark, str(tmp_path / "m")).drop("path"), "run", "year") == [("a", 2001, "d"), ("a", 2002, "d"), ("b", 1, "c1"), ("b", 2, "c2"), ("b", 3, "c2")]
    df = spark.createDataFrame([("b|c", 2), ("a", None)], "k string, n int")
    assert text.markdown_table(df, ["k"]) == "| k | n |\n|---|---|\n| a |  |\n| b\\|c | 2 |"
    with pytest.raises(ValueError):
        text.markdown_table(df, ["k"], most=1)
    text.write_report(df, str(tmp_path / "report"), ["k"])
    assert values(spark.read.option("header", True).csv(str(tmp_path / "report")), "k") == [("a", None), ("b|c", "2")]


def test_values_on_active_cells_and_blocks(spark):
    cells = spark.createDataFrame([(r, c, (r, c) != (0, 0)) for r in range(2) for c in range(3)], "r long, c long, active boolean")
    source = spark.createDataFrame([(r, c, float(10 * r + c)) for r in range(2) for c in range(3) if (r, c) != (1, 2)] + [(7, 7, -5.0)], "r long, c long, v double")
    assert values(grid.on_active(source, cells, ["r", "c"], "v", "active", fill=-1.0), "r", "c") == [(0, 1, 1.0), (0, 2, 2.0), (1, 0, 10.0), (1, 1, 11.0), (1, 2, -1.0)]
    for kwargs, word in ({}, "no value"), ({"fill": -1.0, "least": 0.0}, "too low"):
        with pytest.raises(Exception, match=word):
            grid.on_active(source, cells, ["r", "c"], "v", "active", **kwargs).collect()
    cut = grid.blocks(cells, "r", "c", 2, 2)
    assert values(cut.select("brow", "bcol", "place"), "r", "c") == [(0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 0, 2), (0, 0, 3), (0, 1, 2)]
    assert values(grid.unblocked(cut.select("brow", "bcol", "place"), "r", "c", 2, 2).select("r", "c"), "r", "c") == [(r, c) for r in range(2) for c in range(3)]
    axis = lambda n, low, size: spark.range(n).select("id", (F.col("id") * size + low).alias("low"), ((F.col("id") + 1) * size + low).alias("high"))
    assert values(grid.nesting_report(axis(12, 0.0, 0.5), axis(4, 0.0, 1.5), "low", "high"), "n_fine") == [(12, 12, 4)]
    assert values(grid.nesting_report(axis(12, 0.2, 0.5), axis(4, 0.0, 1.5), "low", "high"), "n_fine") == [(12, 8, 3)]


def test_cached_relations_are_made_once(spark):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    key = str(id(made))
    assert [session.cached(spark, key, make).count() for _ in range(3)] == [3, 3, 3] and len(made) == 1
    assert session.cached(spark, key + "x", make).count() == 3 and len(made) == 2


def test_years_without_data_are_an_error(spark):
    df = spark.createDataFrame([("a", 1950), ("c", 1600)], "s string, y int")
    year = rules.source_year(F.col("s"), F.col("y"), {"a": (1901, 2000), "c": (1850, 1850)}, ["c"])
    assert [r[0] for r in df.select(year).collect()] == [1950, 1850]
    with pytest.raises(Exception, match="no data of a"):
        spark.createDataFrame([("a", 2001)], "s string, y int").select(year).collect()
