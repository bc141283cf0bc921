"""Queries of joins, grids and networks on the driver's tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.operators import graph as G
from fluvion.operators import grid as R
from fluvion.operators import joins as J
from fluvion.operators import nearest as N
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()

#: A forest on the customers: number k drains into (k - 1) div 2, number 0 is the outlet.
NETWORK = "SELECT c_custkey AS cell_id, CASE WHEN c_custkey = 0 THEN NULL ELSE (c_custkey - 1) // 2 END AS next_id, round(greatest(c_acctbal, 0), 0) AS area FROM customer"


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("cell_id"), F.when(key > 0, F.floor((key - 1) / 2).cast("long")).alias("next_id"), F.round(F.greatest("c_acctbal", F.lit(0.0)), 0).alias("area"))


@query(f"""
WITH RECURSIVE n AS ({NETWORK}), w(cell_id, spot, hop) AS (SELECT cell_id, cell_id, next_id FROM n UNION ALL SELECT w.cell_id, n.cell_id, n.next_id FROM w JOIN n ON w.hop = n.cell_id)
SELECT cell_id AS node, spot AS outlet FROM w WHERE hop IS NULL OR hop NOT IN (SELECT cell_id FROM n)""")
def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.outlets(network(spark, sf_dir))


@query(f"""
WITH RECURSIVE n AS ({NETWORK}), w(src, spot, hop, area) AS (SELECT cell_id, cell_id, next_id, area FROM n UNION ALL SELECT w.src, n.cell_id, n.next_id, w.area FROM w JOIN n ON w.hop = n.cell_id)
SELECT spot AS node, sum(area) AS upstream FROM w GROUP BY 1""")
def upstream_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.upstream_sum(network(spark, sf_dir), "area")


@query(f"""
WITH RECURSIVE n AS ({NETWORK}), w(src, spot, hop, d) AS (SELECT cell_id, cell_id, next_id, 0 FROM n UNION ALL SELECT w.src, n.cell_id, n.next_id, d + 1 FROM w JOIN n ON w.hop = n.cell_id)
SELECT spot AS node, max(d) AS level FROM w GROUP BY 1""")
def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return G.levels(n, n.where("next_id is not null"), "cell_id", "cell_id", "next_id")


@query(f"""
WITH RECURSIVE n AS ({NETWORK}), w(seed, node, hop, step) AS (SELECT cell_id, cell_id, next_id, 0 FROM n UNION ALL SELECT w.seed, n.cell_id, n.next_id, step + 1 FROM w JOIN n ON w.hop = n.cell_id)
SELECT seed, node, step FROM w""")
def downstream_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = network(spark, sf_dir)
    return G.downstream(n, n)


@query(f"""
WITH RECURSIVE n AS ({NETWORK}), w(seed, node, hop, step) AS (SELECT cell_id, cell_id, next_id, 0 FROM n UNION ALL SELECT w.seed, n.cell_id, n.next_id, step + 1 FROM w JOIN n ON w.hop = n.cell_id),
r AS (SELECT seed, node, step, row_number() OVER (PARTITION BY seed ORDER BY step) AS k FROM w JOIN customer ON node = c_custkey WHERE c_mktsegment = 'BUILDING')
SELECT seed, node AS station, step, k FROM r WHERE k <= 2""")
def stations_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two stations met on the way down from each cell."""
    n = network(spark, sf_dir)
    stations = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("node"))
    met = G.downstream(n, n).join(stations, "node")
    k = F.row_number().over(Window.partitionBy("seed").orderBy("step")).cast("long")
    return met.withColumn("k", k).where("k <= 2").select("seed", F.col("node").alias("station"), "step", "k")


@query("""
WITH RECURSIVE e AS (SELECT 'c' || o_custkey AS a, 'o' || o_orderkey AS b FROM orders UNION ALL SELECT 'c' || c_custkey, 'g' || c_nationkey || c_mktsegment FROM customer),
b AS (SELECT a, b FROM e UNION SELECT b, a FROM e), w(node, reach) AS (SELECT a, a FROM b UNION SELECT w.node, b.b FROM w JOIN b ON w.reach = b.a)
SELECT node, min(reach) AS component FROM w GROUP BY 1""")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers tied to all their orders and to their nation's segment."""
    bought = table(spark, sf_dir, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("o"), "o_orderkey").alias("dst"))
    segment = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("src"), F.concat(F.lit("g"), "c_nationkey", "c_mktsegment").alias("dst"))
    return G.connected_components(bought.unionByName(segment))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT c_custkey % 97 AS frm, (c_custkey * 7 + c_nationkey % 2) % 97 AS nxt FROM customer WHERE c_custkey % 97 <> 5),
s AS (SELECT frm, min(nxt) AS nxt FROM e GROUP BY 1 HAVING count(*) = 1), w(start, spot, n) AS (SELECT DISTINCT c_custkey % 97, c_custkey % 97, 0 FROM customer UNION ALL SELECT w.start, s.nxt, n + 1 FROM w JOIN s ON w.spot = s.frm WHERE w.spot <> 5 AND n < 100)
SELECT start, max(CASE WHEN spot = 5 THEN 1 ELSE 0 END) = 1 AS reached, min(CASE WHEN spot = 5 THEN n END) AS n_steps FROM w GROUP BY 1""")
def equivalence_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which codes lead to code 5 over edges without a choice."""
    c = table(spark, sf_dir, "customer")
    code = F.col("c_custkey") % 97
    edges = c.where(code != 5).select(code.alias("from_code"), ((F.col("c_custkey") * 7 + F.col("c_nationkey") % 2) % 97).alias("to_code"))
    return G.follow_chain(edges, c.select(code.alias("start")).distinct(), 5)


POINTS = ("SELECT s_suppkey, s_acctbal AS x, s_nationkey * 100.0 AS y FROM supplier", "SELECT c_custkey, c_acctbal AS x, c_nationkey * 100.0 AS y FROM customer")


def _points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    one = lambda t, p: table(spark, sf_dir, t).select(f"{p}key", F.col(f"{p[0]}_acctbal").alias("x"), (F.col(f"{p[0]}_nationkey") * 100.0).alias("y"))
    return one("supplier", "s_supp"), one("customer", "c_cust")


@query(f"""
WITH s AS ({POINTS[0]}), c AS ({POINTS[1]}), d AS (SELECT s_suppkey, c_custkey, sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y)) AS distance FROM s, c),
r AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY distance, c_custkey) AS r FROM d) SELECT s_suppkey, c_custkey, round(distance, 6) AS distance FROM r WHERE r = 1""")
def nearest_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = _points(spark, sf_dir)
    return N.nearest(s, c, "s_suppkey", "c_custkey", ["x", "y"]).withColumn("distance", F.round("distance", 6))


@query(f"""
WITH s AS ({POINTS[0]}), c AS ({POINTS[1]}) SELECT s_suppkey, c_custkey, round(sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y)), 6) AS distance FROM s, c
WHERE sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y)) <= 150 AND greatest(s.x, c.x) <= 2 * least(s.x, c.x)""")
def radius_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs within a radius whose values are also within a factor of two."""
    s, c = _points(spark, sf_dir)
    close = lambda a, b: F.greatest(a[0], b[0]) <= 2 * F.least(a[0], b[0])
    pairs = J.within_distance(s, c, "s_suppkey", "c_custkey", ["x", "y"], 150.0, also=close)
    return pairs.withColumn("distance", F.round("distance", 6))


@query()
def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-to-one matching of suppliers and customers, nearest first; tested against the greedy loop."""
    s, c = _points(spark, sf_dir)
    return J.match_nearest(s, c, "s_suppkey", "c_custkey", ["x", "y"], 150.0)


PLACE = "({k} * 37 % 1200) / 10.0 - 60 AS lat, ({k} * 91 % 3600) / 10.0 - 180 AS lon"


@query(f"""
WITH t AS (SELECT s_suppkey, s_nationkey % 7 AS kind, {PLACE.format(k="s_suppkey")} FROM supplier), d AS (SELECT c_custkey, c_nationkey % 7 AS kind, {PLACE.format(k="c_custkey")} FROM customer),
p AS (SELECT s_suppkey, c_custkey, t.kind > 0 AND t.kind = d.kind AS same, abs(t.lat - d.lat) <= 2 + 1e-9 AS band,
  2 * 6371.0 * asin(sqrt(least(1, power(sin(radians(t.lat - d.lat) / 2), 2) + cos(radians(t.lat)) * cos(radians(d.lat)) * power(sin(radians(t.lon - d.lon) / 2), 2)))) AS km FROM t, d),
l AS (SELECT *, CASE WHEN km <= 250 THEN 2 WHEN same THEN 3 WHEN band THEN 4 ELSE 5 END AS level FROM p),
m AS (SELECT s_suppkey, min(level) AS level FROM l GROUP BY 1),
c AS (SELECT l.*, m.level AS own FROM l JOIN m USING (s_suppkey) WHERE m.level = 5 OR (m.level = 2 AND km <= 250) OR (m.level = 3 AND same) OR (m.level = 4 AND band))
SELECT s_suppkey, arg_min(c_custkey, km) AS c_custkey, round(min(km), 4) AS km, own AS level FROM c GROUP BY s_suppkey, own""")
def donor_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest donor within a radius, else of an equal kind, else in the latitude band, else anywhere."""
    at = lambda k: [((F.col(k) * 37 % 1200) / 10.0 - 60).alias("lat"), ((F.col(k) * 91 % 3600) / 10.0 - 180).alias("lon")]
    t = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") % 7).alias("kind"), *at("s_suppkey"))
    d = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 7).alias("kind"), *at("c_custkey"))
    return J.choose_donors(t, d, "s_suppkey", "c_custkey", "lat", "lon", "kind", 250.0, 2.0).withColumn("km", F.round("km", 4))


@query("""
WITH t AS (SELECT s_suppkey, n_nationkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey), d AS (SELECT c_custkey, n_nationkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9900),
a AS (SELECT n_nationkey, min(c_custkey) AS k FROM d GROUP BY 1), b AS (SELECT n_regionkey, min(c_custkey) AS k FROM d GROUP BY 1)
SELECT s_suppkey, coalesce(a.k, b.k) AS c_custkey, CASE WHEN a.k IS NOT NULL THEN 'nation' WHEN b.k IS NOT NULL THEN 'region' END AS level FROM t LEFT JOIN a USING (n_nationkey) LEFT JOIN b USING (n_regionkey)""")
def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first customer of a supplier's nation, else of its region, among those with a large balance."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    t = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")).join(nation, "n_nationkey")
    d = table(spark, sf_dir, "customer").where("c_acctbal > 9900").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(nation, "n_nationkey")
    first = lambda key: t.select("s_suppkey", key).join(d.groupBy(key).agg(F.min("c_custkey").alias("c_custkey")), key).select("s_suppkey", "c_custkey")
    return J.ladder(t.select("s_suppkey"), [("nation", first("n_nationkey")), ("region", first("n_regionkey"))], "s_suppkey", "c_custkey")


@query("SELECT * EXCLUDE r FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return J.first_per_key(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


YEARS = "y AS (SELECT CAST(year AS INTEGER) AS year, CASE WHEN year % 4 = 0 AND (year % 100 <> 0 OR year % 400 = 0) THEN 366 ELSE 365 END AS d FROM range(1601, 2101) t(year))"


def _years(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


@query(f"""
WITH {YEARS}, u AS (SELECT d, min(year) AS s FROM y WHERE year IN (SELECT DISTINCT extract(year FROM o_orderdate) FROM orders) GROUP BY 1)
SELECT year, s AS source_year, CASE WHEN s IS NULL THEN 'missing' WHEN s = year THEN 'identity' ELSE 'constant' END AS rule FROM y LEFT JOIN u USING (d)""")
def year_map_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return J.map_constant(_years(spark, 1601, 2100), unit)


@query(f"""
WITH {YEARS}, c AS (SELECT y.year, y.d, k, (((y.year - 1901 + k) % 20) + 20) % 20 + 1901 AS s FROM y, range(0, 20) t(k)), f AS (SELECT c.year, c.k, c.s FROM c JOIN y z ON z.year = c.s WHERE z.d = c.d)
SELECT year, CAST(min_by(s, k) AS INTEGER) AS source_year FROM f GROUP BY 1""")
def year_map_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.map_cycle(_years(spark, 1601, 2100), 1901, 1920)


CELLS = "SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, p_retailprice AS v FROM part"


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(F.floor(key / 50).alias("r"), (key % 50).alias("c"), F.col("p_retailprice").alias("v"))


def _rows(cells: DataFrame) -> int:
    """Rows of the grid: one number, the axis that weight tables are made for."""
    return int(cells.agg(F.max("r")).first()[0]) + 1


@query(f"""
WITH g AS ({CELLS}), z AS (SELECT max(r) + 1 AS n FROM g), f AS (SELECT i AS row_id, i * 0.5 AS spot, n FROM z, range(0, 2 * (SELECT n FROM z) - 1) t(i)),
rw AS (SELECT row_id, CAST(least(floor(spot), n - 2) AS BIGINT) AS k, 1 - (spot - least(floor(spot), n - 2)) AS w FROM f UNION ALL SELECT row_id, CAST(least(floor(spot), n - 2) AS BIGINT) + 1, spot - least(floor(spot), n - 2) FROM f),
h AS (SELECT j AS col_id, j * 0.5 - 1 AS spot FROM range(0, 100) t(j)),
cw AS (SELECT col_id, (CAST(floor(spot) AS BIGINT) % 50 + 50) % 50 AS k, 1 - (spot - floor(spot)) AS w FROM h UNION ALL SELECT col_id, (CAST(floor(spot) AS BIGINT) + 51) % 50, spot - floor(spot) FROM h)
SELECT row_id, col_id, round(sum(rw.w * cw.w * v), 6) AS v FROM rw JOIN g ON g.r = rw.k JOIN cw ON cw.k = g.c GROUP BY 1, 2""")
def bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole grid at twice its resolution; columns wrap."""
    cells = _cells(spark, sf_dir)
    n = _rows(cells)
    rows = R.linear_weights(spark.range(0, 2 * n - 1).select(F.col("id").alias("row_id"), (F.col("id") * 0.5).alias("at")), "at", 0.0, 1.0, n)
    cols = R.linear_weights(spark.range(0, 100).select(F.col("id").alias("col_id"), (F.col("id") * 0.5 - 1).alias("at")), "at", 0.0, 1.0, 50, periodic=True)
    values = cells.select(F.col("r").alias("prow"), F.col("c").alias("pcol"), "v")
    return R.bilinear(rows, cols, values, "row_id", "col_id", "v").withColumn("v", F.round("v", 6))


@query(f"""
WITH g AS ({CELLS}), z AS (SELECT max(r) + 1 AS n FROM g), a AS (SELECT r, r * (120.0::DOUBLE / n) - 60 AS low, (r + 1) * (120.0::DOUBLE / n) - 60 AS high FROM z, range(0, (SELECT n FROM z)) t(r)),
b AS (SELECT k, k * (180.0::DOUBLE / n) - 60 AS low, (k + 1) * (180.0::DOUBLE / n) - 60 AS high FROM z, range(0, CAST(ceil((SELECT n FROM z) / 1.5) AS BIGINT)) t(k)),
ro AS (SELECT r, k, sin(radians(least(a.high, b.high))) - sin(radians(greatest(a.low, b.low))) AS w FROM a JOIN b ON a.low < b.high AND b.low < a.high),
co AS (SELECT c, k, least(c * 1.0 + 1, k * 2.5 + 2.5) - greatest(c * 1.0, k * 2.5) AS w FROM range(0, 50) a(c), range(0, 20) b(k) WHERE c < k * 2.5 + 2.5 AND k * 2.5 < c + 1)
SELECT ro.k AS to_row, co.k AS to_col, round(sum(ro.w * co.w * v) / nullif(sum(ro.w * co.w), 0), 6) AS v FROM g JOIN ro USING (r) JOIN co USING (c) GROUP BY 1, 2""")
def overlap_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole grid, spread from 60 south to 60 north, on rows 1.5 and columns 2.5 times as large."""
    cells = _cells(spark, sf_dir)
    n = _rows(cells)
    axis = lambda count, low, size: spark.range(0, count).select("id", (F.col("id") * size + low).alias("low"), ((F.col("id") + 1) * size + low).alias("high"))
    rows = R.overlap_weights(axis(n, -60.0, 120.0 / n), axis(math.ceil(n / 1.5), -60.0, 180.0 / n), spherical=True)
    cols = R.overlap_weights(axis(50, 0.0, 1.0), axis(20, 0.0, 2.5))
    values = cells.select(F.col("r").alias("row"), F.col("c").alias("col"), "v")
    return R.conservative_remap(values, rows, cols, "v").withColumn("v", F.round("v", 6))


@query(f"""
WITH g AS ({CELLS}), a AS (SELECT * FROM g WHERE v > 1000), s AS (SELECT x.dr, y.dc FROM (VALUES (-1), (0), (1)) x(dr), (VALUES (-1), (0), (1)) y(dc) WHERE dr <> 0 OR dc <> 0)
SELECT g.r, g.c, count(a.r) AS n_active FROM g, s LEFT JOIN a ON a.r = g.r + dr AND a.c = (g.c + dc + 50) % 50 WHERE g.r + dr BETWEEN 0 AND (SELECT max(r) FROM g) GROUP BY 1, 2""")
def neighbour_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    active = cells.where("v > 1000").select(F.col("r").alias("nrow"), F.col("c").alias("ncol"), F.lit(1).alias("_on"))
    around = R.neighbours(cells, "r", "c", _rows(cells), 50).join(active, ["nrow", "ncol"], "left")
    return around.groupBy("r", "c").agg(F.count("_on").alias("n_active"))


@query(f"""
WITH g AS ({CELLS}) SELECT CASE WHEN b.c % 24 = 0 THEN 'two' WHEN b.c % 12 = 0 THEN 'one' WHEN b.c % 6 = 0 THEN 'half' WHEN b.c % 3 = 0 THEN 'quarter' ELSE 'interior' END AS line,
  count(*) AS n, round(avg(abs(b.v - a.v)), 6) AS mean_jump, round(avg(CASE WHEN b.v = a.v THEN 1.0 ELSE 0.0 END), 6) AS zero_share FROM g a JOIN g b ON a.r = b.r AND b.c = a.c + 1 GROUP BY 1""")
def line_jump_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    left = cells.select("r", (F.col("c") + 1).alias("c"), F.col("v").alias("_a"))
    line = R.line_class(F.col("c"), {"quarter": 3, "half": 6, "one": 12, "two": 24})
    return cells.join(left, ["r", "c"]).groupBy(line.alias("line")).agg(
        F.count("*").alias("n"), F.round(F.avg(F.abs(F.col("v") - F.col("_a"))), 6).alias("mean_jump"), F.round(F.avg((F.col("v") == F.col("_a")).cast("double")), 6).alias("zero_share")
    )


@query(f"WITH g AS ({CELLS}) SELECT CAST(floor(r / 3) AS BIGINT) AS prow, CAST(floor(c / 6) AS BIGINT) AS pcol, count(*) AS n, round(max(v) - min(v), 4) AS spread FROM g GROUP BY 1, 2")
def subdivision_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir).withColumn("prow", R.parent_index(F.col("r"), 0.0, 3.0)).withColumn("pcol", R.parent_index(F.col("c"), 0.0, 6.0))
    return cells.groupBy("prow", "pcol").agg(F.count("*").alias("n"), F.round(F.max("v") - F.min("v"), 4).alias("spread"))
