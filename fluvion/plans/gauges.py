"""Queries of snapping, placing, gauges and networks on the driver's tables.

The grid is made of the customers: number k is the cell in row k div 60 and
column k mod 60 of a grid of one degree that starts at 50 south and 30 west.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.operators import checks as V
from fluvion.operators import graph as G
from fluvion.operators import joins as J
from fluvion.operators import placement as S
from fluvion.plans.register import registry
from fluvion.plans.relations import NETWORK, network
from fluvion.session import table

QUERIES, ORACLES, query = registry()

FIRST, STEP, COLUMNS = (-50.0, -30.0), (1.0, 1.0), 60
CELLS = """SELECT c_custkey // 60 AS r, c_custkey % 60 AS c, (c_custkey // 60) - 50.0 AS lat, c_custkey % 60 - 30.0 AS lon, c_mktsegment <> 'FURNITURE' AS active, 100.0 AS area, 100.0 + greatest(c_acctbal, 0) AS upstream FROM customer"""
POINTS = "SELECT s_suppkey, (s_suppkey * 7 % 60) / 10.0 - 50.2 AS lat, (s_suppkey * 13 % 590) / 10.0 - 30.3 AS lon, CASE WHEN s_suppkey % 9 = 0 THEN 40.0 ELSE abs(s_acctbal) + 120 END AS catch FROM supplier"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    row, col = F.floor(F.col("c_custkey") / 60), F.col("c_custkey") % 60
    return table(spark, sf_dir, "customer").select(row.alias("row"), col.alias("col"), (row - 50.0).alias("lat"), (col - 30.0).alias("lon"), (F.col("c_mktsegment") != "FURNITURE").alias("active"), F.lit(100.0).alias("area"), (F.greatest("c_acctbal", F.lit(0.0)) + 100).alias("upstream"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k, (k * 7 % 60 / 10.0 - 50.2).alias("lat"), (k * 13 % 590 / 10.0 - 30.3).alias("lon"), F.when(k % 9 == 0, 40.0).otherwise(F.abs("s_acctbal") + 120).alias("catch"))


NEAR = f"""g AS ({CELLS}), p AS ({POINTS}), n AS (SELECT *, CAST(round_even(lat + 50, 0) AS BIGINT) AS r0, CAST(round_even(lon + 30, 0) AS BIGINT) AS c0 FROM p)"""


@query(f"""
WITH {NEAR},
k AS (SELECT n.s_suppkey, n.catch, g.*, CASE WHEN g.r = r0 AND g.c = c0 % 60 THEN 0 ELSE 1 + (dr + 1) * 3 + (dc + 1) END AS o, n.lat AS plat, n.lon AS plon
  FROM n, (VALUES (-1), (0), (1)) x(dr), (VALUES (-1), (0), (1)) y(dc) JOIN g ON g.r = r0 + dr AND g.c = (c0 + dc + 60) % 60 WHERE active),
d AS (SELECT *, CASE WHEN o = 0 THEN -1 ELSE 2 * 6371 * asin(sqrt(least(1, power(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * power(sin(radians(lon - plon) / 2), 2)))) END AS far FROM k),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY far, o) AS i FROM d) WHERE i = 1),
b AS (SELECT * FROM (SELECT d.*, s.o AS so, s.r AS sr, s.c AS sc, s.upstream AS su, row_number() OVER (PARTITION BY d.s_suppkey ORDER BY abs(d.catch - d.upstream), d.o <> s.o, d.o) AS i FROM d JOIN s USING (s_suppkey)) WHERE i = 1),
f AS (SELECT *, catch / area < 1 AS is_local, greatest(catch / upstream, upstream / catch) > 1.5 AS back FROM b)
SELECT p.s_suppkey, CASE WHEN is_local OR back THEN sr ELSE r END AS "row", CASE WHEN is_local OR back THEN sc ELSE c END AS col, CASE WHEN is_local THEN 'local' WHEN is_local IS NOT NULL THEN 'global' END AS kind,
  CASE WHEN is_local THEN f.catch / area WHEN is_local IS NOT NULL THEN 1.0 END AS fraction,
  coalesce(CASE WHEN so = 0 THEN 'nearest' ELSE 'nearest_active' END || CASE WHEN is_local THEN '_local' WHEN back THEN '_global_revert' WHEN o = so THEN '_global' ELSE '_global_neighbourhood' END, 'none') AS method,
  round(CASE WHEN NOT is_local THEN CASE WHEN back THEN greatest(f.catch / su, su / f.catch) ELSE greatest(f.catch / upstream, upstream / f.catch) END END, 6) AS ratio
FROM p LEFT JOIN f USING (s_suppkey)""".replace("CASE WHEN so = 0 THEN 'nearest' ELSE 'nearest_active' END ||", "CASE WHEN so = 0 THEN 'nearest' WHEN so > 0 THEN 'nearest_active' END ||"))
def snap_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.snap(points(spark, sf_dir), cells(spark, sf_dir), "s_suppkey", "lat", "lon", "catch", FIRST, STEP, COLUMNS).withColumn("ratio", F.round("ratio", 6))


@query(f"""
WITH {NEAR},
k AS (SELECT s_suppkey, catch, r, c, upstream, CASE WHEN dr = 0 AND dc = 0 THEN -1 ELSE (dr + 3) * 7 + dc + 3 END AS o FROM n, (SELECT i - 3 AS dr FROM range(7) a(i)), (SELECT j - 3 AS dc FROM range(7) b(j)) JOIN g ON g.r = r0 + dr AND g.c = (c0 + dc + 60) % 60 WHERE active AND catch > 0),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(ln(upstream / catch)), o) AS i FROM k) WHERE i = 1)
SELECT s_suppkey, r AS "row", c AS col, round(upstream, 4) AS upstream, round(upstream / catch - 1, 6) AS area_error FROM b WHERE abs(upstream / catch - 1) <= 0.3""")
def gauge_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.map_stations(points(spark, sf_dir), cells(spark, sf_dir), "s_suppkey", "lat", "lon", "catch", FIRST, STEP, COLUMNS)
    return found.select("s_suppkey", "row", "col", F.round("upstream", 4).alias("upstream"), F.round("area_error", 6).alias("area_error"))


@query()
def placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two customers to a cell, the larger balance first: a neighbour's cell, else merged or not placed; tested against the plain loop."""
    cell = F.floor(F.col("c_custkey") / 2)
    c = table(spark, sf_dir, "customer").select("c_custkey", cell.alias("cell"), F.array(cell + 1, cell - 1).alias("others"), (-F.col("c_acctbal")).alias("rank"), (F.col("c_mktsegment") == "BUILDING").alias("future"))
    return S.place_one_per_cell(c, "c_custkey", "cell", "others", ["rank"], "future")


@query(f"""
WITH RECURSIVE n AS (SELECT q.*, c_acctbal + 500 AS flow, c_mktsegment <> 'FURNITURE' AS active FROM ({NETWORK}) q JOIN customer ON cell_id = c_custkey),
w(seed, node, hop, step) AS (SELECT cell_id, cell_id, next_id, 0 FROM n UNION ALL SELECT w.seed, n.cell_id, n.next_id, step + 1 FROM w JOIN n ON w.hop = n.cell_id),
f AS (SELECT w.seed, w.node, w.step, b.active, coalesce(a.flow > 0 AND b.flow > 0 AND a.flow / b.flow >= 0.2, false) AS good, a.flow / b.flow AS f FROM w JOIN n a ON a.cell_id = w.seed JOIN n b ON b.cell_id = w.node),
e AS (SELECT seed, min(step) AS last FROM f WHERE NOT good GROUP BY 1), h AS (SELECT f.*, row_number() OVER (PARTITION BY f.seed ORDER BY step) AS r FROM f LEFT JOIN e USING (seed) WHERE (last IS NULL OR step < last) AND active)
SELECT seed, node, step, round(least(f, 1), 6) AS fraction FROM h WHERE r <= 4
UNION ALL SELECT cell_id, cell_id, 0, 1 FROM n WHERE cell_id NOT IN (SELECT seed FROM h)""")
def service_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that every cell serves downstream, four at most (the operator's own bound)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cell_id"), (F.col("c_acctbal") + 500).alias("flow"), (F.col("c_mktsegment") != "FURNITURE").alias("active"))
    n = network(spark, sf_dir).join(c, "cell_id")
    return S.trace_service(n, n, "flow", "active", 0.2, 4).withColumn("fraction", F.round("fraction", 6))


@query(f"""
WITH RECURSIVE n AS ({NETWORK}), m AS (SELECT cell_id, CASE WHEN cell_id % 5 <> 1 THEN next_id END AS next_id, area FROM n),
w(cell_id, spot, hop, area) AS (SELECT cell_id, cell_id, next_id, area FROM m UNION ALL SELECT w.cell_id, m.cell_id, m.next_id, w.area FROM w JOIN m ON w.hop = m.cell_id)
SELECT spot AS outlet, sum(area) AS total, count(*) AS n_cells, row_number() OVER (ORDER BY sum(area) DESC, spot) AS rank FROM w WHERE hop IS NULL GROUP BY 1 QUALIFY rank <= 10""")
def largest_basins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest basins of the network cut at every fifth cell (a top-k report)."""
    cut = network(spark, sf_dir).withColumn("next_id", F.when(F.col("cell_id") % 5 != 1, F.col("next_id")))
    return G.largest_basins(cut, "area", 10)


@query(f"""
WITH n AS ({NETWORK}), g AS (SELECT c_custkey, c_nationkey AS grp FROM customer) SELECT cell_id, next_id, a.grp AS from_group, b.grp AS to_group FROM n JOIN g a ON cell_id = a.c_custkey LEFT JOIN g b ON next_id = b.c_custkey WHERE next_id IS NOT NULL AND a.grp IS DISTINCT FROM b.grp""")
def crossing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("group"))
    links = network(spark, sf_dir).where("next_id is not null").select("cell_id", "next_id")
    return G.crossing_links(links, groups, "cell_id", "next_id").select("cell_id", "next_id", "from_group", "to_group")


@query("""
WITH RECURSIVE r AS (SELECT p_partkey, lower(p_brand || ' ' || p_type || ' ' || p_size) AS name FROM part), l AS (SELECT p_type AS kind, lower(p_type || ' ' || min(p_brand) || ' ' || max(p_size)) AS name FROM part GROUP BY 1),
rw AS (SELECT DISTINCT p_partkey, name, unnest(string_split(name, ' ')) AS w FROM r), u AS (SELECT w FROM rw WHERE w <> '' GROUP BY w HAVING count(DISTINCT p_partkey) <= 0.5 * (SELECT count(*) FROM r)),
lw AS (SELECT DISTINCT kind, name, unnest(string_split(name, ' ')) AS w FROM l), p AS (SELECT DISTINCT kind, p_partkey, lw.name AS a, rw.name AS b FROM lw JOIN rw USING (w) JOIN u USING (w)),
s AS (SELECT kind, p_partkey, round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 9) AS similarity FROM p)
SELECT kind, p_partkey, similarity, row_number() OVER (PARTITION BY kind ORDER BY similarity DESC, p_partkey) AS rank FROM s QUALIFY rank <= 3""")
def name_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most similar parts for each kind's own name (a top-k report)."""
    part = table(spark, sf_dir, "part")
    right = part.select("p_partkey", F.lower(F.concat_ws(" ", "p_brand", "p_type", "p_size")).alias("name"))
    # Brands first: a least string is found by sorting, which is to see few rows.
    brands = part.groupBy(F.col("p_type").alias("kind"), "p_brand").agg(F.max("p_size").alias("p_size"))
    left = brands.groupBy("kind").agg(F.lower(F.concat_ws(" ", "kind", F.min("p_brand"), F.max("p_size"))).alias("name"))
    return S.name_candidates(left, right, "kind", "p_partkey", "name", 3)


@query("""
WITH m AS (SELECT l_suppkey, avg(l_quantity) AS one, avg(CASE WHEN l_linenumber <= 3 THEN l_quantity END) AS two, avg(l_quantity * (1 - l_discount)) AS obs FROM lineitem GROUP BY 1),
k AS (SELECT *, one / obs AS a, two / obs AS b, abs(ln(one / two)) AS ch, s_nationkey % 5 AS area FROM m JOIN supplier ON l_suppkey = s_suppkey WHERE one > 0 AND two > 0 AND obs > 0)
SELECT area, count(*) AS n_stations, round(median(a), 6) AS median_one, round(median(b), 6) AS median_two, round(avg(CASE WHEN a BETWEEN 0.8 AND 1.25 THEN 1.0 ELSE 0 END), 6) AS within_one, round(avg(CASE WHEN b BETWEEN 0.8 AND 1.25 THEN 1.0 ELSE 0 END), 6) AS within_two,
  count(*) FILTER (WHERE ch > ln(1.05)) AS n_changed_5, count(*) FILTER (WHERE ch > ln(1.2)) AS n_changed_20, count(*) FILTER (WHERE abs(ln(a)) < abs(ln(b)) AND ch > ln(1.05)) AS n_closer_5 FROM k GROUP BY 1""")
def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs at the suppliers as stations, against what was observed."""
    q = F.col("l_quantity")
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.avg(q).alias("one"), F.avg(F.when(F.col("l_linenumber") <= 3, q)).alias("two"), F.avg(q * (1 - F.col("l_discount"))).alias("obs"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") % 5).alias("area"))
    out = V.compare_runs(m.join(s, "s_suppkey"), ["area"], "one", "two", "obs")
    return out.select("area", "n_stations", *[F.round(c, 6).alias(c) for c in ("median_one", "median_two", "within_one", "within_two")], "n_changed_5", "n_changed_20", "n_closer_5")


@query()
def staged_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers matched by a given pair, then by an equal code (nearest first), then by place; tested against the plain loop."""
    at = lambda t, p: table(spark, sf_dir, t).select(f"{p}key", F.col(f"{p[0]}_acctbal").alias("x"), (F.col(f"{p[0]}_nationkey") * 100.0).alias("y"), (F.col(f"{p}key") * 11 % 400).alias("code"))
    return staged(at("supplier", "s_supp"), at("customer", "c_cust"))


def staged(s: DataFrame, c: DataFrame) -> DataFrame:
    given = lambda a, b: a.where("s_suppkey % 10 = 0").join(b, F.col("s_suppkey") * 10 == F.col("c_custkey")).select("s_suppkey", "c_custkey", F.lit(0.0).alias("distance"))
    coded = lambda a, b: J.match_nearest(a, b, "s_suppkey", "c_custkey", ["x", "y"], equal=["code"])
    placed = lambda a, b: J.match_nearest(a, b, "s_suppkey", "c_custkey", ["x", "y"], 120.0)
    return J.match_in_stages(s, c, "s_suppkey", "c_custkey", [("given", given), ("code", coded), ("place", placed)])
