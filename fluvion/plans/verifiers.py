"""Queries of network and product verifiers, samples, time axes and pruned reads on the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.functions import physics as P
from fluvion.operators import graph as G
from fluvion.operators import names as M
from fluvion.operators import verifiers as V
from fluvion.plans.register import registry
from fluvion.plans.relations import NETWORK, network
from fluvion.session import own_dir, table

QUERIES, ORACLES, query = registry()

COLUMNS = 60
RINGS = "SELECT c_custkey AS cell_id, c_custkey // 7 * 7 + CASE WHEN c_custkey % 7 < 5 THEN (c_custkey % 7 + 1) % 5 ELSE c_custkey % 7 - 5 END AS next_id FROM customer"


@query(f"""
WITH RECURSIVE n AS ({RINGS}), w(src, spot, step) AS (SELECT cell_id, cell_id, 0 FROM n UNION ALL SELECT src, m.cell_id, step + 1 FROM w JOIN n ON w.spot = n.cell_id JOIN n m ON n.next_id = m.cell_id WHERE step < 7),
c AS (SELECT DISTINCT src FROM w WHERE spot = src AND step > 0), l AS (SELECT src, min(spot) AS loop FROM w JOIN c USING (src) GROUP BY 1)
SELECT loop, l.src AS node, CAST(min(step) AS BIGINT) AS place FROM l JOIN w ON w.src = loop AND w.spot = l.src GROUP BY 1, 2""")
def network_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of every loop, in order, of a network with a loop of five in each block of seven cells and two cells that drain into it."""
    k = F.col("c_custkey")
    ring = F.when(k % 7 < 5, (k % 7 + 1) % 5).otherwise(k % 7 - 5)
    return G.loops(table(spark, sf_dir, "customer").select(k.alias("cell_id"), (F.floor(k / 7) * 7 + ring).alias("next_id")))


FAULTY = """SELECT c_custkey AS k, CASE WHEN c_custkey % 97 = 3 THEN 1000000000 + c_custkey WHEN c_custkey % 50 = 7 THEN c_custkey + 5 WHEN c_custkey % 40 = 1 THEN c_custkey - 1 ELSE c_custkey + 1 END AS t FROM customer WHERE c_custkey % 61 <> 5"""


@query(f"""
WITH o AS ({FAULTY}), n AS (SELECT * FROM o UNION ALL SELECT * FROM o WHERE k % 83 = 2), c AS (SELECT c_custkey AS k, c_custkey // 60 AS r, c_custkey % 60 AS c, c_mktsegment <> 'FURNITURE' AS active FROM customer),
f AS (SELECT 'repeated' AS "check", k FROM n GROUP BY k HAVING count(*) > 1
  UNION ALL SELECT 'not_active', k FROM (SELECT DISTINCT k FROM n) WHERE k NOT IN (SELECT k FROM c WHERE active)
  UNION ALL SELECT 'without_node', k FROM c WHERE active AND k NOT IN (SELECT k FROM n)
  UNION ALL SELECT 'unknown_target', k FROM n WHERE t NOT IN (SELECT k FROM n)
  UNION ALL SELECT 'far_target', n.k FROM n JOIN c a ON a.k = n.k JOIN c b ON b.k = n.t WHERE abs(a.r - b.r) > 1 OR least(abs(a.c - b.c), 60 - abs(a.c - b.c)) > 1
  UNION ALL SELECT 'loop', a.k FROM o a JOIN o b ON a.t = b.k AND b.t = a.k)
SELECT x."check", count(f.k) AS n, min(f.k) AS first, CASE WHEN count(f.k) = 0 THEN 'passed' ELSE 'failed' END AS status FROM (VALUES ('repeated'), ('not_active'), ('without_node'), ('unknown_target'), ('far_target'), ('loop')) x("check") LEFT JOIN f ON f."check" = x."check" GROUP BY 1""")
def network_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six checks of a network with planted faults, the smallest cell of each named."""
    k = F.col("c_custkey")
    to = F.when(k % 97 == 3, k + 1000000000).when(k % 50 == 7, k + 5).when(k % 40 == 1, k - 1).otherwise(k + 1)
    once = table(spark, sf_dir, "customer").where(k % 61 != 5).select(k.alias("cell_id"), to.alias("next_id"))
    return V.network_checks(once.unionByName(once.where("cell_id % 83 = 2")), grid(spark, sf_dir), COLUMNS)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    row, col = F.floor(k / COLUMNS), k % COLUMNS
    return table(spark, sf_dir, "customer").select(k.alias("cell_id"), row.alias("row"), col.alias("col"), (row - 50.0).alias("lat"), (col - 30.0).alias("lon"), (F.col("c_mktsegment") != "FURNITURE").alias("active"))


USED = "SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 45 = 44"


@query(f"""
WITH RECURSIVE n AS ({NETWORK}), u AS ({USED}), w(seed, spot, hop) AS (SELECT k, cell_id, next_id FROM u JOIN n ON k = cell_id UNION ALL SELECT seed, n.cell_id, n.next_id FROM w JOIN n ON w.hop = n.cell_id),
d AS (SELECT spot AS k, min(seed) AS label FROM w GROUP BY 1), g AS (SELECT cell_id AS k, cell_id // 60 AS r, cell_id % 60 AS c FROM n),
a AS (SELECT b.k, min(greatest(abs(s.r - b.r), least(abs(s.c - b.c), 60 - abs(s.c - b.c)))) AS steps FROM g b, g s JOIN d ON d.k = s.k WHERE abs(s.r - b.r) <= 2 AND least(abs(s.c - b.c), 60 - abs(s.c - b.c)) <= 2 GROUP BY 1)
SELECT g.k AS cell_id, CASE WHEN g.k IN (SELECT k FROM u) THEN 'used' WHEN d.label IS NOT NULL THEN 'downstream' WHEN steps IS NOT NULL THEN 'near' ELSE 'far' END AS "group", label, CAST(steps AS BIGINT) AS steps FROM g LEFT JOIN d USING (k) LEFT JOIN a USING (k)""")
def cell_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that use water, those downstream of them with the smallest user upstream, those at most two cells from either, and the rest."""
    used = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING' and c_custkey % 45 = 44").select(F.col("c_custkey").alias("cell_id"))
    cells, net = grid(spark, sf_dir), network(spark, sf_dir)
    labels = G.downstream_labels(net, used.withColumn("label", F.col("cell_id")), "label").withColumnRenamed("node", "cell_id")
    near = V.near_cells(cells, labels, "cell_id", 2, COLUMNS)
    out = cells.select("cell_id").join(labels, "cell_id", "left").join(near, "cell_id", "left").join(used.withColumn("_used", F.lit(True)), "cell_id", "left")
    group = F.when(F.col("_used"), "used").when(F.col("label").isNotNull(), "downstream").when(F.col("steps").isNotNull(), "near").otherwise("far")
    return out.select("cell_id", group.alias("group"), "label", F.col("steps").cast("long").alias("steps"))


@query("""
WITH q AS (SELECT s_suppkey AS child, s_nationkey AS parent, l_returnflag AS kind, sum(l_quantity) AS amount FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
w AS (SELECT s_nationkey AS parent, s_suppkey AS child, CASE WHEN s_suppkey % 9 = 0 THEN 0.5 ELSE 1.0 END AS share FROM supplier WHERE s_suppkey % 50 <> 3 UNION ALL SELECT (s_nationkey + 1) % 26, s_suppkey, 0.5 FROM supplier WHERE s_suppkey % 9 = 0 AND s_suppkey % 50 <> 3),
a AS (SELECT parent, kind, sum(amount) AS expected FROM q WHERE parent % 12 <> 5 OR kind <> 'R' GROUP BY 1, 2), h AS (SELECT w.parent, kind, sum(amount * coalesce(share, 1)) AS held, count(*) AS n_children FROM q LEFT JOIN w USING (child) GROUP BY 1, 2),
b AS (SELECT coalesce(a.parent, h.parent) AS parent, coalesce(a.kind, h.kind) AS kind, expected, held, n_children, coalesce(a.parent, h.parent) IN (SELECT parent FROM w) AS covered FROM a FULL JOIN h ON a.parent = h.parent AND a.kind = h.kind),
c AS (SELECT *, coalesce(expected, 0) AS e, coalesce(held, 0) AS t, coalesce(NOT covered, true) AND held IS NULL AS bare, expected IS NULL AS strange FROM b)
SELECT parent, kind, round(e, 4) AS expected, round(t, 4) AS held, coalesce(n_children, 0) AS n_children, round(CASE WHEN bare THEN e ELSE 0 END, 4) AS uncovered, round(CASE WHEN strange THEN t ELSE 0 END, 4) AS "foreign",
  round(CASE WHEN bare OR strange THEN 0 ELSE e - t END, 4) AS drift, CASE WHEN abs(e - t) <= 1e-6 * greatest(abs(e), abs(t), 1e-300) THEN 'passed' ELSE 'failed' END AS status FROM c""")
def grid_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities by nation against those of its suppliers, some of whom lie in two nations, in none, or in one that asks for nothing."""
    return _r(_conserved(spark, sf_dir), ["expected", "held", "uncovered", "foreign", "drift"])


def _conserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("child"), F.col("s_nationkey").alias("parent"))
    q = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("child"), F.col("l_returnflag").alias("kind"), "l_quantity").join(s, "child").groupBy("child", "parent", "kind").agg(F.sum("l_quantity").alias("amount"))
    split, known = F.col("child") % 9 == 0, s.where("child % 50 <> 3")
    weights = known.withColumn("share", F.when(split, 0.5).otherwise(1.0)).unionByName(known.where(split).select("child", ((F.col("parent") + 1) % 26).alias("parent"), F.lit(0.5).alias("share")))
    return V.conservation(q.where("parent % 12 <> 5 or kind <> 'R'"), q.drop("parent"), weights, "parent", "child", "kind", "amount", "share")


def _r(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + 0.0 for c in columns})


DRAWN = "('0x' || substr(md5('0:' || unit || ':' || month || ':' || day), 1, 8))::BIGINT < CAST(0.3 * 4294967296 AS BIGINT)"


@query(f"""
WITH o AS (SELECT o_orderpriority AS unit, extract(month FROM o_orderdate) AS month, extract(day FROM o_orderdate) AS day, o_custkey AS cell, c_nationkey AS coarse, o_totalprice AS v FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT unit, month * 100 + day AS time, coarse, avg(v) AS v FROM o GROUP BY 1, 2, 3), w AS (SELECT c_custkey AS cell, c_nationkey AS coarse, 0.7 AS weight FROM customer UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25, 0.3 FROM customer),
u AS (SELECT unit, month * 100 + day AS time, cell, avg(v) AS v FROM o WHERE {DRAWN} GROUP BY 1, 2, 3), m AS (SELECT s.unit, s.time, w.cell, sum(weight * s.v) / sum(weight) AS again FROM u JOIN w USING (cell) JOIN s ON s.unit = u.unit AND s.time = u.time AND s.coarse = w.coarse GROUP BY 1, 2, 3)
SELECT unit, count(*) AS n, count(*) FILTER (WHERE again IS NULL) AS n_missing, round(regr_slope(v, again), 5) AS slope, round(regr_intercept(v, again), 1) AS intercept, round(max(abs(v - again)), 2) AS worst,
  CASE WHEN count(*) FILTER (WHERE again IS NULL) = 0 AND max(abs(v - again)) <= 1000000 THEN 'passed' ELSE 'failed' END AS status FROM u LEFT JOIN m USING (unit, time, cell) GROUP BY 1""")
def recomputed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of days drawn by unit and month against the weighted mean of their nations; the sample is the operator's."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cell"), F.col("c_nationkey").alias("coarse"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("unit"), F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"), F.col("o_custkey").alias("cell"), F.col("o_totalprice").alias("v")).join(c, "cell")
    dated = o.withColumn("time", F.col("month") * 100 + F.col("day"))
    source = dated.groupBy("unit", "time", "coarse").agg(F.avg("v").alias("v"))
    weights = c.withColumn("weight", F.lit(0.7)).unionByName(c.select("cell", ((F.col("coarse") + 1) % 25).alias("coarse"), F.lit(0.3).alias("weight")))
    unit = dated.where(V.drawn(["unit", "month", "day"], 0.3)).groupBy("unit", "time", "cell").agg(F.avg("v").alias("v"))
    out = V.recomputed(unit, source, weights, ["unit"], "time", "cell", "coarse", "v", "weight", 1e6)
    return out.withColumns({"slope": F.round("slope", 5), "intercept": F.round("intercept", 1), "worst": F.round("worst", 2)})


@query("""
WITH d AS (SELECT o_custkey % 40 AS file, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, CAST(extract(doy FROM o_orderdate) AS INTEGER) AS day FROM orders), k AS (SELECT *, CASE file % 3 WHEN 0 THEN 365 WHEN 1 THEN 360 ELSE CASE WHEN year % 4 = 0 AND (year % 100 <> 0 OR year % 400 = 0) THEN 366 ELSE 365 END END AS w FROM d),
g AS (SELECT file, year, max(w) AS n_days, count(*) AS n, count(*) FILTER (WHERE day > w) AS outside, count(DISTINCT day) FILTER (WHERE day <= w) AS held FROM k GROUP BY 1, 2),
e AS (SELECT file, year, unnest(range(1, n_days + 1)) AS day FROM g), m AS (SELECT file, year, string_agg(day, ',' ORDER BY day) AS missing FROM e ANTI JOIN d USING (file, year, day) GROUP BY 1, 2)
SELECT file, year, n, n_days, coalesce(missing, '') AS missing, n - outside - held AS repeated, outside, missing IS NULL AND n - outside = held AND outside = 0 AS complete FROM g LEFT JOIN m USING (file, year)""")
def year_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness of the days of each file and year, in three calendars, with the days that lack."""
    date = F.col("o_orderdate")
    kind = F.element_at(F.array(F.lit("365_day"), F.lit("360_day"), F.lit("proleptic_gregorian")), (F.col("file") % 3 + 1).cast("int"))
    days = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("file"), F.year(date).alias("year"), F.dayofyear(date).alias("day")).withColumn("calendar", kind)
    return V.year_axes(days, ["file"], "year", "day", "calendar").withColumn("missing", F.array_join("missing", ","))


@query("""
WITH p AS (SELECT o_orderpriority AS run, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice FROM orders), w AS (SELECT run, max(year) AS year FROM p GROUP BY 1)
SELECT run, year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM p JOIN w USING (run, year) GROUP BY 1, 2""")
def run_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last year of each run, read from a product in folders by run and year."""
    p = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("run"), F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice")
    path = f"{own_dir(spark)}/product-{uuid.uuid4().hex}"
    V.write_by_year(p, path, "run", "year")
    wanted = p.groupBy("run").agg(F.max("year").alias("year"))
    return V.read_years(spark, path, wanted, "run", "year").groupBy("run", "year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


E2 = "(1 / 298.257223563 * (2 - 1 / 298.257223563))"
BELOW = "(sin(radians({x})) / (1 - {e2} * sin(radians({x})) * sin(radians({x}))) + ln((1 + sqrt({e2}) * sin(radians({x}))) / (1 - sqrt({e2}) * sin(radians({x})))) / (2 * sqrt({e2})))"


@query(f"""
SELECT c_custkey, round(power(6378137.0 * (1 - 1 / 298.257223563), 2) * pi() / 720 * ({BELOW.format(x="c_acctbal / 150 + 0.25", e2=E2)} - {BELOW.format(x="c_acctbal / 150 - 0.25", e2=E2)}), 0) AS area_m2 FROM customer""")
def ellipsoid_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of half-degree cells on the WGS 84 ellipsoid."""
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(P.ellipsoid_cell_area(F.col("c_acctbal") / 150, 0.5, 720), 0).alias("area_m2"))


@query()
def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three parts whose names have the largest block ratio with each kind's own name, at least 0.8 (a top-k report); tested against all pairs."""
    part = table(spark, sf_dir, "part")
    right = part.select("p_partkey", F.lower(F.concat_ws(" ", "p_brand", "p_type", "p_size")).alias("name"))
    left = part.groupBy(F.col("p_type").alias("kind")).agg(F.lower(F.concat_ws(" ", F.min("p_brand"), F.first("p_type"), F.max("p_size"))).alias("name"))
    return M.similar_names(left, right, "kind", "p_partkey", "name", 0.8)
