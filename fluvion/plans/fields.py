"""Queries of volumes, aggregates, climatologies and comparisons on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.functions import physics as P
from fluvion.operators import aggregates as A
from fluvion.operators import allocation as L
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()

SPLIT = """
WITH p AS (SELECT s_nationkey AS nationkey, sum(greatest(s_acctbal, 0)) AS v FROM supplier GROUP BY 1),
c AS (SELECT c_nationkey AS nationkey, c_custkey, c_mktsegment <> 'FURNITURE' AS active, CASE WHEN c_mktsegment <> 'FURNITURE' THEN greatest(c_acctbal, 0) ELSE 0 END AS w FROM customer),
s AS (SELECT nationkey, sum(w) AS sw, count(*) FILTER (WHERE active) AS n FROM c GROUP BY 1),
k AS (SELECT p.nationkey, v, sw, n, CASE WHEN v = 0 THEN 0 WHEN sw > 0 THEN 1 WHEN n > 0 THEN 2 ELSE 3 END AS split_class FROM p LEFT JOIN s USING (nationkey)),
r AS (SELECT nationkey, c_custkey, split_class, CASE WHEN split_class = 1 THEN v * w / sw WHEN split_class = 2 AND active THEN v / n ELSE 0 END AS share, v FROM k LEFT JOIN c USING (nationkey))
"""


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.sum(F.greatest("s_acctbal", F.lit(0.0))).alias("v"))
    children = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"), "c_custkey", F.col("c_acctbal").alias("weight"), (F.col("c_mktsegment") != "FURNITURE").alias("active"))
    return L.split_volume(parents, children, "nationkey", "v", "weight", "active")


@query(SPLIT + "SELECT nationkey, c_custkey, split_class, round(share, 4) AS share FROM r")
def split_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("nationkey", "c_custkey", "split_class", F.round("share", 4).alias("share"))


@query(SPLIT + "SELECT nationkey, max(split_class) AS split_class, round(max(v), 2) AS volume, round(max(v) - sum(share), 2) + 0.0 AS lost FROM r GROUP BY 1")
def lost_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = F.round(F.max("v") - F.sum("share"), 2) + 0.0
    return _split(spark, sf_dir).groupBy("nationkey").agg(F.max("split_class").alias("split_class"), F.round(F.max("v"), 2).alias("volume"), lost.alias("lost"))


@query("""
WITH o AS (SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS part, sum(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice ELSE 0 END) AS whole FROM orders GROUP BY 1),
c AS (SELECT c_custkey, c_nationkey, n_regionkey, coalesce(part, 0) AS part, coalesce(whole, 0) AS whole FROM customer LEFT JOIN o ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT *, sum(CASE WHEN whole > 0 THEN part END) OVER (PARTITION BY c_nationkey) / nullif(sum(CASE WHEN whole > 0 THEN whole END) OVER (PARTITION BY c_nationkey), 0) AS r1,
  sum(CASE WHEN whole > 0 THEN part END) OVER (PARTITION BY n_regionkey) / nullif(sum(CASE WHEN whole > 0 THEN whole END) OVER (PARTITION BY n_regionkey), 0) AS r2,
  sum(CASE WHEN whole > 0 THEN part END) OVER () / nullif(sum(CASE WHEN whole > 0 THEN whole END) OVER (), 0) AS r3 FROM c)
SELECT c_custkey, round(least(greatest(coalesce(CASE WHEN whole > 0 THEN part / whole END, r1, r2, r3), 0), 1), 6) AS ratio FROM f""")
def ratio_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", price).otherwise(0.0)).alias("part"), F.sum(F.when(F.col("o_orderstatus").isin("F", "O"), price).otherwise(0.0)).alias("whole")
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(o, "c_custkey", "left").fillna(0.0, ["part", "whole"]).join(nation, "c_nationkey")
    return L.ratio_with_fallback(c, "part", "whole", ["c_nationkey", "n_regionkey"]).select("c_custkey", F.round("ratio", 6).alias("ratio"))


SHARES = """
WITH s AS (SELECT c_nationkey, c_mktsegment, sum(greatest(c_acctbal, 0)) / 1000000 AS share FROM customer GROUP BY 1, 2),
t AS (SELECT *, sum(share) OVER (PARTITION BY c_nationkey) AS total FROM s),
u AS (SELECT *, CASE WHEN total > 1 THEN share / total ELSE share END AS sc FROM t),
v AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY (sc > 0) DESC, (c_mktsegment IN ('BUILDING', 'HOUSEHOLD')) DESC, sc DESC, c_mktsegment) AS r, 1 - sum(sc) OVER (PARTITION BY c_nationkey) AS rest FROM u)
SELECT c_nationkey, c_mktsegment, round(sc + CASE WHEN r = 1 AND sc > 0 THEN rest ELSE 0 END, 6) AS closed FROM v"""


@query(SHARES)
def closure_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg((F.sum(F.greatest("c_acctbal", F.lit(0.0))) / 1000000).alias("share"))
    closed = L.close_shares(s.withColumn("natural", F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")), "c_nationkey", "c_mktsegment", "share", "natural")
    return closed.select("c_nationkey", "c_mktsegment", F.round("closed", 6).alias("closed"))


@query("""
WITH b AS (SELECT p_brand, p_type, sum(p_retailprice) / 100000 AS share FROM part WHERE p_size < 10 GROUP BY 1, 2),
w AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size > 45),
j AS (SELECT coalesce(b.p_brand, w.p_brand) AS p_brand, coalesce(b.p_type, w.p_type) AS p_type, CASE WHEN coalesce(share, 0) > 0 THEN share ELSE 0.001 END AS s FROM b FULL JOIN w ON b.p_brand = w.p_brand AND b.p_type = w.p_type)
SELECT p_brand, p_type, round(s / sum(s) OVER (PARTITION BY p_brand), 6) AS share, count(*) OVER (PARTITION BY p_brand) AS n_tiles FROM j""")
def tile_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    base = part.where("p_size < 10").groupBy("p_brand", "p_type").agg((F.sum("p_retailprice") / 100000).alias("share"))
    return L.union_tiles(base, part.where("p_size > 45"), "p_brand", "p_type", "share", 0.001).withColumn("share", F.round("share", 6))


@query()
def water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three demands of each nation's segment over its customers; tested against a plain loop over each parent."""
    key = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(
        F.concat_ws("/", "c_nationkey", "c_mktsegment").alias("parent"), "c_nationkey", "c_custkey", F.greatest("c_acctbal", F.lit(0.0)).alias("room"), *[F.when(key % (i + 2) == 0, F.abs("c_acctbal")).otherwise(0.0).alias(f"w{i}") for i in range(3)]
    )
    d = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(*[F.sum(F.greatest("s_acctbal", F.lit(0.0)) * k).alias(f"d{i}") for i, k in enumerate((0.2, 0.1, 0.4))])
    return L.water_fill(c.join(d, "c_nationkey"), "parent", "c_custkey", "room", ["d0", "d1", "d2"], ["w0", "w1", "w2"])


@query("""
WITH c AS (SELECT c_nationkey AS parent, c_custkey, greatest(c_acctbal, 0) AS room, CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey % 3 = 0 THEN greatest(c_acctbal, 0) ELSE 0 END AS w0,
  CASE WHEN c_mktsegment = 'FURNITURE' AND c_nationkey % 3 < 2 THEN greatest(c_acctbal, 0) ELSE 0 END AS w1, CASE WHEN c_nationkey <> 5 THEN greatest(c_acctbal, 0) ELSE 0 END AS w2, c_nationkey * 10.0 AS demand FROM customer),
s AS (SELECT parent, sum(room) AS cap, sum(w0) AS s0, sum(w1) AS s1, sum(w2) AS s2 FROM c GROUP BY 1),
l AS (SELECT c.*, cap, CASE WHEN demand > 0 THEN CASE WHEN s0 > 0 THEN 1 WHEN s1 > 0 THEN 2 WHEN s2 > 0 THEN 3 ELSE 9 END ELSE 0 END AS weight_level, CASE WHEN s0 > 0 THEN w0 WHEN s1 > 0 THEN w1 WHEN s2 > 0 THEN w2 ELSE 0 END AS w FROM c JOIN s USING (parent)),
m AS (SELECT *, weight_level BETWEEN 2 AND 8 AND demand < 0.001 * cap AS single, row_number() OVER (PARTITION BY parent ORDER BY w DESC, c_custkey) AS r FROM l)
SELECT parent, c_custkey, weight_level, single, round(CASE WHEN weight_level BETWEEN 1 AND 8 THEN CASE WHEN single THEN CASE WHEN r = 1 AND room > 0 THEN 1 ELSE 0 END ELSE w END ELSE 0 END, 4) AS weight FROM m""")
def weight_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's first weight that any customer has; all to one customer where a fallback serves a small demand."""
    nation, room = F.col("c_nationkey"), F.greatest("c_acctbal", F.lit(0.0))
    c = table(spark, sf_dir, "customer").select(
        nation.alias("parent"), "c_custkey", room.alias("room"), F.when((F.col("c_mktsegment") == "BUILDING") & (nation % 3 == 0), room).otherwise(0.0).alias("w0"),
        F.when((F.col("c_mktsegment") == "FURNITURE") & (nation % 3 < 2), room).otherwise(0.0).alias("w1"), F.when(nation != 5, room).otherwise(0.0).alias("w2"), (nation * 10.0).alias("demand"),
    )
    return L.fallback_weights(c, "parent", "c_custkey", "room", "demand", ["w0", "w1", "w2"], 0.001).select("parent", "c_custkey", "weight_level", "single", F.round("weight", 4).alias("weight"))


@query("SELECT l_returnflag, l_linestatus, round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 6) AS mean, round(sum(l_quantity), 2) AS weight FROM lineitem GROUP BY 1, 2")
def area_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = A.weighted_mean(F.col("l_discount"), F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(mean, 6).alias("mean"), F.round(F.sum("l_quantity"), 2).alias("weight"))


@query("SELECT CAST(floor(l_quantity / 2) * 2 AS BIGINT) AS band, count(*) AS n, round(sum(l_discount * l_extendedprice) / nullif(sum(l_extendedprice), 0), 6) AS mean FROM lineitem GROUP BY 1")
def zonal_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = A.weighted_mean(F.col("l_discount"), F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").groupBy((F.floor(F.col("l_quantity") / 2) * 2).cast("long").alias("band")).agg(F.count("*").alias("n"), F.round(mean, 6).alias("mean"))


@query("""
WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS r, sum(n) OVER (PARTITION BY p_brand) AS t, count(*) OVER (PARTITION BY p_brand) AS k FROM c)
SELECT p_brand, p_size AS mode_value, round(n / t, 6) AS mode_share, CASE WHEN k = 1 THEN 'uniform' ELSE 'mixed' END AS kind FROM r WHERE r = 1""")
def block_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.block_mode(table(spark, sf_dir, "part"), ["p_brand"], "p_size").withColumn("mode_share", F.round("mode_share", 6))


@query("""
WITH v AS (SELECT p_partkey // 10 AS window_id, CASE WHEN p_size % 4 = 0 OR p_partkey // 10 % 5 = 0 THEN 0 ELSE p_size % 4 END AS class FROM part), c AS (SELECT window_id, class, count(*) AS n FROM v GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY class = 0, n DESC, class) AS r FROM c) SELECT window_id, class AS majority FROM r WHERE r = 1""")
def window_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Majority class of windows of ten parts; 0 stands for no data."""
    key, size = F.col("p_partkey"), F.col("p_size")
    v = table(spark, sf_dir, "part").select(F.floor(key / 10).alias("window_id"), F.when((size % 4 == 0) | (F.floor(key / 10) % 5 == 0), 0).otherwise(size % 4).alias("class"))
    return A.window_majority(v, ["window_id"], "class")


@query("""
WITH s AS (SELECT p_brand, p_type, sum(p_retailprice) AS w FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY round(w, 4) DESC, p_type) AS r FROM s)
SELECT p_brand, p_type AS dominant FROM r WHERE r = 1""")
def dominant_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dominant_category(table(spark, sf_dir, "part"), ["p_brand"], "p_type", "p_retailprice", "none")


@query("""
SELECT o_orderpriority AS o_orderpriority, CAST(bit_or(1 << CAST(extract(month FROM o_orderdate) AS INTEGER)) AS INTEGER) AS months,
  CAST(bit_or(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 4 END) AS INTEGER) AS states, (bit_or(1 << CAST(extract(month FROM o_orderdate) AS INTEGER)) >> 2) & 1 = 1 AS february FROM orders GROUP BY 1""")
def class_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(4)
    months = F.bit_or(F.expr("shiftleft(1, month(o_orderdate))"))
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(months.alias("months"), F.bit_or(state).alias("states")).withColumn("february", F.getbit("months", F.lit(2)) == 1)


@query("""
WITH k AS (SELECT CAST(least(floor(abs(l_extendedprice) / 500), 1000) AS BIGINT) AS b, l_returnflag, count(*) AS n, max(abs(l_extendedprice)) AS m FROM lineitem GROUP BY 1, 2),
c AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY b) AS c, sum(n) OVER (PARTITION BY l_returnflag) AS t, max(m) OVER (PARTITION BY l_returnflag) AS mx FROM k)
SELECT l_returnflag, CAST(max(t) AS BIGINT) AS n, max(mx) AS largest, (min(b) + 1) * 500.0::DOUBLE AS percentile FROM c WHERE c >= ceil(0.99 * t) GROUP BY 1""")
def hist_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.histogram_percentile(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", 500.0, 1000, 0.99)


@query("""
WITH s AS (SELECT l_returnflag, l_extendedprice AS v, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2), c AS (SELECT *, sum(w) OVER (PARTITION BY l_returnflag ORDER BY v) AS c, sum(w) OVER (PARTITION BY l_returnflag) AS t FROM s)
SELECT l_returnflag, min(CASE WHEN c >= 0.1 * t THEN v END) AS q10, min(CASE WHEN c >= 0.5 * t THEN v END) AS q50, min(CASE WHEN c >= 0.9 * t THEN v END) AS q90 FROM c GROUP BY 1""")
def weighted_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.weighted_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity", [0.1, 0.5, 0.9])


@query("""
WITH r AS (SELECT c_nationkey, c_acctbal AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) AS k FROM customer WHERE c_acctbal > 0)
SELECT c_nationkey, count(*) AS n, round(2 * sum(k * v) / (count(*) * sum(v)) - (count(*) + 1) / count(*), 6) AS gini FROM r GROUP BY 1""")
def gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.gini(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal", F.col("c_acctbal") > 0).withColumn("gini", F.round("gini", 6))


CLIMATE = """
WITH d AS (SELECT c_nationkey, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
m AS (SELECT c_nationkey, CAST(extract(year FROM day) AS INTEGER) AS year, CAST(extract(month FROM day) AS INTEGER) AS month, count(value) AS n_days, CASE WHEN count(value) >= 3 THEN avg(value) END AS mean FROM d GROUP BY 1, 2, 3)
"""


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    daily = table(spark, sf_dir, "orders").join(customer, "o_custkey").groupBy("c_nationkey", F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("value"))
    return A.monthly_means(daily, ["c_nationkey"], "day", "value", 3)


@query(CLIMATE + "SELECT c_nationkey, year, month, n_days, round(mean, 4) AS mean FROM m")
def monthly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir).withColumn("mean", F.round("mean", 4))


@query(CLIMATE + "SELECT c_nationkey, month, count(mean) AS n_years, " + ", ".join(f"round(CASE WHEN count(mean) >= 5 THEN {n}(mean) END, 4) AS {n}_mean" for n in ("avg", "min", "max")) + " FROM m GROUP BY 1, 2")
def monthly_climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.climatology(_monthly(spark, sf_dir), ["c_nationkey"], 5)
    return out.select("c_nationkey", "month", "n_years", *[F.round(f"{n}_mean", 4).alias(f"{n}_mean") for n in ("avg", "min", "max")])


@query("""
WITH m AS (SELECT c_nationkey, extract(month FROM o_orderdate) AS month, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
a AS (SELECT month, avg(v) AS ref FROM m GROUP BY 1)
SELECT c_nationkey, count(*) AS n_months, round(corr(v, ref), 6) AS seasonal_r, round(sum(v) / sum(ref), 6) AS ratio, sum(v) / sum(ref) BETWEEN 0.8 AND 1.25 AS near FROM m JOIN a USING (month) GROUP BY 1""")
def seasonal_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    m = table(spark, sf_dir, "orders").join(customer, "o_custkey").groupBy("c_nationkey", F.month("o_orderdate").alias("month")).agg(F.sum("o_totalprice").alias("v"))
    both = m.join(m.groupBy("month").agg(F.avg("v").alias("ref")), "month")
    ratio = F.sum("v") / F.sum("ref")
    return both.groupBy("c_nationkey").agg(F.count("*").alias("n_months"), F.round(F.corr("v", "ref"), 6).alias("seasonal_r"), F.round(ratio, 6).alias("ratio"), ratio.between(0.8, 1.25).alias("near"))


@query("""
WITH y AS (SELECT c_nationkey, extract(year FROM o_orderdate) AS year, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
t AS (SELECT c_nationkey, count(v) AS n, regr_slope(v, year) AS slope, sqrt(greatest(regr_syy(v, year) - regr_sxy(v, year) ^ 2 / regr_sxx(v, year), 0) / (count(v) - 2)) AS deviation FROM y GROUP BY 1 HAVING count(v) > 2)
SELECT c_nationkey, n, round(slope, 1) AS slope, round(deviation, 1) AS deviation, round(abs(slope) / deviation, 5) AS ratio, abs(slope) / deviation <= 0.5 AS passed FROM t""")
def trend_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    y = table(spark, sf_dir, "orders").join(customer, "o_custkey").groupBy("c_nationkey", F.year("o_orderdate").cast("double").alias("year")).agg(F.sum("o_totalprice").alias("v"))
    out = A.trend(y, ["c_nationkey"], "year", "v", 0.5).where("n > 2")
    return out.select("c_nationkey", "n", F.round("slope", 1).alias("slope"), F.round("deviation", 1).alias("deviation"), F.round("ratio", 5).alias("ratio"), "passed")


@query("""
WITH b AS (SELECT p_brand, count(p_retailprice) AS n, var_pop(p_retailprice) AS v, avg(p_retailprice) AS m FROM part GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(n * v) / (sum(n * v) + sum(n * m * m) - sum(n * m) ^ 2 / sum(n)), 5) AS share_within FROM b""")
def variance_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.variance_share(table(spark, sf_dir, "part"), "p_brand", "p_retailprice").withColumn("share_within", F.round("share_within", 5))


@query("""
SELECT l_returnflag, count(*) FILTER (WHERE l_extendedprice * (1 - l_discount) - l_extendedprice * 0.95 > 1e-4 + 1e-5 * abs(l_extendedprice * 0.95)) AS n_violations,
  count(*) FILTER (WHERE l_extendedprice IS NULL OR l_discount IS NULL) AS n_missing, round(max(l_extendedprice * (1 - l_discount) - l_extendedprice * 0.95), 4) AS worst_excess FROM lineitem GROUP BY 1""")
def budget_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    out = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(*A.tolerance_check(price * (1 - F.col("l_discount")), price * 0.95))
    return out.withColumn("worst_excess", F.round("worst_excess", 4))


@query("""
WITH b AS (SELECT o_orderkey, o_totalprice AS a, CASE WHEN o_orderkey % 31 = 3 THEN NULL WHEN o_custkey % 7 = 0 THEN o_totalprice + 1.5 ELSE o_totalprice END AS q FROM orders)
SELECT o_orderkey % 4 AS grp, count(*) AS n, count(*) FILTER (WHERE a IS DISTINCT FROM q) AS n_differing, round(max(abs(a - q)), 4) AS max_diff, max(abs(a)) AS max_value FROM b GROUP BY 1""")
def compare_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 4).alias("grp"), "o_orderkey", "o_custkey", F.col("o_totalprice").alias("q"))
    other = rows.withColumn("q", F.when(F.col("o_orderkey") % 31 == 3, None).when(F.col("o_custkey") % 7 == 0, F.col("q") + 1.5).otherwise(F.col("q")))
    return A.compare_fields(rows, other, ["grp", "o_orderkey"], "q").withColumn("max_diff", F.round("max_diff", 4))


@query("""
WITH y AS (SELECT o_custkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2),
j AS (SELECT coalesce(a.year, b.year + 1) AS year, coalesce(a.v, 0) AS n1, coalesce(b.v, 0) AS n0 FROM y a FULL JOIN y b ON a.o_custkey = b.o_custkey AND a.year = b.year + 1)
SELECT year, round(sum(CASE WHEN n1 > 0 AND n1 < 0.5 * n0 THEN n0 ELSE 0 END) / sum(n0), 6) AS halved, round(sum(CASE WHEN n0 > 0 AND n1 > 2 * n0 THEN n0 ELSE 0 END) / sum(n0), 6) AS doubled,
  round(sum(CASE WHEN n0 > 0 AND n1 = 0 THEN n0 ELSE 0 END) / sum(n0), 6) AS vanished, count(*) FILTER (WHERE n0 = 0 AND n1 > 0) AS n_new
FROM j, (SELECT min(year) AS lo, max(year) AS hi FROM y) WHERE year BETWEEN lo + 1 AND hi GROUP BY 1""")
def year_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("v"))
    out = A.year_step(y, ["o_custkey"], "year", "v")
    return out.select("year", *[F.round(c, 6).alias(c) for c in ("halved", "doubled", "vanished")], "n_new")


@query("""
SELECT year, n, round(d, 4) AS change, round(greatest(d, 0), 4) AS rise, round(greatest(-d, 0), 4) AS repaid FROM (
  SELECT year, n, v - lag(v) OVER (ORDER BY year) AS d FROM (SELECT CAST(extract(year FROM l_shipdate) AS INTEGER) AS year, count(*) AS n, sum(l_quantity) AS v FROM lineitem GROUP BY 1))""")
def yearly_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per year: the window sees no more than the calendar.
    y = table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("v"))
    d = F.col("v") - F.lag("v").over(Window.orderBy("year"))
    zero = F.lit(0.0)
    change = y.withColumn("d", d)
    return change.select("year", "n", F.round("d", 4).alias("change"), F.when(F.col("d").isNotNull(), F.round(F.greatest("d", zero), 4)).otherwise(0.0).alias("rise"), F.when(F.col("d").isNotNull(), F.round(F.greatest(-F.col("d"), zero), 4)).otherwise(0.0).alias("repaid"))


@query("""
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS mean, round(stddev_samp(c_acctbal), 4) AS deviation, """ + ", ".join(f"round(quantile_cont(c_acctbal, {q / 100}), 4) AS p{q}" for q in (1, 5, 25, 50, 75, 95, 99)) + " FROM customer GROUP BY 1")
def summary_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = {f"p{x}": x / 100 for x in (1, 5, 25, 50, 75, 95, 99)}
    c = table(spark, sf_dir, "customer")
    out = c.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"), F.round(F.stddev_samp("c_acctbal"), 4).alias("deviation"))
    return out.join(A.exact_percentiles(c, ["c_mktsegment"], "c_acctbal", q), "c_mktsegment").select("c_mktsegment", "n", "mean", "deviation", *[F.round(x, 4).alias(x) for x in q])


AIR = "SELECT l_orderkey, l_linenumber, 260 + l_quantity AS t, 0.001 + l_discount / 10 + 0.0 AS q, 90000 + l_tax * 100000 AS p, l_quantity * 10 - 200 AS dz FROM lineitem"


@query(f"""
WITH a AS ({AIR}),
b AS (SELECT *, t - 0.0065 * dz AS th, q / (1 - q) AS r FROM a),
c AS (SELECT *, p * exp(-dz * 9.80665 / (287.05 * 0.5 * (t * (1 + 0.61 * r) + th * (1 + 0.61 * r)))) AS ph FROM b),
d AS (SELECT *, 0.61078 * exp(17.269 * (th - 273.15) / (237.3 + th - 273.15)) AS water, r / (0.622 + r) * ph / 1000 AS e FROM c),
f AS (SELECT *, CASE WHEN th < 273.15 THEN water * (1 + 0.00972 * (th - 273.15) + 0.000042 * (th - 273.15) * (th - 273.15)) ELSE water END AS svp FROM d)
SELECT l_orderkey, l_linenumber, round(th, 6) AS air_temp, round(ph, 4) AS pressure, round(least(e, svp), 6) AS vp, round(svp, 6) AS svp,
  round(1.08 * (1 - exp(-pow(10 * least(e, svp), th / 2016))), 6) AS emissivity FROM f""")
def physics_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (260 + F.col("l_quantity")).alias("t"), (0.001 + F.col("l_discount") / 10).alias("q"), (90000 + F.col("l_tax") * 100000).alias("p"), (F.col("l_quantity") * 10 - 200).alias("dz")
    )
    t, q, p, dz = (F.col(x) for x in "t q p dz".split())
    b = a.withColumn("th", P.temperature_at_height(t, dz)).withColumn("ph", P.pressure_at_height(p, t, q, dz))
    c = b.withColumn("svp", P.saturation_pressure(P.to_celsius(F.col("th")))).withColumn("vp", F.least(P.vapour_pressure(q, F.col("ph")) / 1000, F.col("svp")))
    return c.select(
        "l_orderkey", "l_linenumber", F.round("th", 6).alias("air_temp"), F.round("ph", 4).alias("pressure"), F.round("vp", 6).alias("vp"), F.round("svp", 6).alias("svp"), F.round(P.emissivity(F.col("th"), 10 * F.col("vp")), 6).alias("emissivity")
    )


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, sum(l_quantity / 50) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS d FROM lineitem),
c AS (SELECT *, 1 - 0.5 * (exp(-6.0 * d) + exp(-2.0 * d)) AS y FROM l), f AS (SELECT *, y - coalesce(lag(y) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber), 0) AS part FROM c)
SELECT l_orderkey, l_linenumber, round(part / sum(part) OVER (PARTITION BY l_orderkey), 6) AS fraction FROM f""")
def root_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = Window.partitionBy("l_orderkey")
    order = own.orderBy("l_linenumber")
    depth = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.sum(F.col("l_quantity") / 50).over(order).alias("d"))
    y = depth.withColumn("y", P.cumulative_roots(F.col("d"), F.lit(6.0), F.lit(2.0)))
    part = y.withColumn("part", F.col("y") - F.coalesce(F.lag("y").over(order), F.lit(0.0)))
    return part.select("l_orderkey", "l_linenumber", F.round(F.col("part") / F.sum("part").over(own), 6).alias("fraction"))


@query("""
SELECT c_custkey, round(2 * pi() * 6371000.0 * 6371000.0 * (sin(radians(lat + 0.25)) - sin(radians(lat - 0.25))) / 720, 0) AS area_m2,
  round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat - 50) / 2), 2) + cos(radians(50)) * cos(radians(lat)) * pow(sin(radians(lon - 10) / 2), 2)))), 4) AS km, CASE WHEN lat > 0 AND lon > 0 THEN greatest(lat / lon, lon / lat) ELSE CAST('inf' AS DOUBLE) END > 2 AS far_ratio
FROM (SELECT c_custkey, c_acctbal / 200 AS lat, c_nationkey * 10.0 - 120 AS lon FROM customer)""")
def areas_and_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 200).alias("lat"), (F.col("c_nationkey") * 10.0 - 120).alias("lon"))
    lat, lon = F.col("lat"), F.col("lon")
    return c.select("c_custkey", F.round(P.sphere_cell_area(lat, 0.5, 720), 0).alias("area_m2"), F.round(P.great_circle_km(F.lit(50.0), F.lit(10.0), lat, lon), 4).alias("km"), (P.area_ratio(lat, lon) > 2).alias("far_ratio"))
