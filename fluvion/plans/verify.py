"""Queries of verifiers, balances and totals on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.functions import physics as P
from fluvion.functions import rules as T
from fluvion.operators import aggregates as A
from fluvion.operators import checks as V
from fluvion.operators import placement as S
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()


@query("""
WITH f AS (SELECT p_brand, CASE WHEN p_size % 7 <> 0 THEN p_retailprice / 1000 END AS v, p_partkey % 11 <> 0 AS active FROM part)
SELECT p_brand, count(*) FILTER (WHERE active) AS n_active, count(*) FILTER (WHERE active AND v IS NULL) AS n_missing, count(*) FILTER (WHERE active AND (v <= 0.9 OR v > 1.9)) AS n_out_of_range, count(*) FILTER (WHERE active AND v = 0) AS n_zero,
  count(*) FILTER (WHERE active AND v = 1) AS n_one, count(*) FILTER (WHERE NOT active AND v IS NOT NULL) AS n_outside, round(min(v) FILTER (WHERE active), 6) AS lowest, round(max(v) FILTER (WHERE active), 6) AS highest,
  CASE WHEN count(*) FILTER (WHERE active AND v IS NULL) = 0 AND count(*) FILTER (WHERE active AND (v <= 0.9 OR v > 1.9)) = 0 THEN 'passed' ELSE 'failed' END AS status FROM f GROUP BY 1""")
def value_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "part").select("p_brand", F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice") / 1000).alias("v"), (F.col("p_partkey") % 11 != 0).alias("active"))
    return V.value_check(f, ["p_brand"], "v", "active", 0.9, 1.9, low_open=True).withColumn("lowest", F.round("lowest", 6)).withColumn("highest", F.round("highest", 6))


BALANCE = """b AS (SELECT s_nationkey AS unit, CAST(extract(year FROM l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS p, sum(l_quantity * l_discount) AS et, sum(l_quantity * l_tax) AS q,
  sum(CASE WHEN extract(month FROM l_shipdate) = 12 THEN l_quantity ELSE 0 END) AS store FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("unit"))
    rows = table(spark, sf_dir, "lineitem").join(s, "l_suppkey")
    return rows.groupBy("unit", F.year("l_shipdate").alias("year")).agg(F.sum(q).alias("p"), F.sum(q * F.col("l_discount")).alias("et"), F.sum(q * F.col("l_tax")).alias("q"), F.sum(F.when(F.month("l_shipdate") == 12, q).otherwise(0.0)).alias("store"))


@query(f"""
WITH {BALANCE} SELECT b.unit, b.year, round(b.p - b.et - b.q, 4) AS net, round(b.store - a.store, 4) AS storage_change, round(b.p - b.et - b.q - (b.store - a.store), 4) AS residual FROM b LEFT JOIN b a ON a.unit = b.unit AND a.year = b.year - 1""")
def water_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.closure(balance(spark, sf_dir), ["unit"], "year", "p", ["et", "q"], "store")
    return out.select("unit", "year", F.round(F.col("p") - F.col("et") - F.col("q"), 4).alias("net"), F.round("storage_change", 4).alias("storage_change"), F.round("residual", 4).alias("residual"))


@query(f"""
WITH {BALANCE}, l AS (SELECT *, lag(et, 1, 0) OVER (PARTITION BY unit ORDER BY year) AS before FROM b) SELECT unit, year, round(et - before, 4) AS increase, round(greatest(before - et, 0), 4) AS repaid FROM l""")
def deficit_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.deficit_repaid(balance(spark, sf_dir), ["unit"], "year", "et")
    return out.select("unit", "year", F.round("increase", 4).alias("increase"), F.round("repaid", 4).alias("repaid"))


@query(f"""
WITH {BALANCE}, y AS (SELECT year, sum(p) AS p, sum(et) AS et, sum(q) AS q FROM b GROUP BY 1), o AS (SELECT year, sum(p) AS p, sum(et) AS et, sum(q) AS q FROM b WHERE unit <> 3 GROUP BY 1)
SELECT year, term, round(one, 4) AS one, round(two, 4) AS two, round(one - two, 4) AS difference, round(100 * (one - two) / nullif(two, 0), 4) AS percent
FROM (SELECT year, unnest(['p', 'et', 'q']) AS term, unnest([y.p, y.et, y.q]) AS one, unnest([o.p, o.et, o.q]) AS two FROM y JOIN o USING (year))""")
def balance_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual balance of all units against one without unit 3, term by term."""
    terms = ["p", "et", "q"]
    b = balance(spark, sf_dir)
    one = b.groupBy("year").agg(*[F.sum(t).alias(t) for t in terms]).unpivot("year", terms, "term", "one")
    two = b.where("unit <> 3").groupBy("year").agg(*[F.sum(t).alias(t) for t in terms]).unpivot("year", terms, "term", "two")
    d = F.col("one") - F.col("two")
    return one.join(two, ["year", "term"]).select("year", "term", F.round("one", 4).alias("one"), F.round("two", 4).alias("two"), F.round(d, 4).alias("difference"), F.round(F.try_divide(100 * d, F.col("two")), 4).alias("percent"))


@query("""
WITH c AS (SELECT c_nationkey % 6 * 10.0 - 30 AS lat, c_custkey % 360 - 180.0 AS lon, greatest(c_acctbal, 0) AS v FROM customer),
r AS (SELECT *, CASE WHEN lat BETWEEN -30 AND 0 AND lon BETWEEN -90 AND 0 THEN 'southwest' WHEN lat BETWEEN -30 AND 20 AND lon BETWEEN -10 AND 60 THEN 'middle' WHEN lat BETWEEN 0 AND 20 AND lon BETWEEN -180 AND 0 THEN 'northwest' ELSE 'other' END AS region FROM c)
SELECT region, count(*) AS n, round(sum(v * 2 * pi() * 6371000.0 * 6371000.0 * (sin(radians(lat + 0.25)) - sin(radians(lat - 0.25))) / 720) * 1e-12, 6) AS total_km3 FROM r GROUP BY 1""")
def region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals in km3 of a depth in mm on cells of half a degree, by the first named region that holds the cell."""
    c = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 6 * 10.0 - 30).alias("lat"), (F.col("c_custkey") % 360 - 180.0).alias("lon"), F.greatest("c_acctbal", F.lit(0.0)).alias("v"))
    boxes = [("southwest", -30.0, 0.0, -90.0, 0.0), ("middle", -30.0, 20.0, -10.0, 60.0), ("northwest", 0.0, 20.0, -180.0, 0.0)]
    region = S.named_region(F.col("lat"), F.col("lon"), boxes)
    km3 = F.sum(F.col("v") * P.sphere_cell_area(F.col("lat"), 0.5, 720)) * 1e-12
    return c.groupBy(region.alias("region")).agg(F.count("*").alias("n"), F.round(km3, 6).alias("total_km3"))


@query("""
WITH w AS (SELECT c_custkey, c_nationkey AS country, 0.7 AS w FROM customer UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25, 0.3 FROM customer WHERE c_custkey % 3 = 0)
SELECT country, round(sum(w * greatest(c_acctbal, 0)), 4) AS total, round(sum(w::DOUBLE), 4) AS cells FROM w JOIN customer USING (c_custkey) GROUP BY 1""")
def country_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that belong to countries by fractions: each cell's value counts by its weight."""
    c = table(spark, sf_dir, "customer")
    parts = F.array(F.struct(F.col("c_nationkey").alias("country"), F.lit(0.7).alias("w")), F.when(F.col("c_custkey") % 3 == 0, F.struct(((F.col("c_nationkey") + 1) % 25).alias("country"), F.lit(0.3).alias("w"))))
    held = c.select(F.greatest("c_acctbal", F.lit(0.0)).alias("v"), F.explode(F.array_compact(parts)).alias("p"))
    return held.groupBy(F.col("p.country").alias("country")).agg(F.round(F.sum(F.col("p.w") * F.col("v")), 4).alias("total"), F.round(F.sum("p.w"), 4).alias("cells"))


TREND = """y AS (SELECT l_suppkey AS cell, s_nationkey % 4 AS quantity, CAST(extract(year FROM l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE extract(year FROM l_shipdate) BETWEEN 1995 AND 2000 GROUP BY 1, 2, 3),
t AS (SELECT quantity, cell, count(*) AS n, regr_slope(v, year) AS b, sqrt(greatest(regr_syy(v, year) - regr_sxy(v, year) * regr_sxy(v, year) / regr_sxx(v, year), 0) / nullif(count(*) - 2, 0)) AS sd, max(abs(v)) AS top FROM y GROUP BY 1, 2),
p AS (SELECT quantity, cell, n < 3 AS missing, CASE WHEN n < 3 THEN false WHEN sd <= 1e-12 * top THEN abs(b) <= 1e-12 * top ELSE abs(b) / sd <= 0.3 END AS passed FROM t)"""


def trend_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") % 4).alias("quantity"))
    year = F.year("l_shipdate")
    y = table(spark, sf_dir, "lineitem").where(year.between(1995, 2000)).join(s, "l_suppkey").groupBy("quantity", F.col("l_suppkey").alias("cell"), year.alias("year")).agg(F.sum("l_quantity").alias("v"))
    return A.trend(y, ["quantity", "cell"], "year", "v", 0.3).withColumn("missing", F.col("n") < 3)


@query(f"""
WITH {TREND} SELECT quantity, count(*) AS cells, count(*) FILTER (WHERE passed) AS passed_cells, count(*) FILTER (WHERE missing) AS missing_cells, round(count(*) FILTER (WHERE passed) / count(*), 6) AS share_passed, count(*) FILTER (WHERE passed) / count(*) >= 0.9 AS passed FROM p GROUP BY 1""")
def cell_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.share_passed(trend_cells(spark, sf_dir), ["quantity"], "passed", "missing", 0.9).withColumn("share_passed", F.round("share_passed", 6))


@query(f"""
WITH {TREND}, q AS (SELECT quantity, count(*) FILTER (WHERE passed) / count(*) >= 0.9 AS passed FROM p GROUP BY 1), k AS (SELECT b.block, CASE WHEN b.block % 3 <> 2 THEN q.passed OR b.block % 2 = 0 END AS passed, b.block = 3 AND quantity = 0 AS problem FROM q, range(6) b(block))
SELECT block, CASE WHEN count(*) FILTER (WHERE problem) > 0 OR count(passed) = 0 THEN 'not_checked' WHEN count(*) FILTER (WHERE NOT passed) > 0 THEN 'failed' ELSE 'passed' END AS status FROM k GROUP BY 1""")
def block_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six blocks: even ones pass whatever their quantities do, every third has no test, block 3 has a problem."""
    q = V.share_passed(trend_cells(spark, sf_dir), ["quantity"], "passed", "missing", 0.9)
    b = q.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))))
    tests = b.select("block", F.when(F.col("block") % 3 != 2, F.col("passed") | (F.col("block") % 2 == 0)).alias("passed"), ((F.col("block") == 3) & (F.col("quantity") == 0)).alias("problem"))
    return V.block_status(tests, ["block"], "passed", "problem")


@query("""
WITH m AS (SELECT o_custkey % 25 AS unit, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, CAST(extract(month FROM o_orderdate) AS INTEGER) AS month, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3), d AS (SELECT *, day(last_day(make_date(year, month, 1))) AS days FROM m)
SELECT unit, year, count(*) AS n_months, round(CASE WHEN count(*) = 12 THEN sum(v * days) / sum(days) END, 4) AS mean, round(CASE WHEN count(*) = 12 THEN min(v) END, 4) AS lowest, round(max(CASE WHEN month = 12 THEN v END), 4) AS december FROM d GROUP BY 1, 2""")
def annual_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 25).alias("unit"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.avg("o_totalprice").alias("v"))
    out = V.annual_means(m, ["unit"], "year", "month", "v")
    return out.select("unit", "year", "n_months", *[F.round(c, 4).alias(c) for c in ("mean", "lowest", "december")])


@query("""
WITH c AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS s, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(n, 0) AS n_children, abs(coalesce(s, 0) - o_totalprice) <= 0.01 + 0.5 * abs(o_totalprice) AS agrees FROM orders LEFT JOIN c ON o_orderkey = l_orderkey""")
def reaggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against the sum of their lines, within half of the total."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("part"))
    return V.reaggregate(table(spark, sf_dir, "orders"), lines, "o_orderkey", "o_totalprice", "part", 0.01, 0.5).select("o_orderkey", "n_children", "agrees")


@query("""
WITH l AS (SELECT c_custkey AS k, round(c_acctbal, 0) AS v FROM customer WHERE c_custkey % 7 <> 0), m AS (SELECT c_custkey AS k, round(c_acctbal, 0) + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS v FROM customer WHERE c_custkey % 11 <> 0)
SELECT state, count(*) AS n FROM (SELECT CASE WHEN l.k IS NULL THEN 'only_measured' WHEN m.k IS NULL THEN 'only_ledger' WHEN abs(l.v - m.v) <= 0.5 THEN 'matched' ELSE 'differs' END AS state FROM l FULL JOIN m USING (k)) GROUP BY 1""")
def ledger_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.round("c_acctbal", 0).alias("v"))
    measured = c.where("k % 11 <> 0").withColumn("v", F.col("v") + F.when(F.col("k") % 5 == 0, 1).otherwise(0))
    return V.ledger_match(c.where("k % 7 <> 0"), measured, ["k"], "v", 0.5).groupBy("state").agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT l_orderkey, l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey) * CASE WHEN l_orderkey % 13 = 0 THEN 1.01 ELSE 1 END - CASE WHEN l_orderkey % 17 = 0 AND l_linenumber = 1 THEN 2 ELSE 0 END AS share FROM lineitem)
SELECT l_orderkey, round(sum(share), 6) AS total, count(*) FILTER (WHERE share < 0) AS n_negative, abs(sum(share) - 1) <= 1e-5 AND count(*) FILTER (WHERE share < 0) = 0 AS closed FROM s GROUP BY 1""")
def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of each order's lines, spoilt in some orders, against a sum of one."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    whole = line.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("_t"))
    key = F.col("l_orderkey")
    share = F.col("l_quantity") / F.col("_t") * F.when(key % 13 == 0, 1.01).otherwise(1.0) - F.when((key % 17 == 0) & (F.col("l_linenumber") == 1), 2.0).otherwise(0.0)
    return V.coverage_check(line.join(whole, "l_orderkey"), ["l_orderkey"], share, 1e-5).withColumn("total", F.round("total", 6))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_retailprice < 1200 THEN 1200.0 ELSE p_retailprice END AS raised FROM part""")
def floor_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.raised_to(F.col("p_retailprice"), F.col("p_size") % 3 == 0, 1200.0).alias("raised"))


@query("""
WITH y AS (SELECT CAST(extract(year FROM l_shipdate) AS INTEGER) AS year, l_suppkey AS outlet, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY q DESC, outlet) AS rank, sum(q) OVER (PARTITION BY year) AS total, sum(n) OVER (PARTITION BY year) AS cells FROM y)
SELECT year, rank, outlet, round(q, 2) AS q, round(total, 2) AS total, CAST(cells AS BIGINT) AS cells FROM r WHERE rank <= 12""")
def yearly_outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year's total and its twelve largest outlets (a top-k report)."""
    y = table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year"), F.col("l_suppkey").alias("outlet")).agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n"))
    totals = y.groupBy("year").agg(F.sum("q").alias("total"), F.sum("n").alias("cells"))
    rank = F.row_number().over(Window.partitionBy("year").orderBy(F.desc("q"), "outlet"))
    return y.withColumn("rank", rank).where("rank <= 12").join(totals, "year").select("year", "rank", "outlet", F.round("q", 2).alias("q"), F.round("total", 2).alias("total"), "cells")
