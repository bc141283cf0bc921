"""Queries of campaigns, rules and registers on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.functions import rules as T
from fluvion.operators import campaign as C
from fluvion.operators import graph as G
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()


@query("""
WITH e AS (SELECT c_custkey, 'spinup=' || c_nationkey % 3 AS a, CASE WHEN c_custkey % 4 <> 1 THEN 'historical=' || c_nationkey END AS b, CASE WHEN c_custkey % 6 <> 2 THEN 'future=' || c_mktsegment END AS c FROM customer),
s AS (SELECT c_custkey, a AS segment, NULL AS parent, 'spinup' AS period FROM e UNION ALL SELECT c_custkey, concat_ws('/', a, b), a, 'historical' FROM e WHERE b IS NOT NULL UNION ALL SELECT c_custkey, concat_ws('/', a, b, c), concat_ws('/', a, b), 'future' FROM e WHERE c IS NOT NULL)
SELECT segment, parent, period, count(DISTINCT c_custkey) AS n_experiments FROM s GROUP BY 1, 2, 3""")
def campaign_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as experiments of three periods; some skip the second or the third."""
    key = F.col("c_custkey")
    e = table(spark, sf_dir, "customer").select(key, (F.col("c_nationkey") % 3).cast("string").alias("spinup"), F.when(key % 4 != 1, F.col("c_nationkey").cast("string")).alias("historical"), F.when(key % 6 != 2, F.col("c_mktsegment")).alias("future"))
    return C.segments(e, "c_custkey", ["spinup", "historical", "future"])


RUNS = "SELECT c_custkey AS run, CASE WHEN c_custkey > 4 THEN (c_custkey - 1) // 3 END AS parent, 10 + c_custkey % 90 AS years, (c_custkey % 3) AS priority FROM customer"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("run"), F.when(key > 4, F.floor((key - 1) / 3)).alias("parent"), (10 + key % 90).alias("years"), (key % 3).alias("priority"))


@query(f"""
WITH RECURSIVE r AS ({RUNS}), w(seed, node, up, total) AS (SELECT run, run, parent, CAST(years AS DOUBLE) FROM r UNION ALL SELECT seed, r.run, r.parent, total + r.years FROM w JOIN r ON w.up = r.run)
SELECT node AS run, max(total) AS "left" FROM w GROUP BY 1""")
def years_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.years_left(runs(spark, sf_dir), "run", "parent", "years")


@query()
def run_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities are those of the first ancestor, so parents never come after their children; tested against the plain rule."""
    r = runs(spark, sf_dir)
    roots = G.outlets(r.select(F.col("run").alias("cell_id"), F.col("parent").alias("next_id")))
    first = roots.select(F.col("node").alias("run"), (F.col("outlet") % 3).alias("priority"))
    return C.run_order(r.drop("priority").join(first, "run"), "run", "parent", "years", "priority")


@query("""
WITH b AS (SELECT o_custkey AS segment, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS block, o_orderstatus <> 'P' AS completed, CASE o_orderpriority[1] WHEN '1' THEN 'passed' WHEN '2' THEN 'failed' WHEN '3' THEN 'not_checked' WHEN '4' THEN 'failed' END AS test FROM orders),
l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY segment ORDER BY block DESC) = 1), f AS (SELECT c_custkey AS segment, block, completed, test FROM customer LEFT JOIN l ON segment = c_custkey AND c_custkey % 9 <> 0),
a AS (SELECT *, CASE WHEN block IS NULL THEN 'render' WHEN NOT completed THEN 'wait' WHEN test IS NULL OR test = 'not_checked' THEN 'wait' WHEN test = 'passed' THEN 'converged' WHEN block + 1 > 10 THEN 'stop' ELSE 'render' END AS action FROM f)
SELECT segment, action, CASE WHEN action = 'render' THEN coalesce(block + 1, 1) ELSE block END AS block FROM a""")
def spinup_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as spin-ups, their orders as blocks; every ninth has none."""
    o = table(spark, sf_dir, "orders")
    first = F.substring("o_orderpriority", 1, 1)
    test = F.when(first == "1", "passed").when(first.isin("2", "4"), "failed").when(first == "3", "not_checked")
    b = o.select(F.col("o_custkey").alias("segment"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long").alias("block"), (F.col("o_orderstatus") != "P").alias("completed"), test.alias("test"))
    every = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("segment"))
    return C.spinup_next(every.join(b.where("segment % 9 <> 0"), "segment", "left"), "segment", "block", "completed", "test", 10)


@query("""
WITH p AS (SELECT p_partkey, p_retailprice AS a, p_retailprice * (1 + p_size % 5) AS b, CASE p_size % 6 WHEN 0 THEN ' Yes' WHEN 1 THEN 'enlarged' WHEN 2 THEN 'no' END AS lake, CASE WHEN p_size % 4 > 0 THEN p_size % 4 * 10.0 END AS area, p_size * 3.0 AS height FROM part),
f AS (SELECT *, coalesce(area > 0 AND height > 0 AND a / area BETWEEN 0.05 * height AND height, false) AS ok_a, coalesce(area > 0 AND height > 0 AND b / area BETWEEN 0.05 * height AND height, false) AS ok_b FROM p)
SELECT p_partkey, CASE WHEN lower(trim(lake)) IN ('yes', 'enlarged') THEN 'second:C1' WHEN ok_b AND NOT ok_a THEN 'second:C2' WHEN ok_a AND NOT ok_b THEN 'first:C2' ELSE 'first:C3' END AS capacity,
  CASE WHEN p_partkey % 10 / 4.0 <= 1.5 THEN 'second:L1' WHEN p_partkey % 7 / 2.0 <= 1.5 THEN 'first:L2' ELSE 'second:L3' END AS location FROM f""")
def register_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of two registers' capacities and locations to take, and by which rule."""
    size, key = F.col("p_size"), F.col("p_partkey")
    lake = F.when(size % 6 == 0, " Yes").when(size % 6 == 1, "enlarged").when(size % 6 == 2, "no")
    capacity = T.capacity_choice(F.col("p_retailprice"), F.col("p_retailprice") * (1 + size % 5), lake, F.when(size % 4 > 0, size % 4 * 10.0), size * 3.0)
    return table(spark, sf_dir, "part").select(key, capacity.alias("capacity"), T.location_choice(key % 7 / 2.0, key % 10 / 4.0).alias("location"))


@query("""
WITH p AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'Irrigation, flood' WHEN 1 THEN ' NaN ' WHEN 2 THEN 'Hydropower' WHEN 3 THEN '' END AS a, CASE p_partkey % 4 WHEN 0 THEN 'main WATER SUPPLY' WHEN 1 THEN 'unknown' WHEN 2 THEN 'recreation' END AS b FROM part),
f AS (SELECT *, coalesce(lower(trim(a)) NOT IN ('', 'na', 'nan', 'none'), false) AS fa, coalesce(lower(trim(b)) NOT IN ('', 'na', 'nan', 'none'), false) AS fb FROM p)
SELECT p_partkey, CASE WHEN (fa AND regexp_matches(lower(a), 'irrigation|water supply')) OR (fb AND regexp_matches(lower(b), 'irrigation|water supply')) THEN 'supply' WHEN fa OR fb THEN 'no_supply' ELSE 'unknown' END AS purpose FROM f""")
def purpose_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    a = F.when(size % 5 == 0, "Irrigation, flood").when(size % 5 == 1, " NaN ").when(size % 5 == 2, "Hydropower").when(size % 5 == 3, "")
    b = F.when(key % 4 == 0, "main WATER SUPPLY").when(key % 4 == 1, "unknown").when(key % 4 == 2, "recreation")
    return table(spark, sf_dir, "part").select(key, T.purpose([a, b]).alias("purpose"))


@query("""
WITH d AS (SELECT p_partkey, CAST(1800 + p_size * 5 AS INTEGER) AS y, p_partkey % 9 = 0 AS future FROM part)
SELECT p_partkey, CASE WHEN future THEN 9999 ELSE y END AS histsoc, CASE WHEN NOT future AND y <= 1850 THEN 0 ELSE 9999 END AS "1850soc", CASE WHEN future THEN 9999 ELSE 0 END AS "2021soc",
  CASE WHEN y BETWEEN 1800 AND 1850 THEN 'early' WHEN y BETWEEN 1851 AND 2000 THEN 'historical' END AS period FROM d""")
def scenario_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, future = (1800 + F.col("p_size") * 5).cast("int"), F.col("p_partkey") % 9 == 0
    period = T.period_of(year, [("early", 1800, 1850), ("historical", 1851, 2000)])
    return table(spark, sf_dir, "part").select("p_partkey", *[T.scenario_year(year, future, s).alias(s) for s in ("histsoc", "1850soc", "2021soc")], period.alias("period"))


@query(r"""
WITH f AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name, length(html) AS bytes FROM pages), k AS (SELECT *, NOT (regexp_matches(name, '^.*[13579]$') OR regexp_matches(name, '^a.*$')) OR regexp_matches(name, '^.*7$') AS kept FROM f)
SELECT CASE WHEN kept THEN 'kept' ELSE 'left out' END AS category, count(*) AS files, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM k GROUP BY 1""")
def selection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages kept by patterns of their last name: those excluded are kept if they are included all the same."""
    name = F.regexp_extract("url", "([^/]*)$", 1)
    kept = T.selected(name, ["*7"], ["*[13579]", "a*"])
    return table(spark, sf_dir, "pages").groupBy(F.when(kept, "kept").otherwise("left out").alias("category")).agg(F.count("*").alias("files"), F.coalesce(F.sum(F.char_length("html")), F.lit(0)).cast("long").alias("bytes"))
