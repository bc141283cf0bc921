"""Queries of reports on the driver's tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.operators import reports as E
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()


@query("""
WITH d AS (SELECT c_mktsegment, abs(c_acctbal * CASE WHEN c_nationkey % 3 = 0 THEN 1.2 ELSE 1.01 END - c_acctbal) AS d FROM customer WHERE c_custkey % 5 <> 1)
SELECT c_mktsegment, count(*) AS n, round(quantile_cont(d, 0.5), 4) AS p50, round(quantile_cont(d, 0.9), 4) AS p90, round(max(d), 4) AS largest FROM d GROUP BY 1""")
def difference_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields on the customers as cells, the newer without every fifth."""
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", F.col("c_acctbal").alias("v"))
    new = old.where("c_custkey % 5 <> 1").withColumn("v", F.col("v") * F.when(F.col("c_nationkey") % 3 == 0, 1.2).otherwise(1.01))
    out = E.difference_quantiles(old, new, ["c_custkey"], ["c_mktsegment"], "v", {"p50": 0.5, "p90": 0.9, "largest": 1.0})
    return out.withColumns({c: F.round(c, 4) for c in ("p50", "p90", "largest")})


@query("""
WITH e AS (SELECT event_id, event_type, value - 50 AS v FROM events)
SELECT event_id, event_type, round(v, 6) AS v, CAST(CASE WHEN abs(v) > 100 THEN 100 ELSE 40 END AS DOUBLE) AS "limit", round(abs(v) / CASE WHEN abs(v) > 100 THEN 100 ELSE 40 END, 6) AS times FROM e WHERE abs(v) > 40""")
def beyond_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("value") - 50).alias("v"))
    return E.beyond_limits(e, ["event_id", "event_type"], "v", [40, 100]).withColumns({"v": F.round("v", 6), "times": F.round("times", 6)})


@query("""
WITH o AS (SELECT o_custkey AS run, o_orderpriority AS p, o_totalprice AS t, o_orderkey AS k FROM orders), l AS (SELECT run, CASE WHEN p LIKE '5%' THEN 'cost' ELSE replace(substr(p, 3), '-', 'x') END AS name, t, k FROM o WHERE k % 11 <> 0 AND p NOT LIKE '4%')
SELECT run, name, max(t) AS wall, CAST(CASE WHEN name = 'cost' THEN NULL ELSE arg_max(k, t) END AS DOUBLE) AS cpu FROM l GROUP BY 1, 2""")
def timing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timings out of log lines that are made of orders: table rows, labelled numbers, and lines of neither kind."""
    p, total, key = F.col("o_orderpriority"), F.col("o_totalprice").cast("string"), F.col("o_orderkey").cast("string")
    name = F.replace(F.substring(p, 3, 100), F.lit("-"), F.lit("x"))
    row = F.concat(F.lit("| "), name, F.lit("  | "), total, F.lit(" |"), key, F.lit(".0 |"))
    line = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("done "), row)).when(p.startswith("5"), F.concat(F.lit("Model Cost : "), total, F.lit(" pe-hrs"))).when(p.startswith("4"), "| no number |").otherwise(row)
    return E.timing_table(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), line.alias("line")), ["run"], "line", ["wall", "cpu"], {"cost": "Model Cost"})


@query("""
WITH v AS (SELECT n_regionkey AS r, n_nationkey % 10 AS c, CAST(count(*) AS DOUBLE) AS v FROM nation GROUP BY 1, 2) SELECT i // 10 AS r, i % 10 AS c, coalesce(v, -1) AS v FROM range(0, 60) t(i) LEFT JOIN v ON r = i // 10 AND c = i % 10""")
def full_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("long").alias("r"), (F.col("n_nationkey") % 10).cast("long").alias("c")).agg(F.count("*").cast("double").alias("v"))
    return E.full_grid(v, "r", "c", "v", 6, 10, -1.0)


@query("""
WITH g AS (SELECT c_custkey // 24 AS r, c_custkey % 24 AS c, (c_acctbal + 2000) * 9 AS z FROM customer), n AS (SELECT max(r) + 1 AS n FROM g), s AS (SELECT *, 80 - (r + 1) * (160.0::DOUBLE / n) AS low, 80 - r * (160.0::DOUBLE / n) AS high FROM g, n),
d AS (SELECT k, k * 20.0 - 80 AS low, k * 20.0 - 60 AS high FROM range(0, 8) t(k)), m AS (SELECT d.k AS to_row, s.c // 2 AS to_col, (sin(radians(least(s.high, d.high))) - sin(radians(greatest(s.low, d.low)))) AS w, z / 9.80665 AS h FROM s JOIN d ON s.low < d.high AND d.low < s.high)
SELECT to_row, to_col, round(sum(w * h) / sum(w), 4) AS height FROM m GROUP BY 1, 2""")
def surface_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Height from a geopotential whose rows run from north to south, on coarse rows that run north."""
    k = F.col("c_custkey")
    g = table(spark, sf_dir, "customer").select(F.floor(k / 24).alias("row"), (k % 24).alias("col"), ((F.col("c_acctbal") + 2000) * 9).alias("z"))
    n = g.agg(F.max("row")).first()[0] + 1
    i = F.col("id")
    south = spark.range(n).select("id", (80 - (i + 1) * (160.0 / n)).alias("low"), (80 - i * (160.0 / n)).alias("high"))
    axis = lambda count, low, size: spark.range(count).select("id", (i * size + low).alias("low"), ((i + 1) * size + low).alias("high"))
    return E.surface_height(g, "z", south, axis(24, 0.0, 15.0), axis(8, -80.0, 20.0), axis(12, 0.0, 30.0)).withColumn("height", F.round("height", 4))


@query("""
WITH s AS (SELECT p_size AS layer, p_partkey, 0.1 + p_size / 20.0::DOUBLE AS depth, 1100.0 + p_retailprice / 3 AS bulk, 2650.0 AS particle, 0.001 * (p_partkey % 9) AS d1, 0.0001 AS d2, 100.0 + p_partkey % 700 AS d3, 2.0 AS d4 FROM part),
m AS (SELECT *, 1 - bulk / particle AS porosity, depth * (1 - bulk / particle) * 1000 AS moist FROM s), a AS (SELECT *, d2 * power(moist - d3, d4) + d1 * moist AS dsmax FROM m),
r AS (SELECT layer, 'porosity' AS rule, count(*) FILTER (WHERE NOT (porosity > 0 AND porosity < 1)) AS n FROM a GROUP BY 1 UNION ALL SELECT layer, 'ds', count(*) FILTER (WHERE NOT coalesce(d1 * d3 / nullif(dsmax, 0) BETWEEN 0 AND 1, false)) FROM a GROUP BY 1 UNION ALL SELECT layer, 'ws', count(*) FILTER (WHERE NOT (d3 / moist BETWEEN 0 AND 1)) FROM a GROUP BY 1)
SELECT * FROM r""")
def soil_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soils that break the rules on porosity and base flow, by layer."""
    key = F.col("p_partkey")
    # Decimals, as in the SQL: where a flow share is 1 exactly, a product rounded in binary falls on either side.
    n = lambda text: F.lit(Decimal(text))
    c = E.soil_columns(0.1 + F.col("p_size") / 20.0, 1100.0 + F.col("p_retailprice") / 3, n("2650.0"), n("0.001") * (key % 9), n("0.0001"), n("100.0") + key % 700, n("2.0"))
    soils = table(spark, sf_dir, "part").select(F.col("p_size").alias("layer"), *[v.alias(k) for k, v in c.items()])
    rules = {"porosity": (F.col("porosity") > 0) & (F.col("porosity") < 1), "ds": F.col("ds").between(0, 1), "ws": F.col("ws").between(0, 1)}
    return E.soil_problems(soils, ["layer"], rules)
