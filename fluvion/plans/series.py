"""Queries of series, runs and field comparisons on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.functions import physics as P
from fluvion.functions import rules as T
from fluvion.operators import grid as G
from fluvion.operators import series as S
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()


def _r(df: DataFrame, **digits: int) -> DataFrame:
    for c, d in digits.items():
        df = df.withColumn(c, F.round(c, d))
    return df


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity AS v FROM lineitem WHERE l_linenumber <> 6), b AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity * CASE WHEN l_suppkey % 3 = 0 THEN 1.2 ELSE 1 END AS v FROM lineitem WHERE l_linenumber <> 7)
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE a.v IS NULL OR b.v IS NULL) AS n_one_side, round(avg(a.v), 6) AS mean_old, round(avg(b.v), 6) AS mean_new, round((avg(b.v) - avg(a.v)) / avg(a.v), 6) AS relative_change,
  round(avg(CASE WHEN abs(b.v - a.v) > 0.5 THEN 1.0 WHEN abs(b.v - a.v) IS NOT NULL THEN 0.0 END), 6) AS share_changed, round(max(abs(b.v - a.v)), 6) AS max_change, round(max(abs(b.v - a.v) / abs(a.v)), 6) AS max_relative FROM a FULL JOIN b USING (l_orderkey, l_linenumber, l_returnflag) GROUP BY 1""")
def field_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey", F.col("l_quantity").alias("v"))
    new = line.where("l_linenumber <> 7").withColumn("v", F.col("v") * F.when(F.col("l_suppkey") % 3 == 0, 1.2).otherwise(1.0))
    out = S.field_differences(line.where("l_linenumber <> 6"), new, ["l_orderkey", "l_linenumber"], ["l_returnflag"], "v", 0.5)
    return _r(out, mean_old=6, mean_new=6, relative_change=6, share_changed=6, max_change=6, max_relative=6)


@query("SELECT event_type, count(value) AS n, count(*) FILTER (WHERE abs(value - 50) > 40) AS beyond_40, count(*) FILTER (WHERE abs(value - 50) > 100) AS beyond_100, round(max(abs(value - 50)), 6) AS largest FROM events GROUP BY 1")
def limits_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", (F.col("value") - 50).alias("v"))
    return _r(S.limits_scan(e, ["event_type"], "v", [40, 100]), largest=6)


@query("""
WITH y AS (SELECT l_suppkey AS cell, s_nationkey % 5 AS box, CAST(extract(year FROM l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2, 3),
d AS (SELECT *, v - lag(v) OVER (PARTITION BY cell ORDER BY year) AS d FROM y), c AS (SELECT cell, box, arg_max(v, year) - arg_min(v, year) AS change, count(d) > 0 AND coalesce(bool_and(d > 0.5) FILTER (WHERE d IS NOT NULL), true) AS up, count(d) > 0 AND coalesce(bool_and(d < -0.5) FILTER (WHERE d IS NOT NULL), true) AS down FROM d GROUP BY 1, 2)
SELECT box, count(*) AS n_cells, round(sum(change), 4) AS change, round(avg(abs(change)), 4) AS mean_size, count(*) FILTER (WHERE up) AS n_rising, count(*) FILTER (WHERE down) AS n_falling FROM c GROUP BY 1""")
def store_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") % 5).alias("box"))
    y = table(spark, sf_dir, "lineitem").where("l_shipdate < timestamp '1998-01-01'").join(s, "l_suppkey").groupBy(F.col("l_suppkey").alias("cell"), "box", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("v"))
    return _r(S.store_drift(y, ["cell"], "year", "v", [F.col("box")], 0.5), change=4, mean_size=4)


@query("""
WITH m AS (SELECT o_custkey % 40 AS series, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, CASE WHEN o_custkey % 40 < 5 THEN 7.0 ELSE sum(o_totalprice) END AS one, CASE WHEN o_custkey % 40 < 5 THEN 7.0 ELSE sum(o_totalprice) END + CASE WHEN o_custkey % 40 > 30 AND extract(year FROM o_orderdate) > 1997 THEN 1 ELSE 0 END AS two FROM orders GROUP BY o_custkey % 40, extract(year FROM o_orderdate))
SELECT series, max(one) - min(one) <= 1e-9 AS constant, count(*) FILTER (WHERE abs(one - two) > 1e-9) = 0 AS equal, min(CASE WHEN abs(one - two) > 1e-9 THEN year END) AS first_differing, count(*) FILTER (WHERE one > 0) AS n_positive FROM m GROUP BY 1""")
def series_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_custkey") % 40
    m = table(spark, sf_dir, "orders").groupBy(k.alias("series"), F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("_t"))
    m = m.withColumn("one", F.when(F.col("series") < 5, 7.0).otherwise(F.col("_t"))).withColumn("two", F.col("one") + F.when((F.col("series") > 30) & (F.col("year") > 1997), 1).otherwise(0))
    return S.series_facts(m, ["series"], "year", "one", "two")


@query("""
WITH m AS (SELECT o_custkey % 20 AS series, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS h, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS s FROM orders GROUP BY 1, 2), a AS (SELECT * FROM m WHERE year = 1998)
SELECT m.series, m.year, round(m.s * a.h / nullif(a.s, 0), 2) AS by_ratio, round(CASE WHEN a.h IS NOT NULL AND a.s IS NOT NULL THEN greatest(coalesce(m.s + a.h - a.s, 0), 0) END, 2) AS by_difference FROM m LEFT JOIN a USING (series)""")
def joined_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    m = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 20).alias("series"), F.year("o_orderdate").alias("year")).agg(F.sum(F.when(status == "F", price).otherwise(0.0)).alias("h"), F.sum(F.when(status == "O", price)).alias("s"))
    return _r(S.joined_series(m, ["series"], "year", "h", "s", 1998).drop("h", "s"), by_ratio=2, by_difference=2)


@query("""
SELECT c_nationkey AS parent, count(*) AS n_active, round(sum(greatest(c_acctbal, 0)), 4) AS total, round(avg(CASE WHEN greatest(c_acctbal, 0) = 0 THEN 1.0 ELSE 0 END), 6) AS zero_share, round(max(greatest(c_acctbal, 0)) / nullif(sum(greatest(c_acctbal, 0)), 0), 6) AS largest_share FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1""")
def inside_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("parent"), F.greatest("c_acctbal", F.lit(0.0)).alias("v"), (F.col("c_mktsegment") != "FURNITURE").alias("active"))
    return _r(S.inside_parents(c, "parent", "v", "active"), total=4, zero_share=6, largest_share=6)


@query("""
WITH h AS (SELECT CAST(greatest(least(floor((value + 20) / 15), 59), 0) AS INTEGER) AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1) SELECT CAST(b AS INTEGER) AS bin, (-20.0 + b * 15.0)::DOUBLE AS low_edge, coalesce(n, 0) AS n FROM range(60) t(b) LEFT JOIN h ON b = bin""")
def full_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.full_histogram(table(spark, sf_dir, "events"), F.col("value"), -20.0, 15.0, 60)


@query("""
WITH c AS (SELECT c_custkey, c_acctbal AS one, c_acctbal * CASE WHEN c_custkey % 3 = 0 THEN 1.01 ELSE 1 END AS two, c_nationkey < 5 AS near, c_mktsegment = 'BUILDING' AS used FROM customer)
SELECT c_custkey, coalesce(abs(one - two) > 0.1 + 0.001 * abs(two), false) AS differs, concat_ws('+', CASE WHEN used THEN 'used' END, CASE WHEN near THEN 'near' END) AS reasons, CASE WHEN used THEN 'used' WHEN near THEN 'near' ELSE 'far' END AS "group" FROM c""")
def differing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.col("c_acctbal").alias("one"), (F.col("c_acctbal") * F.when(F.col("c_custkey") % 3 == 0, 1.01).otherwise(1.0)).alias("two"))
    out = S.differing_cells(c, "one", "two", {"used": F.col("c_mktsegment") == "BUILDING", "near": F.col("c_nationkey") < 5}, 0.1, 0.001)
    return out.select("c_custkey", "differs", "reasons", "group")


@query("""
WITH d AS (SELECT user_id % 50 AS dam, CAST(ts AS DATE) AS day, event_type <> 'view' AS operating, value AS inflow, value * 0.9 AS outflow, value + user_id AS storage, event_id FROM events),
o AS (SELECT dam, day, bool_or(operating) AS operating, sum(inflow) AS inflow, sum(outflow) AS outflow, max(storage) AS storage FROM d GROUP BY 1, 2)
SELECT dam, count(*) FILTER (WHERE operating) AS operating_days, count(DISTINCT CASE WHEN operating THEN date_trunc('month', day) END) AS operating_months, min(day) FILTER (WHERE operating) AS first_day, round(sum(inflow) FILTER (WHERE operating) / nullif(sum(outflow) FILTER (WHERE operating), 0), 6) AS in_over_out,
  round(min(storage) FILTER (WHERE operating), 4) AS least, round(max(storage) FILTER (WHERE operating), 4) AS most, round(arg_max(storage, day) FILTER (WHERE operating), 4) AS last FROM o GROUP BY 1""")
def operation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(S.operation_table(dam_days(spark, sf_dir), ["dam"], "day", "operating", "inflow", "outflow", "storage"), in_over_out=6, least=4, most=4, last=4)


def dam_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy((F.col("user_id") % 50).alias("dam"), F.to_date("ts").alias("day")).agg(
        F.bool_or(F.col("event_type") != "view").alias("operating"), F.sum("value").alias("inflow"), F.sum(F.col("value") * 0.9).alias("outflow"), F.max(F.col("value") + F.col("user_id")).alias("storage")
    )


@query("""
WITH o AS (SELECT user_id % 50 AS dam, CAST(ts AS DATE) AS day, sum(value) AS inflow, sum(value * 0.9) AS outflow, max(value + user_id) AS storage FROM events GROUP BY 1, 2),
p AS (SELECT *, lag(storage) OVER (PARTITION BY dam ORDER BY day) AS before, lag(day) OVER (PARTITION BY dam ORDER BY day) AS last FROM o), e AS (SELECT dam, CASE WHEN day - last = 1 THEN abs(storage - before - inflow + outflow) END AS e FROM p)
SELECT dam, count(e) AS n_pairs, round(max(e), 4) AS worst_error FROM e GROUP BY 1""")
def storage_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(S.storage_balance(dam_days(spark, sf_dir), ["dam"], "day", "storage", "inflow", "outflow"), worst_error=4)


@query("""
WITH m AS (SELECT o_custkey % 30 AS dam, date_trunc('month', o_orderdate) AS month, avg(o_totalprice) - 150000 AS v FROM orders GROUP BY 1, 2) SELECT dam, count(*) FILTER (WHERE v > 0) AS n_positive, round(stddev_samp(v) FILTER (WHERE v > 0) / avg(v) FILTER (WHERE v > 0), 6) AS variation FROM m GROUP BY 1""")
def seasonal_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 30).alias("dam"), F.date_trunc("month", "o_orderdate").alias("month")).agg((F.avg("o_totalprice") - 150000).alias("v"))
    return _r(S.seasonal_variation(m, ["dam"], "v"), variation=6)


@query("""
SELECT p_partkey, concat_ws(' ', CASE WHEN p_size / 10.0 >= 2 THEN 'two' END, CASE WHEN p_retailprice / 700 >= 2 THEN 'one' END, CASE WHEN p_partkey % 5 >= 2 THEN 'half' END) AS flags FROM part""")
def signal_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = S.signal_flags({"two": F.col("p_size") / 10.0, "one": F.col("p_retailprice") / 700, "half": F.col("p_partkey") % 5}, 2)
    return table(spark, sf_dir, "part").select("p_partkey", flags.alias("flags"))


@query("""
SELECT l_suppkey AS cell, 'mean' AS slice, round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT l_suppkey, 'layer=' || l_linenumber, round(avg(l_quantity), 6), count(*) FROM lineitem GROUP BY l_suppkey, l_linenumber
UNION ALL SELECT l_suppkey, 'layer=' || l_linenumber || ',class=' || l_returnflag, round(avg(l_quantity), 6), count(*) FROM lineitem GROUP BY l_suppkey, l_linenumber, l_returnflag""")
def slice_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_linenumber").alias("layer"), F.col("l_returnflag").alias("class"), F.col("l_quantity").alias("v"))
    return _r(S.slice_means(line, ["cell"], [[], ["layer"], ["layer", "class"]], "v"), mean=6)


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, sum(l_quantity / 50) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS d, l_quantity / 50 AS h FROM lineitem), c AS (SELECT *, 1 - 0.5 * (exp(-6.0 * d) + exp(-2.0 * d)) - (1 - 0.5 * (exp(-6.0 * (d - h)) + exp(-2.0 * (d - h)))) AS part FROM l),
f AS (SELECT *, part / sum(part) OVER (PARTITION BY l_orderkey) AS own FROM c) SELECT l_orderkey, count(*) AS n, max(abs(own - CAST(own AS FLOAT))) < 1e-6 AS reproduced, abs(sum(own) - 1) < 1e-9 AS closed FROM f GROUP BY 1""")
def root_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root fractions made again layer by layer, against those stored in single precision."""
    own = Window.partitionBy("l_orderkey")
    h = F.col("l_quantity") / 50
    depth = table(spark, sf_dir, "lineitem").select("l_orderkey", h.alias("h"), F.sum(h).over(own.orderBy("l_linenumber")).alias("d"))
    y = lambda d: P.cumulative_roots(d, F.lit(6.0), F.lit(2.0))
    part = depth.withColumn("part", y(F.col("d")) - y(F.col("d") - F.col("h")))
    made = part.withColumn("own", F.col("part") / F.sum("part").over(own)).withColumn("stored", F.col("own").cast("float"))
    return made.groupBy("l_orderkey").agg(F.count("*").alias("n"), (F.max(F.abs(F.col("own") - F.col("stored"))) < 1e-6).alias("reproduced"), (F.abs(F.sum("own") - 1) < 1e-9).alias("closed"))


@query("""
WITH r AS (SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, o_orderpriority AS experiment, count(*) AS runs, sum(o_totalprice) / 100000 AS hours, sum(o_totalprice) / 5e6 AS tb FROM orders GROUP BY 1, 2), y AS (SELECT year, sum(runs) AS runs, sum(hours) AS hours, sum(tb) AS tb FROM r GROUP BY 1)
SELECT year, CAST(runs AS BIGINT) AS runs, round(hours, 4) AS hours, round(hours / runs, 6) AS hours_a_run, round(sum(tb) OVER (ORDER BY year), 4) AS stored_tb FROM y""")
def demand_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node hours of each model year and the storage filled by then; one row a year, so the running sum is over years alone."""
    o = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("runs"), (F.sum("o_totalprice") / 100000).alias("hours"), (F.sum("o_totalprice") / 5e6).alias("tb"))
    return o.select("year", "runs", F.round("hours", 4).alias("hours"), F.round(F.col("hours") / F.col("runs"), 6).alias("hours_a_run"), F.round(F.sum("tb").over(Window.orderBy("year")), 4).alias("stored_tb"))


@query("""
WITH y AS (SELECT l_suppkey AS station, CAST(extract(year FROM l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS one, avg(l_quantity * (1 - l_tax)) AS two, avg(l_quantity * (1 - l_discount)) AS obs FROM lineitem GROUP BY 1, 2)
SELECT year, count(*) AS n, count(*) FILTER (WHERE abs(two - obs) < abs(one - obs) - 1e-9) AS improved, count(*) FILTER (WHERE abs(two - obs) > abs(one - obs) + 1e-9) AS worsened, round(avg(two - one), 6) AS mean_change FROM y GROUP BY 1""")
def improved_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations that come nearer to what was observed from one run to the next, and those that go away from it, year by year."""
    q = F.col("l_quantity")
    y = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.avg(q).alias("one"), F.avg(q * (1 - F.col("l_tax"))).alias("two"), F.avg(q * (1 - F.col("l_discount"))).alias("obs"))
    gain = F.abs(F.col("one") - F.col("obs")) - F.abs(F.col("two") - F.col("obs"))
    return y.groupBy("year").agg(F.count("*").alias("n"), F.count_if(gain > 1e-9).alias("improved"), F.count_if(gain < -1e-9).alias("worsened"), F.round(F.avg(F.col("two") - F.col("one")), 6).alias("mean_change"))


@query("""
WITH g AS (SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, p_size % 9 <> 0 AS active, p_retailprice AS v FROM part), s AS (SELECT r, c, v FROM g WHERE c % 7 <> 3)
SELECT g.r // 3 AS brow, g.c // 6 AS bcol, CAST(g.r % 3 * 6 + g.c % 6 AS INTEGER) AS place, round(coalesce(s.v, 0.0), 4) AS v FROM g LEFT JOIN s USING (r, c) WHERE active""")
def source_on_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source on the active cells, missing ones 0, as places in blocks of three rows and six columns."""
    key = F.col("p_partkey")
    g = table(spark, sf_dir, "part").select(F.floor(key / 50).alias("r"), (key % 50).alias("c"), (F.col("p_size") % 9 != 0).alias("active"), F.col("p_retailprice").alias("v"))
    held = G.on_active(g.where("c % 7 <> 3").select("r", "c", "v"), g.select("r", "c", "active"), ["r", "c"], "v", "active", fill=0.0, least=0.0)
    return G.blocks(held, "r", "c", 3, 6).select("brow", "bcol", "place", F.round("v", 4).alias("v"))


@query("""
WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'histsoc' WHEN 'O' THEN '2021soc' ELSE 'ssp' END AS scenario, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year FROM orders) SELECT o_orderkey, CASE scenario WHEN '2021soc' THEN 2021 ELSE year END AS source_year FROM o""")
def source_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own years in scenarios that have them, the constant field's year in the fixed one."""
    status = F.col("o_orderstatus")
    scenario = F.when(status == "F", "histsoc").when(status == "O", "2021soc").otherwise("ssp")
    year = T.source_year(scenario, F.year("o_orderdate"), {"histsoc": (1901, 2021), "2021soc": (2021, 2021), "ssp": (1990, 2100)}, ["2021soc"])
    return table(spark, sf_dir, "orders").select("o_orderkey", year.alias("source_year"))


@query("""
WITH p AS (SELECT DISTINCT s_nationkey AS r, s_suppkey % 50 AS c FROM supplier), g AS (SELECT l_partkey // 50 AS r, l_partkey % 50 AS c, date_trunc('month', l_shipdate) AS month, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3)
SELECT p.r, p.c, count(v) AS n_months, round(avg(v), 6) AS mean FROM p LEFT JOIN g USING (r, c) GROUP BY 1, 2""")
def values_at_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the monthly values at listed cells alone; months without a value do not count."""
    p = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("r"), (F.col("s_suppkey") % 50).alias("c")).distinct()
    g = table(spark, sf_dir, "lineitem").select(F.floor(F.col("l_partkey") / 50).alias("r"), (F.col("l_partkey") % 50).alias("c"), F.date_trunc("month", "l_shipdate").alias("month"), "l_quantity")
    monthly = g.join(p, ["r", "c"], "left_semi").groupBy("r", "c", "month").agg(F.avg("l_quantity").alias("v"))
    return p.join(monthly, ["r", "c"], "left").groupBy("r", "c").agg(F.count("v").alias("n_months"), F.round(F.avg("v"), 6).alias("mean"))


@query("""
WITH d AS (SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'manual' WHEN p_size % 3 = 0 THEN 'second' ELSE 'first' END AS choice, p_retailprice AS a, p_retailprice * 1.1 AS b, p_partkey % 4 = 1 AS future, p_partkey % 9 = 2 AS merged FROM part)
SELECT choice, count(*) AS n, count(*) FILTER (WHERE merged) AS n_merged, round(sum(CASE choice WHEN 'manual' THEN 100.0 WHEN 'second' THEN b ELSE a END), 4) AS expected FROM d WHERE NOT future GROUP BY ROLLUP (choice)""")
def expected_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capacity that historical items should add up to, by the source chosen for each, and over all."""
    size, key, price = F.col("p_size"), F.col("p_partkey"), F.col("p_retailprice")
    choice = F.when(size % 10 == 0, "manual").when(size % 3 == 0, "second").otherwise("first")
    d = table(spark, sf_dir, "part").where(key % 4 != 1).select(choice.alias("choice"), F.when(choice == "manual", 100.0).when(choice == "second", price * 1.1).otherwise(price).alias("v"), (key % 9 == 2).alias("merged"))
    return d.rollup("choice").agg(F.count("*").alias("n"), F.count_if("merged").alias("n_merged"), F.round(F.sum("v"), 4).alias("expected"))
