"""Queries of rules, records, inventories and sets on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.functions import rules as T
from fluvion.operators import records as K
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'large' WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'rest' END AS category FROM orders")
def rule_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    category = T.ordered_rules([((status == "F") & (price > 200000), "large"), (status == "F", "done"), (F.col("o_orderpriority").startswith("1"), "urgent")], "rest")
    return table(spark, sf_dir, "orders").select("o_orderkey", category.alias("category"))


@query("SELECT c_custkey, concat_ws('; ', CASE WHEN c_acctbal < 0 THEN 'negative' END, CASE WHEN c_acctbal > 9000 THEN 'large' END, CASE WHEN c_nationkey < 5 THEN 'near' END) AS flags FROM customer")
def plausibility_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select("c_custkey", T.flags({"negative": balance < 0, "large": balance > 9000, "near": F.col("c_nationkey") < 5}).alias("flags"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name FROM part")
def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.normal_name(F.col("p_name")).alias("name"))


@query(r"""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, len(regexp_extract_all(url, '/[^/]+')) AS depth, CASE WHEN url LIKE '%.html' THEN 'page' WHEN regexp_matches(url, '[0-9]{4}') THEN 'dated' ELSE 'other' END AS kind FROM pages""")
def classify_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    kind = T.ordered_rules([(url.endswith(".html"), "page"), (url.rlike("[0-9]{4}"), "dated")], "other")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(url, "^https?://([^/]+)", 1).alias("host"), F.size(F.regexp_extract_all(url, F.lit("(/[^/]+)"), F.lit(1))).cast("long").alias("depth"), kind.alias("kind"))


@query("""
WITH l AS (SELECT doc_id, row_number() OVER () AS z, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, i, CASE WHEN line LIKE '%token%' OR line LIKE '%password%' THEN 'secret' WHEN regexp_matches(line, '[0-9]{4}') THEN 'number' END AS kind FROM l)
SELECT kind, count(*) AS n, min(doc_id) AS first_doc FROM c WHERE kind IS NOT NULL GROUP BY 1""")
def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line categories with counts and the first document of each."""
    lines = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    line = F.col("line")
    kind = F.when(line.contains("token") | line.contains("password"), "secret").when(line.rlike("[0-9]{4}"), "number")
    return lines.select("doc_id", kind.alias("kind")).where("kind is not null").groupBy("kind").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, sha256('{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}') AS fingerprint FROM events")
def json_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k long")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"), K.fingerprint(["user_id", "event_type"]).alias("fingerprint"))


@query("""
SELECT lang, source, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS bytes, min(n_chars) AS smallest, max(n_chars) AS largest, min(doc_id) AS oldest, max(doc_id) AS newest, CAST(grouping(lang, source) AS BIGINT) AS level FROM documents GROUP BY ROLLUP (lang, source)""")
def inventory_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.inventory(table(spark, sf_dir, "documents"), ["lang", "source"], "n_chars", "doc_id")


@query("""
WITH f AS (SELECT c_mktsegment AS grp, c_acctbal AS a, unnest(['negative', 'large', 'far']) AS rule, unnest([c_acctbal < 0, c_acctbal > 9000, c_nationkey > 20]) AS removed FROM customer)
SELECT grp AS c_mktsegment, rule, removed, count(*) AS n, round(sum(a), 2) AS amount FROM f GROUP BY 1, 2, 3""")
def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    out = K.rule_table(table(spark, sf_dir, "customer"), {"negative": balance < 0, "large": balance > 9000, "far": F.col("c_nationkey") > 20}, "c_acctbal", "c_mktsegment")
    return out.withColumn("amount", F.round("amount", 2))


@query("""
SELECT o_custkey, CASE max(CASE WHEN o_orderstatus = 'F' AND o_totalprice > 400000 THEN 3 WHEN o_orderstatus = 'O' THEN 2 WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END)
  WHEN 3 THEN 'failed' WHEN 2 THEN 'not_checked' WHEN 1 THEN 'warning' ELSE 'passed' END AS verdict FROM orders GROUP BY 1""")
def qc_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000), "failed").when(F.col("o_orderstatus") == "O", "missing").when(F.col("o_orderpriority").startswith("1"), "warning").otherwise("passed")
    return K.combine_status(o.select("o_custkey", status.alias("status")), ["o_custkey"], "status")


@query("""
WITH y AS (SELECT o_custkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1, 2), n AS (SELECT o_custkey, year, n * 10 AS n FROM y WHERE year >= 1999 AND o_custkey % 2 = 0)
SELECT o_custkey, year, n FROM y WHERE (o_custkey, year) NOT IN (SELECT (o_custkey, year) FROM n) UNION ALL SELECT * FROM n""")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return K.upsert(y, y.where("year >= 1999 and o_custkey % 2 = 0").withColumn("n", F.col("n") * 10), ["o_custkey", "year"])


@query("""
WITH w AS (SELECT c_custkey, CAST(year AS INTEGER) AS year FROM customer, range(1995, 2002) t(year)) SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND extract(year FROM o_orderdate) = year)""")
def years_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"))
    present = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
    return K.missing_keys(wanted, present, ["c_custkey", "year"])


@query("""
WITH d AS (SELECT DISTINCT c_nationkey, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS day FROM orders JOIN customer ON o_custkey = c_custkey), g AS (SELECT *, day - row_number() OVER (PARTITION BY c_nationkey ORDER BY day) AS run FROM d)
SELECT c_nationkey, CAST(min(day) AS INTEGER) AS first, CAST(max(day) AS INTEGER) AS last, count(*) AS length FROM g GROUP BY c_nationkey, run""")
def contiguous_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    days = table(spark, sf_dir, "orders").join(customer, "o_custkey").select("c_nationkey", F.unix_date(F.to_date("o_orderdate")).alias("day"))
    return K.contiguous_runs(days, ["c_nationkey"], "day")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem)
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_discount IS NULL) AS n_missing, count(*) FILTER (WHERE l_extendedprice = 0) AS n_zero, count(*) FILTER (WHERE l_extendedprice < 0) AS n_negative,
  min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest, min(l_orderkey) FILTER (WHERE r = 1) AS at_l_orderkey, min(l_linenumber) FILTER (WHERE r = 1) AS at_l_linenumber FROM r GROUP BY 1""")
def value_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.value_profile(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", ["l_orderkey", "l_linenumber"])


@query("""
WITH s AS (SELECT c_nationkey, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT n_name, round(v, 2) AS v, row_number() OVER (ORDER BY v DESC, n_name) AS basin FROM s JOIN nation ON c_nationkey = n_nationkey QUALIFY basin <= 12""")
def top_outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve largest totals: a report, so the limit is the feature."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    s = table(spark, sf_dir, "orders").join(customer, "o_custkey").groupBy("n_nationkey").agg(F.sum("o_totalprice").alias("v")).join(table(spark, sf_dir, "nation"), "n_nationkey")
    top = s.orderBy(F.desc("v"), "n_name").limit(12)
    return top.select("n_name", F.round("v", 2).alias("v"), F.row_number().over(Window.orderBy(F.desc("v"), "n_name")).cast("long").alias("basin"))


@query("""
SELECT c_mktsegment, """ + ", ".join(f"round(sum(CASE WHEN n_regionkey = {r} THEN c_acctbal END), 2) AS region_{r}" for r in range(5)) + " FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def pivot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey").join(table(spark, sf_dir, "nation"), "n_nationkey")
    wide = c.groupBy("c_mktsegment").pivot("n_regionkey", list(range(5))).agg(F.round(F.sum("c_acctbal"), 2))
    return wide.select("c_mktsegment", *[F.col(str(r)).alias(f"region_{r}") for r in range(5)])


@query("""
WITH c AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS chunk, CASE WHEN event_type = 'purchase' THEN 'failed' ELSE 'completed' END AS status FROM events)
SELECT user_id, count(*) AS n_chunks, count(*) FILTER (WHERE status = 'completed') AS n_completed, CAST(min(CASE WHEN status <> 'completed' THEN chunk END) AS INTEGER) AS first_incomplete, min(CASE WHEN status <> 'completed' THEN chunk END) IS NULL AS complete FROM c GROUP BY 1""")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    status = F.when(F.col("event_type") == "purchase", "failed").otherwise("completed")
    return K.run_status(table(spark, sf_dir, "events").select("user_id", chunk.alias("chunk"), status.alias("status")), "user_id", "chunk", "status")


@query("""
SELECT user_id, event_id AS last_event, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.latest_attempts(table(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", F.col("event_id").alias("last_event"), "event_type")


@query("""
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O')
SELECT 'both' AS side, count(*) AS n FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'first', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'second', count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def set_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in both of two sets, or in one alone: one pass, as each key keeps two flags."""
    status = F.col("o_orderstatus")
    keys = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.bool_or(status == "F").alias("a"), F.bool_or(status == "O").alias("b"))
    sides = {"both": F.col("a") & F.col("b"), "first": F.col("a") & ~F.col("b"), "second": F.col("b") & ~F.col("a")}
    counted = keys.agg(F.array(*[F.struct(F.lit(n).alias("side"), F.count_if(c).alias("n")) for n, c in sides.items()]).alias("s"))
    return counted.select(F.inline("s"))


@query("""
WITH p AS (SELECT l_orderkey, l_partkey % 10 AS k, CAST(bool_or(l_returnflag = 'R') AS BOOLEAN) AS returned, count(*) AS n, left(string_agg(DISTINCT l_linestatus || l_returnflag, ', ' ORDER BY l_linestatus || l_returnflag), 80) AS names FROM lineitem GROUP BY 1, 2)
SELECT * FROM p""")
def purpose_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.left(F.array_join(F.array_sort(F.collect_set(F.concat("l_linestatus", "l_returnflag"))), ", "), F.lit(80))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", (F.col("l_partkey") % 10).alias("k")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.count("*").alias("n"), names.alias("names"))


@query("""
WITH k AS (SELECT least(count(*), 12) AS n FROM orders GROUP BY o_custkey), c AS (SELECT n, count(*) AS m FROM k GROUP BY 1) SELECT b AS n_orders, coalesce(m, 0) AS n_customers FROM range(1, 13) t(b) LEFT JOIN c ON c.n = b""")
def pooled_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by number of orders, 12 and more pooled, empty bins kept."""
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.least(F.count("*"), F.lit(12)).alias("n_orders")).groupBy("n_orders").agg(F.count("*").alias("m"))
    bins = spark.range(1, 13).select(F.col("id").alias("n_orders"))
    return bins.join(n, "n_orders", "left").select("n_orders", F.coalesce("m", F.lit(0)).alias("n_customers"))
