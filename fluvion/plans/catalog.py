"""Queries of catalogues, registers, identities and bindings on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.functions import rules as T
from fluvion.operators import catalog as K
from fluvion.operators import checks as V
from fluvion.operators import polygons as Y
from fluvion.operators import records as R
from fluvion.plans.register import registry
from fluvion.session import table

QUERIES, ORACLES, query = registry()


@query("""
WITH f AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'tas' WHEN 1 THEN 'pr' WHEN 2 THEN 'ps' ELSE 'huss' END AS variable, 1901 + p_partkey % 90 AS a, 1901 + p_partkey % 90 + p_size % 4 AS b FROM part WHERE p_partkey % 7 <> 0),
y AS (SELECT variable, unnest(range(a, b + 1)) AS year, 'x_' || variable || '_' || a || '_' || b || '.nc' AS name FROM f), g AS (SELECT variable, year, count(*) AS n, min(name) AS name FROM y GROUP BY 1, 2),
w AS (SELECT v AS variable, CAST(y AS INTEGER) AS year FROM (VALUES ('tas'), ('pr'), ('ps'), ('huss'), ('rsds')) a(v), range(1895, 2000) b(y)) SELECT w.variable, w.year, coalesce(n, 0) AS n_files, CASE WHEN n = 1 THEN name END AS file FROM w LEFT JOIN g USING (variable, year)""")
def file_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    variable = F.when(key % 4 == 0, "tas").when(key % 4 == 1, "pr").when(key % 4 == 2, "ps").otherwise("huss")
    first = 1901 + key % 90
    names = table(spark, sf_dir, "part").select(F.when(key % 7 == 0, F.concat(F.lit("x_"), variable, F.lit(".nc"))).otherwise(F.concat(F.lit("x_"), variable, F.lit("_"), first, F.lit("_"), first + F.col("p_size") % 4, F.lit(".nc"))).alias("name"))
    wanted = spark.range(1895, 2000).select(F.col("id").cast("int").alias("year"), F.explode(F.array(*map(F.lit, ("tas", "pr", "ps", "huss", "rsds")))).alias("variable"))
    return K.file_of_year(names, "name", wanted, "variable", "year")


@query("""
WITH r AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '-99' WHEN 1 THEN 'n/a' WHEN 2 THEN '-3.5' ELSE CAST(p_retailprice AS VARCHAR) END AS cap, CASE p_size % 3 WHEN 0 THEN '-99' ELSE CAST(p_size AS VARCHAR) END AS height, CASE WHEN p_partkey % 6 > 0 THEN CAST(p_partkey // 2 AS VARCHAR) || '.0' END AS id, p_name FROM part),
k AS (SELECT *, nullif(TRY_CAST(cap AS DOUBLE), -99) AS c, nullif(TRY_CAST(height AS DOUBLE), -99) AS h, coalesce(CAST(CAST(TRY_CAST(id AS DOUBLE) AS BIGINT) AS VARCHAR), 'name:' || p_name) AS key FROM r)
SELECT p_partkey, key, count(*) OVER (PARTITION BY key) = 1 AS key_unique, round(CASE WHEN c > 0 THEN c END, 2) AS cap, h AS height FROM k""")
def typed_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    cap = F.when(size % 5 == 0, "-99").when(size % 5 == 1, "n/a").when(size % 5 == 2, "-3.5").otherwise(F.col("p_retailprice").cast("string"))
    r = table(spark, sf_dir, "part").select(key, "p_name", cap.alias("cap"), F.when(size % 3 == 0, "-99").otherwise(size.cast("string")).alias("height"), F.when(key % 6 > 0, F.concat(F.floor(key / 2), F.lit(".0"))).alias("id"))
    out = K.typed_register(r, K.stable_key(F.col("id"), F.col("p_name")), ["cap", "height"], ["cap"])
    return out.select("p_partkey", "key", "key_unique", F.round("cap", 2).alias("cap"), "height")


TREES = "a AS (SELECT doc_id AS path, md5(coalesce(text, '')) AS d FROM documents WHERE doc_id % 11 <> 3), b AS (SELECT doc_id AS path, md5(coalesce(text, '') || CASE WHEN doc_id % 13 = 5 THEN 'x' ELSE '' END) AS d FROM documents WHERE doc_id % 17 <> 4)"


def trees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.coalesce("text", F.lit("")).alias("t"))
    right = docs.where("path % 17 <> 4").select("path", F.md5(F.concat("t", F.when(F.col("path") % 13 == 5, "x").otherwise("")).cast("binary")).alias("d"))
    return docs.where("path % 11 <> 3").select("path", F.md5(F.col("t").cast("binary")).alias("d")), right


@query(f"WITH {TREES} SELECT path, CASE WHEN a.d IS NULL THEN 'only_right' WHEN b.d IS NULL THEN 'only_left' WHEN a.d = b.d THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b USING (path)")
def tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.tree_diff(*trees(spark, sf_dir), "path", "d")


@query(f"WITH {TREES} SELECT path, CASE WHEN b.d IS NULL THEN 'missing' WHEN a.d = b.d THEN 'ok' ELSE 'differs' END AS state FROM a LEFT JOIN b USING (path)")
def verify_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.verify_checksums(*trees(spark, sf_dir), "path", "d")


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha256, md5(coalesce(text, '')) AS md5, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents")
def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce("text", F.lit("")).cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(data, 256).alias("sha256"), F.md5(data).alias("md5"), F.octet_length(data).cast("long").alias("n_bytes"))


@query("""
WITH r AS (SELECT o_orderkey, unnest(['exe', 'commit', 'grid']) AS role, unnest([o_orderpriority, o_orderstatus, CASE WHEN o_orderkey % 7 > 0 THEN 'g1' END]) AS first, unnest([CASE WHEN o_orderkey % 5 = 0 THEN '1-URGENT' ELSE o_orderpriority END, o_orderstatus, CASE WHEN o_orderkey % 9 > 0 THEN 'g1' ELSE 'g2' END]) AS second FROM orders)
SELECT o_orderkey, role, first, second FROM r WHERE first IS DISTINCT FROM second""")
def identity_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    pair = lambda a, b, c: F.create_map(F.lit("exe"), a, F.lit("commit"), b, F.lit("grid"), c)
    o = table(spark, sf_dir, "orders").select(
        key, pair(F.col("o_orderpriority"), F.col("o_orderstatus"), F.when(key % 7 > 0, "g1")).alias("one"), pair(F.when(key % 5 == 0, "1-URGENT").otherwise(F.col("o_orderpriority")), F.col("o_orderstatus"), F.when(key % 9 > 0, "g1").otherwise("g2")).alias("two")
    )
    return K.identity_diff(o, "o_orderkey", "one", "two")


@query("""
WITH c AS (SELECT c_custkey AS unit, c_nationkey AS data, c_custkey % 4 AS verifier FROM customer), r AS (SELECT c_custkey AS unit, c_nationkey + CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS data, c_custkey % 4 + CASE WHEN c_custkey % 10 = 1 THEN 1 ELSE 0 END AS verifier, CASE WHEN c_acctbal < 0 THEN 'failed' ELSE 'passed' END AS status FROM customer WHERE c_custkey % 8 <> 2)
SELECT c.unit, CASE WHEN r.unit IS NOT NULL AND c.data = r.data AND c.verifier = r.verifier THEN r.status ELSE 'not_checked' END AS verdict FROM c LEFT JOIN r USING (unit)""")
def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(key.alias("unit"), F.col("c_nationkey").alias("data"), (key % 4).alias("verifier"), "c_acctbal")
    unit = F.col("unit")
    r = c.where("unit % 8 <> 2").select(unit, (F.col("data") + F.when(unit % 6 == 0, 1).otherwise(0)).alias("data"), (F.col("verifier") + F.when(unit % 10 == 1, 1).otherwise(0)).alias("verifier"), F.when(F.col("c_acctbal") < 0, "failed").otherwise("passed").alias("status"))
    return K.report_counts(r, c.select("unit", "data", "verifier"), "unit", ["data", "verifier"], "status")


@query("""
WITH l AS (SELECT o_custkey AS stream, o_orderkey AS k, unnest([o_orderpriority, o_orderstatus, o_orderpriority]) AS name, unnest([0, 1, 2]) AS i FROM orders), f AS (SELECT stream, name, min((k, i)) AS p FROM l GROUP BY 1, 2)
SELECT stream, row_number() OVER (PARTITION BY stream ORDER BY p, name) AS position, name FROM f""")
def output_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("stream"), "o_orderkey", F.array("o_orderpriority", "o_orderstatus", "o_orderpriority").alias("names"))
    return K.output_union(o, "stream", "o_orderkey", "names")


@query("""
WITH u AS (SELECT DISTINCT o_custkey % 60 AS unit, CAST(extract(year FROM o_orderdate) AS INTEGER) - o_custkey % 60 % 4 AS year FROM orders), w AS (SELECT unit, CAST(y AS INTEGER) AS year, unit % 7 <> 3 OR y <> 2003 AS present FROM (SELECT DISTINCT unit FROM u UNION SELECT 99) a, range(2000, 2005) b(y) WHERE unit % 5 <> 1 OR y > 2001),
s AS (SELECT unit, max(year) AS last FROM u GROUP BY 1), a AS (SELECT w.unit, count(*) AS n_asked, count(u.unit) AS n_there, count(*) FILTER (WHERE NOT present) AS n_without_input, coalesce(min(w.year) - max(last) > 1, false) AS gap FROM w LEFT JOIN u USING (unit, year) LEFT JOIN s ON s.unit = w.unit GROUP BY 1)
SELECT *, n_there = 0 AND n_without_input = 0 AND NOT gap AS allowed FROM a""")
def extension_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.col("o_custkey") % 60
    u = table(spark, sf_dir, "orders").select(unit.alias("unit"), (F.year("o_orderdate") - unit % 4).cast("int").alias("year")).distinct()
    named = u.select("unit").union(spark.range(99, 100)).distinct()
    w = named.withColumn("year", F.explode(F.sequence(F.lit(2000), F.lit(2004)))).where((F.col("unit") % 5 != 1) | (F.col("year") > 2001))
    w = w.withColumn("present", (F.col("unit") % 7 != 3) | (F.col("year") != 2003))
    return K.extension_problems(u, w, "unit", "year", "present")


@query("""
WITH a AS (SELECT c_custkey AS path, 'first' AS part FROM customer WHERE c_custkey % 3 = 0), b AS (SELECT c_custkey AS path, 'second' AS part FROM customer WHERE c_custkey % 2 = 0), c AS (SELECT c_custkey AS path, 'third' AS part FROM customer WHERE c_custkey % 5 < 3)
SELECT path, min(part) AS part FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) GROUP BY 1""")
def merge_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("path"))
    part = lambda where, name: c.where(where).withColumn("part", F.lit(name))
    return K.merge_extensions([part("path % 3 = 0", "first"), part("path % 2 = 0", "second"), part("path % 5 < 3", "third")], ["path"])


@query("""
WITH RECURSIVE l AS (SELECT c_custkey AS item, CASE WHEN c_custkey > 0 THEN c_custkey * 5 // 7 END AS source, c_mktsegment AS kind FROM customer), w(item, spot, up, step) AS (SELECT item, item, source, 0 FROM l UNION ALL SELECT w.item, l.item, l.source, step + 1 FROM w JOIN l ON w.up = l.item WHERE w.up <> w.spot),
h AS (SELECT w.item, min(step) AS step, arg_min(spot, step) AS found FROM w JOIN l ON w.spot = l.item WHERE kind = 'BUILDING' GROUP BY 1) SELECT l.item, found, step FROM l LEFT JOIN h USING (item)""")
def provenance_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    links = table(spark, sf_dir, "customer").select(key.alias("item"), F.when(key > 0, F.floor(key * 5 / 7)).alias("source"), F.col("c_mktsegment").alias("kind"))
    return K.provenance_source(links, links, "item", "source", "kind", "BUILDING")


@query("""
WITH a AS (SELECT o_custkey AS run, o_orderkey AS number, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'started' END AS state, o_orderkey % 5 = 0 AS live FROM orders), l AS (SELECT run, arg_max(state, number) AS state, arg_max(live, number) AS live FROM a GROUP BY 1),
p AS (SELECT c_custkey AS run, CASE WHEN c_custkey % 4 > 0 THEN c_custkey // 4 END AS parent FROM customer) SELECT l.run, l.state, p.parent IS NULL OR coalesce(d.state = 'completed', false) AS may_go FROM l LEFT JOIN p USING (run) LEFT JOIN l d ON d.run = p.parent WHERE l.state <> 'completed' AND NOT l.live""")
def stranded_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("started")
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("number"), state.alias("state"), (F.col("o_orderkey") % 5 == 0).alias("live"))
    key = F.col("c_custkey")
    parents = table(spark, sf_dir, "customer").select(key.alias("run"), F.when(key % 4 > 0, F.floor(key / 4)).alias("parent"))
    return K.stranded(a, "run", "number", "state", "live", parents, "parent")


@query("""
WITH s AS (SELECT c_custkey AS node, unnest([0, 1, 2]) AS slot, unnest([CASE WHEN c_custkey % 3 > 0 THEN c_custkey * 2 END, c_custkey + 1, c_nationkey]) AS target FROM customer) SELECT node, CAST(slot AS INTEGER) AS slot, target FROM s WHERE target IN (SELECT c_custkey FROM customer)""")
def slot_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(key.alias("node"), F.array(F.when(key % 3 > 0, key * 2), key + 1, F.col("c_nationkey").cast("long")).alias("slots"))
    return K.slot_links(c, "node", "slots", c.select(F.col("node").alias("id")), "id")


@query("SELECT o_orderkey, coalesce(c_custkey // 2, -1) AS resolved FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey")
def resolve_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("wanted"))
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.floor(F.col("c_custkey") / 2).alias("index"))
    return K.resolve_ids(o, "wanted", ids, "id", "index").select("o_orderkey", "resolved")


@query("""
WITH p AS (SELECT s_suppkey, s_suppkey * 3 % 40 AS r, s_suppkey * 7 % 50 AS c FROM supplier), d AS (SELECT p_partkey, p_partkey // 50 AS r, p_partkey % 50 AS c, p_retailprice AS size FROM part WHERE p_size > 25),
b AS (SELECT s_suppkey, p_partkey, size, row_number() OVER (PARTITION BY s_suppkey ORDER BY size DESC, p_partkey) AS i FROM p JOIN d ON abs(p.r - d.r) <= 2 AND abs(p.c - d.c) <= 2) SELECT p.s_suppkey, p_partkey, size FROM p LEFT JOIN b ON p.s_suppkey = b.s_suppkey AND i = 1""")
def largest_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, q = F.col("s_suppkey"), F.col("p_partkey")
    p = table(spark, sf_dir, "supplier").select(k, (k * 3 % 40).alias("r"), (k * 7 % 50).alias("c"))
    d = table(spark, sf_dir, "part").where("p_size > 25").select(q, F.floor(q / 50).alias("r"), (q % 50).alias("c"), F.col("p_retailprice").alias("size"))
    return K.largest_within(p, d, "s_suppkey", "p_partkey", "r", "c", "size", 2)


@query("WITH a AS (SELECT c_custkey AS i, (c_custkey * 0.25 - 60)::DOUBLE AS v FROM customer), d AS (SELECT b.v - a.v AS d FROM a LEFT JOIN a b ON b.i = a.i + 1) SELECT count(*) AS n, coalesce(bool_and(d > 0) FILTER (WHERE d IS NOT NULL), true) AS ascending, round(avg(d), 9) AS step, round(max(d) - min(d), 9) AS stray FROM d")
def axis_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    axis = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("i"), (F.col("c_custkey") * 0.25 - 60).alias("v"))
    return K.axis_report(axis, "v", "i").withColumn("step", F.round("step", 9)).withColumn("stray", F.round("stray", 9))


@query("""
WITH c AS (SELECT c_custkey, c_custkey * 7 % 1700 / 10.0 - 85 AS lat, c_custkey * 11 % 3600 / 10.0 - 180 AS lon FROM customer)
SELECT c_custkey, CAST(floor(lat / 2) AS BIGINT) AS lat_block, CAST(CASE WHEN lon < -179 THEN 0 WHEN lon < 0 THEN floor((lon + 179) / 2) + 1 ELSE 91 + floor(lon / 2) END AS BIGINT) AS lon_block FROM c""")
def block_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key, K.latitude_block(key * 7 % 1700 / 10.0 - 85, 2.0).alias("lat_block"), K.longitude_block(key * 11 % 3600 / 10.0 - 180, 2.0).alias("lon_block"))


@query("""
WITH c AS (SELECT c_custkey, concat_ws('_', nullif(c_mktsegment, ''), CASE WHEN c_custkey % 3 > 0 THEN 'n' || c_nationkey END, 'spinup') AS run, CAST(1850 + c_custkey % 50 AS INTEGER) AS a, CAST(1850 + c_custkey % 50 + c_nationkey * 3 - 2 AS INTEGER) AS b FROM customer)
SELECT c_custkey, run || '_' || s AS chunk, s AS start, least(s + 9, b) AS "end" FROM (SELECT *, CAST(unnest(range(a, b + 1, 10)) AS INTEGER) AS s FROM c WHERE a <= b)""")
def run_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ids out of the parts that are known, and their spans of ten years."""
    key = F.col("c_custkey")
    run = T.run_id(F.col("c_mktsegment"), F.when(key % 3 > 0, F.concat(F.lit("n"), "c_nationkey")), F.lit("spinup"))
    first = (1850 + key % 50).cast("int")
    c = table(spark, sf_dir, "customer").select(key, run.alias("run"), F.explode(T.chunks_of(first, (first + F.col("c_nationkey") * 3 - 2).cast("int"), 10)).alias("s"))
    return c.select("c_custkey", T.run_id(F.col("run"), F.col("s.start").cast("string")).alias("chunk"), "s.start", "s.end")


@query("""
SELECT o_orderkey, least(make_date(1996 + o_orderkey % 3, 1, 1) + CAST(dayofyear(o_orderdate) - 1 AS INTEGER), make_date(1996 + o_orderkey % 3, 12, 31)) AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM orders""")
def restamped_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the year carried over to other years, and their source time as a stamp."""
    year = (1996 + F.col("o_orderkey") % 3).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.restamped(F.col("o_orderdate"), year).alias("day"), T.utc_stamp(F.col("o_orderdate")).alias("stamp"))


@query("SELECT n_nationkey, 'set2' || n_name AS outer_name, ['set2', n_name] AS names, 'x-set2' AS inner_name FROM nation")
def nested_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set's name replaced by another's in every text of a nested record."""
    schema = "outer string, names array<string>, inner struct<name: string>"
    record = F.struct(F.concat(F.lit("set1"), "n_name").alias("outer"), F.array(F.lit("set1"), "n_name").alias("names"), F.struct(F.lit("x-set1").alias("name")).alias("inner"))
    out = table(spark, sf_dir, "nation").select("n_nationkey", T.replaced_in(record, schema, "set1", "set2").alias("r"))
    return out.select("n_nationkey", F.col("r.outer").alias("outer_name"), "r.names", F.col("r.inner.name").alias("inner_name"))


@query(r"""
WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'readme.txt' ELSE 'r3b_' || CASE WHEN c_custkey % 2 = 0 THEN 'ssp126' ELSE 'historical' END || '_pirrww-' || lower(c_mktsegment) || '_total_5arcmin.nc' END AS name FROM customer),
d AS (SELECT CASE WHEN regexp_matches(name, '^([a-z0-9]+)_([a-z0-9-]+)_([a-z0-9-]+)_([a-z0-9-]+)') THEN regexp_extract(name, '^([a-z0-9]+)_([a-z0-9-]+)_([a-z0-9-]+)_([a-z0-9-]+)', ['round', 'scenario', 'quantity', 'statistic']) END AS s FROM n)
SELECT s.round AS round, s.scenario AS scenario, s.quantity AS quantity, s.statistic AS statistic, count(*) AS n FROM d GROUP BY ALL""")
def dataset_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 6 == 0, "readme.txt").otherwise(F.concat(F.lit("r3b_"), F.when(key % 2 == 0, "ssp126").otherwise("historical"), F.lit("_pirrww-"), F.lower("c_mktsegment"), F.lit("_total_5arcmin.nc")))
    named = table(spark, sf_dir, "customer").select(*T.dataset_of(name))
    return named.groupBy("round", "scenario", "quantity", "statistic").agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT * FROM (VALUES ('picontrol', 'dom', 'x1850', 1850), ('historical', 'dom', 'h', NULL), ('historical', 'ind', 'h', NULL), ('ssp', 'dom', 's', NULL), ('ssp', 'ind', 's', 2015)) t(scenario, sector, file, fixed)),
w AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'historical' WHEN 'O' THEN 'ssp' ELSE 'picontrol' END AS scenario, CASE WHEN o_custkey % 2 = 0 THEN 'dom' ELSE 'ind' END AS sector, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year FROM orders)
SELECT o_orderkey, file, CASE WHEN file IS NOT NULL THEN coalesce(fixed, year) END AS source_year FROM w LEFT JOIN s USING (scenario, sector)""")
def source_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File and source year by scenario and sector: a fixed year where the scenario has one, else the year itself."""
    spec = spark.createDataFrame([("picontrol", "dom", "x1850", 1850), ("historical", "dom", "h", None), ("historical", "ind", "h", None), ("ssp", "dom", "s", None), ("ssp", "ind", "s", 2015)], "scenario string, sector string, file string, fixed int")
    status = F.col("o_orderstatus")
    w = table(spark, sf_dir, "orders").select("o_orderkey", F.when(status == "F", "historical").when(status == "O", "ssp").otherwise("picontrol").alias("scenario"), F.when(F.col("o_custkey") % 2 == 0, "dom").otherwise("ind").alias("sector"), F.year("o_orderdate").alias("year"))
    out = w.join(F.broadcast(spec), ["scenario", "sector"], "left")
    return out.select("o_orderkey", "file", F.when(F.col("file").isNotNull(), F.coalesce("fixed", "year")).alias("source_year"))


@query("""
WITH a AS (SELECT s_suppkey AS k, s_nationkey AS id, s_suppkey % 2 AS type, s_acctbal AS cap, 1900 + s_suppkey % 150 AS year FROM supplier), b AS (SELECT s_suppkey AS k, s_nationkey + CASE WHEN s_suppkey % 30 = 4 THEN 1 ELSE 0 END AS id, s_suppkey % 2 AS type, s_acctbal + CASE WHEN s_suppkey % 7 = 1 THEN 1 ELSE 0 END AS cap FROM supplier WHERE s_suppkey <> 2 UNION ALL SELECT 100000, 1, 1, 1.0),
j AS (SELECT coalesce(a.k, b.k) AS k, a.k IS NULL OR b.k IS NULL AS alone, a.id <> b.id AS x, a.type <> b.type AS y, a.cap <> b.cap AND year <= 2000 AS z FROM a FULL JOIN b ON a.k = b.k)
SELECT problem, count(*) AS n, min(k) AS first FROM (SELECT k, 'id' AS problem FROM j WHERE x UNION ALL SELECT k, 'type' FROM j WHERE y UNION ALL SELECT k, 'cap' FROM j WHERE z UNION ALL SELECT k, 'one side only' FROM j WHERE alone) GROUP BY 1""")
def list_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    a = table(spark, sf_dir, "supplier").select(key.alias("k"), F.col("s_nationkey").alias("id"), (key % 2).alias("type"), F.col("s_acctbal").alias("cap"), (1900 + key % 150).alias("year"))
    k = F.col("k")
    b = a.where("k <> 2").select(k, (F.col("id") + F.when(k % 30 == 4, 1).otherwise(0)).alias("id"), "type", (F.col("cap") + F.when(k % 7 == 1, 1).otherwise(0)).alias("cap"))
    b = b.unionByName(spark.createDataFrame([(100000, 1, 1, 1.0)], "k long, id int, type long, cap double"))
    return K.list_problems(a, b, "k", ["id", "type"], "cap", "year", 2000)


@query(r"""
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations WHERE text IS NOT NULL), h AS (SELECT conv_id, turn, i, trim(line) AS line, category FROM l, (VALUES ('digits', '[0-9]'), ('question', '\?$'), ('upper', '^[A-Z]')) c(category, rx) WHERE regexp_matches(line, rx)),
r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY conv_id, turn, i) AS r FROM h) SELECT category, count(*) AS n, list(line ORDER BY r) FILTER (WHERE r <= 5) AS examples FROM r GROUP BY 1""")
def log_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the conversations by pattern, with the first five of each (the report's own size)."""
    lines = table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    return K.pattern_counts(lines, "line", ["conv_id", "turn", "i"], {"digits": "[0-9]", "question": r"\?$", "upper": "^[A-Z]"})


SQUARES = "(SELECT n_nationkey AS poly, n_nationkey % 5 * 40.0 - 100 AS x, n_nationkey // 5 * 30.0 - 75 AS y FROM nation)"


@query(f"""
WITH c AS (SELECT c_custkey, c_custkey * 13 % 2000 / 10.0 - 100.03 AS x, c_custkey * 29 % 1500 / 10.0 - 75.07 AS y FROM customer), s AS {SQUARES}
SELECT c_custkey, poly FROM c JOIN s ON (c.x - s.x) BETWEEN 0 AND 40 AND (c.y - s.y) BETWEEN 0 AND 30 AND (c.x - s.x) / 40 + (c.y - s.y) / 30 < 1""")
def in_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in right-angled triangles, one for each nation."""
    return Y.in_polygons(*_triangles(spark, sf_dir), "c_custkey", "poly", "x", "y", 10.0)


def _triangles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n, key = F.col("n_nationkey"), F.col("c_custkey")
    x, y = n % 5 * 40.0 - 100, F.floor(n / 5) * 30.0 - 75
    edge = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    edges = table(spark, sf_dir, "nation").select(n.alias("poly"), F.explode(F.array(edge(x, y, x + 40, y), edge(x + 40, y, x, y + 30), edge(x, y + 30, x, y))).alias("e")).select("poly", "e.*")
    return table(spark, sf_dir, "customer").select(key, (key * 13 % 2000 / 10.0 - 100.03).alias("x"), (key * 29 % 1500 / 10.0 - 75.07).alias("y")), edges


@query(f"""
WITH c AS (SELECT c_custkey, c_custkey * 13 % 2000 / 10.0 - 100.03 AS x, c_custkey * 29 % 1500 / 10.0 - 75.07 AS y FROM customer), s AS {SQUARES},
e AS (SELECT poly, x AS x1, y AS y1, x + 40 AS x2, y AS y2 FROM s UNION ALL SELECT poly, x + 40, y, x, y + 30 FROM s UNION ALL SELECT poly, x, y + 30, x, y FROM s),
i AS (SELECT c_custkey, min(poly) AS poly FROM c JOIN s ON (c.x - s.x) BETWEEN 0 AND 40 AND (c.y - s.y) BETWEEN 0 AND 30 AND (c.x - s.x) / 40 + (c.y - s.y) / 30 < 1 GROUP BY 1),
t AS (SELECT c_custkey, poly, x, y, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy, greatest(least(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 1), 0) AS s FROM c, e WHERE c_custkey NOT IN (SELECT c_custkey FROM i)),
d AS (SELECT c_custkey, poly, sqrt((x1 + s * dx - x) * (x1 + s * dx - x) + (y1 + s * dy - y) * (y1 + s * dy - y)) AS distance FROM t), n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY distance, poly) = 1)
SELECT c_custkey, poly, 0.0 AS distance FROM i UNION ALL SELECT c_custkey, poly, round(distance, 6) FROM n""")
def polygon_or_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triangle that holds each point, else the one with the nearest edge."""
    return Y.polygon_or_nearest(*_triangles(spark, sf_dir), "c_custkey", "poly", "x", "y", 4.0).withColumn("distance", F.round("distance", 6))


@query("""
WITH u AS (SELECT o_custkey % 50 AS unit, o_totalprice AS v, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year FROM orders), r AS (SELECT unit, CASE WHEN count(*) FILTER (WHERE v < 1000 OR v > 400000) = 0 THEN 'passed' ELSE 'failed' END AS status FROM u GROUP BY 1),
t AS (SELECT unit, CASE WHEN count(DISTINCT year) = max(year) - min(year) + 1 THEN 'passed' ELSE 'failed' END AS status FROM u GROUP BY 1), m AS (SELECT unit, CASE WHEN avg(v) BETWEEN 100000 AND 300000 THEN 'passed' ELSE 'warning' END AS status FROM u WHERE unit % 9 <> 0 GROUP BY 1),
e AS (SELECT unit, 'range' AS n, status FROM r UNION ALL SELECT unit, 'time', status FROM t UNION ALL SELECT r.unit, 'mean', coalesce(m.status, 'not_checked') FROM r LEFT JOIN m USING (unit))
SELECT unit, CASE max(CASE status WHEN 'passed' THEN 0 WHEN 'warning' THEN 1 WHEN 'not_checked' THEN 2 ELSE 3 END) WHEN 0 THEN 'passed' WHEN 1 THEN 'warning' WHEN 2 THEN 'not_checked' ELSE 'failed' END AS verdict, coalesce(string_agg(n, ',' ORDER BY n) FILTER (WHERE status <> 'passed'), '') AS failed FROM e GROUP BY 1""")
def unit_verifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forcing unit's range, gapless years and mean, each a check of its own, as one verdict."""
    u = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("unit"), F.col("o_totalprice").alias("v"), F.year("o_orderdate").alias("year"), F.lit(True).alias("active"))
    ok = lambda c, bad: F.when(c, "passed").otherwise(bad)
    runs = R.contiguous_runs(u, ["unit"], "year").groupBy("unit").agg(ok(F.count("*") == 1, "failed").alias("status"))
    means = u.where("unit % 9 <> 0").groupBy("unit").agg(ok(F.avg("v").between(100000, 300000), "warning").alias("status"))
    return K.combined_checks({"range": V.value_check(u, ["unit"], "v", "active", 1000.0, 400000.0), "time": runs, "mean": means}, "unit")


@query("""
WITH b AS (SELECT p_partkey, CASE WHEN p_size % 8 = 0 THEN 0 WHEN p_type LIKE '%A%' AND p_size < 10 THEN 2 WHEN p_type LIKE '%A%' AND p_size < 30 THEN 3 WHEN p_type LIKE '%A%' THEN 4 WHEN p_partkey % 5 = 0 THEN 5 ELSE 6 END AS batch FROM part) SELECT batch, count(*) AS n FROM b GROUP BY 1""")
def batch_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to batches by ordered rules."""
    size, first = F.col("p_size"), F.col("p_type").contains("A")
    batch = T.ordered_rules([(size % 8 == 0, 0), (first & (size < 10), 2), (first & (size < 30), 3), (first, 4), (F.col("p_partkey") % 5 == 0, 5)], 6)
    return table(spark, sf_dir, "part").groupBy(batch.alias("batch")).agg(F.count("*").alias("n"))


@query("""
WITH m AS (SELECT c_custkey AS cell, coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01'), 0) AS before, coalesce(sum(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01'), 0) AS after FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT count(*) AS n_cells, round(sum(before) FILTER (WHERE before > 0 AND after = 0), 2) AS lost, round(sum(after) FILTER (WHERE before = 0 AND after > 0), 2) AS new, round(sum(after) / nullif(sum(before), 0), 6) AS step FROM m""")
def join_year_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is lost and what is new in cells where a scenario takes over from history."""
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(F.when(old, F.col("o_totalprice"))).alias("before"), F.sum(F.when(~old, F.col("o_totalprice"))).alias("after"))
    m = table(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left").fillna(0.0)
    return m.agg(
        F.count("*").alias("n_cells"), F.round(F.sum(F.when((F.col("before") > 0) & (F.col("after") == 0), F.col("before"))), 2).alias("lost"), F.round(F.sum(F.when((F.col("before") == 0) & (F.col("after") > 0), F.col("after"))), 2).alias("new"),
        F.round(F.try_divide(F.sum("after"), F.sum("before")), 6).alias("step"),
    )


@query("""
WITH p AS (SELECT s_nationkey AS area, l_returnflag AS source, sum(l_quantity) AS v FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2), w AS (SELECT area, sum(v) FILTER (WHERE source = 'A') AS "A", sum(v) FILTER (WHERE source = 'N') AS "N", sum(v) FILTER (WHERE source = 'R') AS "R" FROM p GROUP BY 1)
SELECT area, "A", "N", "R", round(greatest("A", "N", "R") - least("A", "N", "R"), 2) AS spread, row_number() OVER (ORDER BY round(greatest("A", "N", "R") - least("A", "N", "R"), 2) DESC, area) AS rank FROM w QUALIFY rank <= 10""")
def largest_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas by source side by side, the ten with the widest spread (a top-k report)."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("area"))
    w = table(spark, sf_dir, "lineitem").join(s, "l_suppkey").groupBy("area").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity"))
    spread = F.round(F.greatest("A", "N", "R") - F.least("A", "N", "R"), 2)
    top = w.withColumn("spread", spread).orderBy(F.desc("spread"), "area").limit(10)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("spread"), "area")))
