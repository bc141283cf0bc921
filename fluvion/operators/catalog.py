"""File catalogues, registers, identities and bindings: joins of listings, maps and records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.operators.graph import first_hit
from fluvion.operators.records import combine_status


def file_of_year(files: DataFrame, name: str, wanted: DataFrame, variable: str, year: str) -> DataFrame:
    """Each wanted (variable, year) with its file and ``n_files``; the file is given only where exactly one spans the year.

    Names end in ``<variable>_<first>_<last>.nc``; other names never match.
    """
    pattern = r"(?:^|_)([a-z]+)_(\d{4})_(\d{4})\.nc$"
    part = lambda k: F.regexp_extract(name, pattern, k)
    named = files.where(F.col(name).rlike(pattern)).select(F.col(name), part(1).alias(variable), F.explode(F.sequence(part(2).cast("int"), part(3).cast("int"))).alias(year))
    found = named.groupBy(variable, year).agg(F.count("*").alias("n_files"), F.min(name).alias("_file"))
    return wanted.join(found, [variable, year], "left").select(variable, year, F.coalesce("n_files", F.lit(0)).alias("n_files"), F.when(F.col("n_files") == 1, F.col("_file")).alias("file"))


def typed_register(df: DataFrame, key: Column, numbers: list[str], positive: list[str], missing: float = -99.0) -> DataFrame:
    """Text columns as numbers: no number, and ``missing``, become null, and so do non-positive ones of ``positive``. Adds ``key`` and ``key_unique``."""
    value = lambda c: F.nullif(F.col(c).try_cast("double"), F.lit(missing))
    out = df
    for c in numbers:
        out = out.withColumn(c, F.when(value(c) > 0, value(c)) if c in positive else value(c))
    counts = out.groupBy(key.alias("key")).agg(F.count("*").alias("_n"))
    return out.withColumn("key", key).join(counts, "key").withColumn("key_unique", F.col("_n") == 1).drop("_n")


def stable_key(number: Column, name: Column) -> Column:
    """The number as text where there is one, else ``name:`` with the name."""
    return F.coalesce(number.try_cast("double").cast("long").cast("string"), F.concat(F.lit("name:"), name))


def tree_diff(left: DataFrame, right: DataFrame, path: str, digest: str) -> DataFrame:
    """Every path of either tree with its state: same, changed, only_left or only_right."""
    a, b = left.select(path, F.col(digest).alias("_a"), F.lit(True).alias("_l")), right.select(path, F.col(digest).alias("_b"), F.lit(True).alias("_r"))
    state = F.when(F.col("_l").isNull(), "only_right").when(F.col("_r").isNull(), "only_left").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("changed")
    return a.join(b, path, "full").select(path, state.alias("state"))


def verify_checksums(expected: DataFrame, present: DataFrame, path: str, digest: str) -> DataFrame:
    """Every expected path with its state: ok, differs or missing. Files that nobody expects are left out."""
    return tree_diff(expected, present, path, digest).where("state <> 'only_right'").select(path, F.when(F.col("state") == "same", "ok").when(F.col("state") == "changed", "differs").otherwise("missing").alias("state"))


def identity_diff(df: DataFrame, key: str, one: str, two: str) -> DataFrame:
    """For two maps per key: ``(key, role, first, second)`` of every role whose values differ, or that one map lacks."""
    side = lambda c, n: df.select(key, F.explode(c).alias("role", n))
    return side(one, "first").join(side(two, "second"), [key, "role"], "full").where(~F.col("first").eqNullSafe(F.col("second")))


def report_counts(reports: DataFrame, current: DataFrame, key: str, bindings: list[str], status: str) -> DataFrame:
    """Each current object's verdict: its report's, if all bindings (data, verifier) are still those of the report; else ``not_checked``."""
    bound = reports.select(key, *[F.col(b).alias(f"_{b}") for b in bindings], F.col(status).alias("_status"))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in bindings])
    hit = current.join(bound, key, "left").withColumn("_ok", same & F.col("_status").isNotNull())
    return hit.groupBy(key).agg(F.coalesce(F.max(F.when(F.col("_ok"), F.col("_status"))), F.lit("not_checked")).alias("verdict"))


def output_union(lists: DataFrame, stream: str, order: str, names: str) -> DataFrame:
    """``(stream, position, name)``: each stream's variables over all its lists, in order, the first of repeats kept."""
    each = lists.select(stream, order, F.posexplode(names).alias("_i", "name"))
    first = each.groupBy(stream, "name").agg(F.min(F.struct(order, "_i")).alias("_at"))
    return first.withColumn("position", F.row_number().over(Window.partitionBy(stream).orderBy("_at", "name"))).select(stream, "position", "name")


def extension_problems(units: DataFrame, wanted: DataFrame, unit: str, year: str, present: str) -> DataFrame:
    """Per unit that shall be extended: years asked for, those it has already, those without input, a gap to its last year, and whether it may go on."""
    span = units.groupBy(unit).agg(F.max(year).alias("_last"))
    asked = wanted.join(units.select(unit, year).distinct().withColumn("_has", F.lit(True)), [unit, year], "left").join(span, unit, "left")
    out = asked.groupBy(unit).agg(F.count("*").alias("n_asked"), F.count_if(F.col("_has")).alias("n_there"), F.count_if(~F.col(present)).alias("n_without_input"), (F.min(year) - F.max("_last") > 1).alias("_gap"))
    gap = F.coalesce("_gap", F.lit(False))
    return out.select(unit, "n_asked", "n_there", "n_without_input", gap.alias("gap"), ((F.col("n_there") == 0) & (F.col("n_without_input") == 0) & ~gap).alias("allowed"))


def merge_extensions(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of all parts; of those that share the keys the earliest part's stays."""
    ranked = reduce(lambda a, b: a.unionByName(b), [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    return ranked.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_part"))).where("_r = 1").drop("_r", "_part")


def provenance_source(links: DataFrame, starts: DataFrame, item: str, source: str, kind: str, wanted: str) -> DataFrame:
    """``(item, found, step)``: the first object of the ``wanted`` kind on each item's way up its sources; nulls where there is none. Loops end a way."""
    hits = first_hit(links, F.col(kind) == wanted, item, source).select(F.col("node").alias(item), "found", F.col("step").cast("int").alias("step"))
    return starts.select(item).distinct().join(hits, item, "left").select(item, "found", "step")


def stranded(attempts: DataFrame, run: str, number: str, state: str, live: str, parents: DataFrame, parent: str) -> DataFrame:
    """Runs whose latest attempt neither completed nor is alive, with whether their parent has completed and so they may be sent again."""
    last = attempts.groupBy(run).agg(F.max_by(F.struct(F.col(state).alias("s"), F.col(live).alias("l")), number).alias("_a")).select(run, F.col("_a.s").alias("state"), F.coalesce("_a.l", F.lit(False)).alias("_l"))
    done = last.select(F.col(run).alias(parent), (F.col("state") == "completed").alias("_done"))
    out = last.where((F.col("state") != "completed") & ~F.col("_l")).join(parents.select(run, parent), run, "left").join(done, parent, "left")
    return out.select(run, "state", (F.col(parent).isNull() | F.coalesce("_done", F.lit(False))).alias("may_go"))


def slot_links(df: DataFrame, node: str, slots: str, ids: DataFrame, id_col: str) -> DataFrame:
    """``(node, slot, target)`` of every filled slot whose id is known; slots are numbered from 0."""
    each = df.select(node, F.posexplode(slots).alias("slot", "target")).where("target is not null")
    return each.join(ids.select(F.col(id_col).alias("target")).distinct(), "target", "left_semi").select(node, "slot", "target")


def resolve_ids(df: DataFrame, wanted: str, ids: DataFrame, id_col: str, index: str, missing: int = -1) -> DataFrame:
    """Adds ``resolved``: the index of each wanted id, ``missing`` where there is none; an id that occurs twice is an error."""
    first = ids.groupBy(F.col(id_col).alias("_id")).agg(F.count("*").alias("_n"), F.min(index).alias("_index"))
    sole = F.when(F.col("_n") > 1, F.raise_error(F.lit("an id occurs twice")).cast("long")).otherwise(F.col("_index"))
    return df.join(first, F.col(wanted) == F.col("_id"), "left").withColumn("resolved", F.coalesce(sole, F.lit(missing))).drop("_id", "_n", "_index")


def largest_within(points: DataFrame, candidates: DataFrame, point: str, candidate: str, row: str, col: str, size: str, reach: int) -> DataFrame:
    """``(point, candidate, size)``: the largest candidate at most ``reach`` rows and columns from each point (ties: the smallest id); nulls where there is none."""
    step = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    around = points.select(point, F.col(row).alias("_r"), F.col(col).alias("_c")).withColumn("_dr", step).withColumn("_dc", step).select(point, (F.col("_r") + F.col("_dr")).alias(row), (F.col("_c") + F.col("_dc")).alias(col))
    best = around.join(candidates.select(candidate, row, col, size), [row, col]).groupBy(point).agg(F.min(F.struct((-F.col(size)).alias("n"), F.col(candidate).alias("c"))).alias("_b"))
    return points.select(point).join(best, point, "left").select(point, F.col("_b.c").alias(candidate), (-F.col("_b.n")).alias(size))


def axis_report(axis: DataFrame, value: str, index: str) -> DataFrame:
    """One row: places of an axis, whether it ascends, its step and how far steps stray from it. Sorted by range, so only neighbours meet."""
    after = axis.select((F.col(index) - 1).alias(index), F.col(value).alias("_next"))
    steps = axis.join(after, index, "left").withColumn("_d", F.col("_next") - F.col(value))
    return steps.agg(F.count("*").alias("n"), F.coalesce(F.every(F.col("_d") > 0), F.lit(True)).alias("ascending"), F.avg("_d").alias("step"), (F.max("_d") - F.min("_d")).alias("stray"))


def latitude_block(lat: Column, size: float) -> Column:
    """Index of the band of ``size`` degrees that holds a latitude; bands lie on multiples of their size, the upper edge is outside."""
    return F.floor(lat / size).cast("long")


def longitude_block(lon: Column, size: float) -> Column:
    """Index of the block that holds a longitude in [-180, 180): east of 0 blocks begin at multiples of ``size``, west of it half a block off, so the
    first and the last western one are half as wide. Others are an error."""
    half, west = size / 2, int(180 // size)
    index = F.when(lon < -180 + half, 0).when(lon < 0, F.floor((lon + 180 - half) / size) + 1).otherwise(west + 1 + F.floor(lon / size))
    return F.when((lon < -180) | (lon >= 180), F.raise_error(F.lit("a longitude lies outside [-180, 180)")).cast("long")).otherwise(index).cast("long")


def list_problems(parent: DataFrame, child: DataFrame, position: str, same: list[str], capacity: str, year: str, last_year: int) -> DataFrame:
    """``(problem, n, first)`` of two lists that have to agree by position: columns that differ, capacities of what can operate by ``last_year``, and rows of one side only."""
    a = parent.select(position, *[F.col(c).alias(f"_a_{c}") for c in [*same, capacity, year]], F.lit(True).alias("_p"))
    b = child.select(position, *[F.col(c).alias(f"_b_{c}") for c in [*same, capacity]], F.lit(True).alias("_c"))
    both = a.join(b, position, "full")
    differs = lambda c: ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))
    alone = F.col("_p").isNull() | F.col("_c").isNull()
    rules = [(c, ~alone & differs(c)) for c in same] + [(capacity, ~alone & (F.col(f"_a_{year}") <= last_year) & differs(capacity)), ("one side only", alone)]
    found = both.select(position, F.explode(F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules]))).alias("problem"))
    return found.groupBy("problem").agg(F.count("*").alias("n"), F.min(position).alias("first"))


def pattern_counts(lines: DataFrame, line: str, order: list[str], patterns: dict[str, str], examples: int = 5) -> DataFrame:
    """``(category, n, examples)`` of the lines that match each pattern; the first ``examples`` in ``order`` are shown. A line can count in several."""
    hits = F.array_compact(F.array(*[F.when(F.col(line).rlike(p), F.lit(n)) for n, p in patterns.items()]))
    each = lines.select(*order, F.trim(line).alias("_l"), F.explode(hits).alias("category"))
    counts = each.groupBy("category").agg(F.count("*").alias("n"))
    first = each.withColumn("_r", F.row_number().over(Window.partitionBy("category").orderBy(*order))).where(F.col("_r") <= examples)
    shown = first.groupBy("category").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_l"))), lambda x: x["_l"]).alias("examples"))
    return counts.join(shown, "category")


def combined_checks(checks: dict[str, DataFrame], key: str, status: str = "status") -> DataFrame:
    """``(key, verdict, failed)``: the worst verdict of each unit over named checks, and the names of those that did not pass. A unit that a check lacks counts as not checked there."""
    units = reduce(lambda a, b: a.union(b), [c.select(key) for c in checks.values()]).distinct()
    each = reduce(lambda a, b: a.unionByName(b), [units.join(c.select(key, F.col(status).alias("_s")), key, "left").select(key, F.lit(n).alias("_n"), F.coalesce("_s", F.lit("not_checked")).alias("_s")) for n, c in checks.items()])
    names = each.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("_s") != "passed", F.col("_n")))), ",").alias("failed"))
    return combine_status(each, [key], "_s").join(names, key)
