"""Run records, ledgers, inventories and quality-control verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Verdicts from best to worst; "missing" counts as not checked.
STATUSES = ("passed", "warning", "not_checked", "failed")


def combine_status(df: DataFrame, keys: list[str], status: str) -> DataFrame:
    """The worst verdict of each key; an unknown verdict is an error, a key with null verdicts only has passed."""
    ranks = reduce(lambda c, x: c.when(F.col(status) == x[1], x[0]), list(enumerate(STATUSES))[1:], F.when(F.col(status) == STATUSES[0], 0))
    rank = ranks.when(F.col(status) == "missing", STATUSES.index("not_checked")).when(F.col(status).isNull(), 0)
    rank = rank.otherwise(F.raise_error(F.concat(F.lit("unknown verdict "), F.col(status))).cast("int"))
    return df.groupBy(*keys).agg(F.max(rank).alias("_r")).select(*keys, F.element_at(F.array(*map(F.lit, STATUSES)), F.col("_r") + 1).alias("verdict"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` replaces the rows of ``old`` that share its keys; all others stay."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def inventory(files: DataFrame, keys: list[str], size: str, time: str) -> DataFrame:
    """Count, bytes and extremes for each group, for each leading part of the keys, and for all files."""
    return files.rollup(*keys).agg(
        F.count("*").alias("n_files"), F.sum(size).alias("bytes"), F.min(size).alias("smallest"), F.max(size).alias("largest"), F.min(time).alias("oldest"), F.max(time).alias("newest"), F.grouping_id().alias("level")
    )


def rule_table(df: DataFrame, rules: dict[str, Column], amount: str, group: str) -> DataFrame:
    """For each group and rule: rows and amount that the rule keeps and removes. A null answer keeps the row."""
    flags = F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(c, F.lit(False)).alias("removed")) for n, c in rules.items()])
    long = df.select(group, amount, F.explode(flags).alias("_f")).select(group, amount, "_f.rule", "_f.removed")
    return long.groupBy(group, "rule", "removed").agg(F.count("*").alias("n"), F.sum(amount).alias("amount"))


def latest_attempts(attempts: DataFrame, run: str, number: str) -> DataFrame:
    """The attempt with the largest number of each run."""
    return attempts.withColumn("_r", F.row_number().over(Window.partitionBy(run).orderBy(F.desc(number)))).where("_r = 1").drop("_r")


def run_status(chunks: DataFrame, run: str, chunk: str, status: str) -> DataFrame:
    """Per run: chunks, completed ones, the first that is not, and whether the run is complete."""
    done = F.col(status) == "completed"
    first = F.min(F.when(~F.coalesce(done, F.lit(False)), F.col(chunk)))
    return chunks.groupBy(run).agg(F.count("*").alias("n_chunks"), F.count_if(done).alias("n_completed"), first.alias("first_incomplete"), first.isNull().alias("complete"))


def fingerprint(columns: list[str]) -> Column:
    """SHA-256 of the columns as one JSON object with sorted names; nulls are left out."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])), 256)


def value_profile(df: DataFrame, keys: list[str], value: str, place: list[str]) -> DataFrame:
    """Counts of missing, zero and negative values, the extremes, and the first place of the largest value."""
    v, where = F.col(value), F.struct(*[F.col(c) for c in place])
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(v.isNull()).alias("n_missing"), F.count_if(v == 0).alias("n_zero"), F.count_if(v < 0).alias("n_negative"), F.min(v).alias("lowest"), F.max(v).alias("highest"),
        F.min_by(where, F.struct(-v, where)).alias("_at"),
    ).select("*", *[F.col(f"_at.{c}").alias(f"at_{c}") for c in place]).drop("_at")


def missing_keys(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted keys that are not present."""
    return wanted.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")


def contiguous_runs(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Runs of consecutive numbers of each key, with first, last and length; repeats count once."""
    distinct = df.select(*keys, number).distinct()
    run = F.col(number) - F.row_number().over(Window.partitionBy(*keys).orderBy(number))
    return distinct.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("length")).drop("_run")
