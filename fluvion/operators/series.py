"""Comparisons of runs, fields and series over time: one or two grouped aggregates each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def field_differences(old: DataFrame, new: DataFrame, cell: list[str], groups: list[str], value: str, tolerance: float) -> DataFrame:
    """Per group of cells: means of both fields, relative change of the mean, share of cells that changed beyond ``tolerance``, and the largest change.

    Cells of one side only are counted apart. The groups are columns of both sides.
    """
    a, b = old.select(*cell, *groups, F.col(value).alias("_a")), new.select(*cell, *groups, F.col(value).alias("_b"))
    both = a.join(b, [*cell, *groups], "full")
    off = F.abs(F.col("_b") - F.col("_a"))
    return both.groupBy(*groups).agg(
        F.count("*").alias("n"), F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("n_one_side"), F.avg("_a").alias("mean_old"), F.avg("_b").alias("mean_new"),
        F.try_divide(F.avg("_b") - F.avg("_a"), F.avg("_a")).alias("relative_change"), F.avg(F.when(off.isNotNull(), (off > tolerance).cast("double"))).alias("share_changed"), F.max(off).alias("max_change"), F.max(F.try_divide(off, F.abs("_a"))).alias("max_relative"),
    )


def limits_scan(df: DataFrame, keys: list[str], value: str, limits: list[float]) -> DataFrame:
    """Values whose size is beyond each limit, counted per key, and the largest size."""
    size = F.abs(F.col(value))
    return df.groupBy(*keys).agg(F.count(value).alias("n"), *[F.count_if(size > x).alias(f"beyond_{x:g}") for x in limits], F.max(size).alias("largest"))


def store_drift(yearly: DataFrame, cell: list[str], year: str, value: str, box: list[Column], step: float) -> DataFrame:
    """Per box of cells: cells, total change from the first to the last year, mean size of a cell's change, and cells that rose (fell) by more than ``step`` every year."""
    order = Window.partitionBy(*cell).orderBy(year)
    moved = yearly.withColumn("_d", F.col(value) - F.lag(value).over(order))
    cells = moved.groupBy(*cell, *box).agg((F.max_by(value, year) - F.min_by(value, year)).alias("_change"), F.every(F.coalesce(F.col("_d") > step, F.lit(True))).alias("_up"), F.every(F.coalesce(F.col("_d") < -step, F.lit(True))).alias("_down"), F.count("_d").alias("_n"))
    names = [c for c in cells.columns if c not in cell and not c.startswith("_")]
    real = F.col("_n") > 0
    return cells.groupBy(*names).agg(F.count("*").alias("n_cells"), F.sum("_change").alias("change"), F.avg(F.abs("_change")).alias("mean_size"), F.count_if(real & F.col("_up")).alias("n_rising"), F.count_if(real & F.col("_down")).alias("n_falling"))


def series_facts(df: DataFrame, keys: list[str], time: str, one: str, two: str, tolerance: float = 1e-9) -> DataFrame:
    """Whether a series is constant, whether two are equal, the first time they differ, and at how many times the first is positive."""
    off = F.coalesce(F.abs(F.col(one) - F.col(two)) > tolerance, ~F.col(one).eqNullSafe(F.col(two)))
    return df.groupBy(*keys).agg(
        (F.max(one) - F.min(one) <= tolerance).alias("constant"), (F.count_if(off) == 0).alias("equal"), F.min(F.when(off, F.col(time))).alias("first_differing"), F.count_if(F.col(one) > 0).alias("n_positive")
    )


def joined_series(df: DataFrame, keys: list[str], time: str, history: str, scenario: str, at: object) -> DataFrame:
    """A scenario continued from history at ``at``: by the ratio and by the difference of the two there; the difference never below 0.

    Both are null where history or scenario is missing at that time; the ratio
    also where the scenario is 0 there.
    """
    here = df.where(F.col(time) == at).groupBy(*keys).agg(F.max(history).alias("_h"), F.max(scenario).alias("_s"))
    out = df.join(here, keys, "left")
    return out.withColumn("by_ratio", F.try_divide(F.col(scenario) * F.col("_h"), F.col("_s"))).withColumn("by_difference", F.when(F.col("_h").isNotNull() & F.col("_s").isNotNull(), F.greatest(F.col(scenario) + F.col("_h") - F.col("_s"), F.lit(0.0)))).drop("_h", "_s")


def inside_parents(children: DataFrame, parent: str, value: str, active: str) -> DataFrame:
    """Per parent, over its active children: their number, the share of them that hold nothing, the largest child's share, and the sum."""
    held = children.where(F.col(active)).groupBy(parent).agg(F.count("*").alias("n_active"), F.sum(value).alias("total"), F.avg((F.coalesce(F.col(value), F.lit(0.0)) == 0).cast("double")).alias("zero_share"), F.max(value).alias("_m"))
    return held.withColumn("largest_share", F.try_divide(F.col("_m"), F.col("total"))).drop("_m")


def full_histogram(df: DataFrame, value: Column, low: float, width: float, bins: int) -> DataFrame:
    """``(bin, low_edge, n)`` for every bin, empty ones too; values outside go to the first and the last."""
    place = F.greatest(F.least(F.floor((value - low) / width), F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = df.where(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", (low + F.col("bin") * width).alias("low_edge"), F.coalesce("n", F.lit(0)).alias("n"))


def differing_cells(df: DataFrame, one: str, two: str, reasons: dict[str, Column], absolute: float, relative: float) -> DataFrame:
    """Adds ``differs`` (beyond both tolerances), ``reasons`` (names of all that hold, joined by +) and ``group`` (the first of them, else far)."""
    off = F.abs(F.col(one) - F.col(two))
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in reasons.items()]))
    return df.withColumn("differs", F.coalesce(off > absolute + relative * F.abs(F.col(two)), F.lit(False))).withColumn("reasons", F.array_join(names, "+")).withColumn("group", F.coalesce(F.try_element_at(names, F.lit(1)), F.lit("far")))


def operation_table(daily: DataFrame, keys: list[str], day: str, operating: str, inflow: str, outflow: str, storage: str) -> DataFrame:
    """Per dam: operating days and months, its first operating day, inflow over outflow on those days, and least, most and last storage."""
    on = F.coalesce(F.col(operating), F.lit(False))
    ratio = F.try_divide(F.sum(F.when(on, F.col(inflow))), F.sum(F.when(on, F.col(outflow))))
    return daily.groupBy(*keys).agg(
        F.count_if(on).alias("operating_days"), F.count_distinct(F.when(on, F.date_trunc("month", day))).alias("operating_months"), F.min(F.when(on, F.to_date(day))).alias("first_day"), ratio.alias("in_over_out"),
        F.min(F.when(on, F.col(storage))).alias("least"), F.max(F.when(on, F.col(storage))).alias("most"), F.max_by(F.when(on, F.col(storage)), F.when(on, F.col(day))).alias("last"),
    )


def storage_balance(daily: DataFrame, keys: list[str], day: str, storage: str, inflow: str, outflow: str) -> DataFrame:
    """Per dam: the largest error of storage change against inflow less outflow between days that follow each other, and how many such pairs there are."""
    order = Window.partitionBy(*keys).orderBy(day)
    before, last = F.lag(storage).over(order), F.lag(day).over(order)
    pairs = daily.withColumn("_e", F.when(F.datediff(day, last) == 1, F.abs(F.col(storage) - before - F.col(inflow) + F.col(outflow))))
    return pairs.groupBy(*keys).agg(F.count("_e").alias("n_pairs"), F.max("_e").alias("worst_error"))


def seasonal_variation(monthly: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sample deviation over mean of the positive monthly values; null below two of them."""
    held = F.when(F.col(value) > 0, F.col(value))
    return monthly.groupBy(*keys).agg(F.count(held).alias("n_positive"), F.try_divide(F.stddev_samp(held), F.avg(held)).alias("variation"))


def signal_flags(ratios: dict[str, Column], limit: float, separator: str = " ") -> Column:
    """Names of the lines whose jump ratio reaches ``limit``, strongest test first as given; empty without any."""
    return F.concat_ws(separator, *[F.when(r >= limit, F.lit(n)) for n, r in ratios.items()])


def slice_means(df: DataFrame, cell: list[str], dims: list[list[str]], value: str) -> DataFrame:
    """Means of a field over all but each of several sets of dimensions: one row per set, its values and the cell."""
    parts = []
    for names in dims:
        label = F.concat_ws(",", *[F.concat(F.lit(f"{d}="), F.col(d)) for d in names]) if names else F.lit("mean")
        parts.append(df.groupBy(*cell, label.alias("slice")).agg(F.avg(value).alias("mean"), F.count(value).alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)
