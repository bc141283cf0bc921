"""Aggregates of gridded fields and time series: each is one or two grouped aggregations with partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.session import materialise


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value * weight over the weights of known values; null without weight."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def block_mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per block: the most frequent value (ties: the smallest), its share, and whether the block is uniform, mixed or empty. Nulls do not count."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    known = F.col(value).isNotNull()
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.when(known, F.struct(-F.col("_n"), F.col(value)))).alias("mode_value"),
        F.try_divide(F.max(F.when(known, F.col("_n"))), F.sum(F.when(known, F.col("_n")))).alias("mode_share"),
        F.when(F.count_if(known) == 0, "empty").when(F.count_if(known) == 1, "uniform").otherwise("mixed").alias("kind"),
    )


def window_majority(df: DataFrame, keys: list[str], value: str, ignored: int = 0) -> DataFrame:
    """Per window: the most frequent class other than ``ignored`` (ties: the lowest), or ``ignored`` where there is no other."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_n", F.when(F.coalesce(F.col(value), F.lit(ignored)) == ignored, 0).otherwise(F.col("_n")))
    return counts.groupBy(*keys).agg(F.coalesce(F.min_by(F.col(value), F.when(F.col("_n") > 0, F.struct(-F.col("_n"), F.col(value)))), F.lit(ignored)).alias("majority"))


def dominant_category(df: DataFrame, keys: list[str], category: str, weight: str, none: object = -1) -> DataFrame:
    """The category with the largest summed weight; ties go to the first by name, ``none`` where all weights are 0."""
    sums = df.groupBy(*keys, category).agg(F.sum(weight).alias("_w"))
    best = F.min_by(F.col(category), F.struct(-F.col("_w"), F.col(category)))
    return sums.groupBy(*keys).agg(F.when(F.max("_w") > 0, best).otherwise(F.lit(none)).alias("dominant"))


def histogram_percentile(df: DataFrame, keys: list[str], value: str, width: float, bins: int, q: float) -> DataFrame:
    """Upper edge of the first bin at which the cumulative count of |value| reaches ceil(q * n); infinite in the last bin."""
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*keys, F.least(F.floor(F.abs(value) / width), F.lit(bins)).alias("_bin")).agg(F.count("*").alias("_n"), F.max(F.abs(value)).alias("_m"))
    by = Window.partitionBy(*keys)
    c = counts.withColumn("_c", F.sum("_n").over(by.orderBy("_bin"))).withColumn("_t", F.sum("_n").over(by)).withColumn("_max", F.max("_m").over(by))
    hit = c.where(F.col("_c") >= F.ceil(F.lit(q) * F.col("_t"))).groupBy(*keys).agg(F.min("_bin").alias("_b"), F.max("_t").alias("n"), F.max("_max").alias("largest"))
    return hit.select(*keys, "n", "largest", F.when(F.col("_b") >= bins, F.lit(float("inf"))).otherwise((F.col("_b") + 1) * width).alias("percentile"))


def weighted_quantiles(df: DataFrame, keys: list[str], value: str, weight: str, probabilities: list[float]) -> DataFrame:
    """For each probability, the first value at which the cumulative weight reaches that share."""
    sums = df.where(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    by = Window.partitionBy(*keys)
    c = sums.withColumn("_c", F.sum("_w").over(by.orderBy(value))).withColumn("_t", F.sum("_w").over(by))
    return c.groupBy(*keys).agg(*[F.min(F.when(F.col("_c") >= p * F.col("_t"), F.col(value))).alias(f"q{round(100 * p)}") for p in probabilities])


def gini(df: DataFrame, keys: list[str], value: str, active: Column | None = None) -> DataFrame:
    """Gini coefficient of the active values of each group; 0 for a single value, null for a zero sum.

    Equal values are counted first; their ranks are prefix sums of the counts
    over sampled ranges, so a group of any size spreads over the cluster.
    """
    held = df if active is None else df.where(active)
    counts = held.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = prefix_sums(counts, keys, [value], "_n", "_before")
    # The ranks of n equal values after b smaller ones sum to n * b + n * (n + 1) / 2.
    ranks = F.col("_n") * F.col("_before") + F.col("_n") * (F.col("_n") + 1) / 2
    n, total = F.sum("_n"), F.sum(F.col(value) * F.col("_n"))
    return ranked.groupBy(*keys).agg(n.alias("n"), (F.try_divide(2 * F.sum(ranks * F.col(value)), n * total) - (n + 1) / n).alias("gini"))


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Percentiles of each group by linear interpolation between ranks, under the names given; nulls do not count.

    Values are counted, and their ranks are prefix sums over sampled ranges: no
    buffer holds a group's values, however many of them differ.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = prefix_sums(counts, keys, [value], "_n", "_before").join(counts.groupBy(*keys).agg(F.sum("_n").alias("_all")), keys)
    last = F.col("_before") + F.col("_n") - 1
    parts = []
    for name, p in probabilities.items():
        rank = F.lit(p) * (F.col("_all") - 1)
        # The values that hold the ranks next below and above, as sums of the one row that has each.
        holds = lambda r: F.max(F.when((F.col("_before") <= r) & (last >= r), F.col(value)))
        low, high = holds(F.floor(rank)), holds(F.ceil(rank))
        share = F.max(rank - F.floor(rank))
        parts.append((low + (high - low) * share).alias(name))
    return ranked.groupBy(*keys).agg(*parts)


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same keys that come before in ``order``, which has to be unique within them.

    Two levels: rows are dealt into sampled ranges of keys and order and summed
    inside each range; the ranges' totals (one row a range and key) are summed
    over the ranges. One key may span any number of ranges.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range", *keys).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_range", *keys, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    return ranged.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(base, ["_range", *keys]).withColumn(out, F.col(out) + F.col("_base")).drop("_range", "_base")


def monthly_means(daily: DataFrame, keys: list[str], day: str, value: str, min_days: int) -> DataFrame:
    """Mean of each calendar month; null if fewer than ``min_days`` values are known."""
    return daily.groupBy(*keys, F.year(day).alias("year"), F.month(day).alias("month")).agg(F.count(value).alias("n_days"), F.when(F.count(value) >= min_days, F.avg(value)).alias("mean"))


def climatology(monthly: DataFrame, keys: list[str], min_years: int) -> DataFrame:
    """Mean, minimum and maximum of each month over the years; null below ``min_years``."""
    enough = F.count("mean") >= min_years
    return monthly.groupBy(*keys, "month").agg(F.count("mean").alias("n_years"), *[F.when(enough, f("mean")).alias(f"{n}_mean") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))])


def trend(df: DataFrame, keys: list[str], x: str, y: str, limit: float) -> DataFrame:
    """Least-squares slope, detrended deviation (n - 2) and their ratio; a verdict of whether |slope| / deviation is within ``limit``.

    Fewer than three values or any missing one fail. A series whose deviation
    is at most 1e-12 of its largest value is constant: it passes only without
    slope.
    """
    slope, n = F.regr_slope(F.col(y), F.col(x)), F.count(y)
    rest = F.greatest(F.regr_syy(F.col(y), F.col(x)) - F.try_divide(F.pow(F.regr_sxy(F.col(y), F.col(x)), 2), F.regr_sxx(F.col(y), F.col(x))), F.lit(0.0))
    out = df.groupBy(*keys).agg(n.alias("n"), F.count("*").alias("_rows"), slope.alias("slope"), F.sqrt(F.when(n > 2, rest / (n - 2))).alias("deviation"), F.max(F.abs(y)).alias("_largest"))
    constant = F.col("deviation") <= 1e-12 * F.col("_largest")
    ratio = F.when(~constant, F.abs("slope") / F.col("deviation"))
    passed = F.when((F.col("n") < 3) | (F.col("n") < F.col("_rows")), F.lit(False)).when(constant, F.abs("slope") <= 1e-12 * F.col("_largest")).otherwise(ratio <= limit)
    return out.withColumn("ratio", ratio).withColumn("passed", passed).drop("_rows", "_largest")


def variance_share(df: DataFrame, block: str, value: str) -> DataFrame:
    """One row: the share of the variance that lies inside blocks."""
    inside = df.groupBy(block).agg(F.count(value).alias("_n"), F.var_pop(value).alias("_v"), F.avg(value).alias("_m"))
    within = F.sum(F.col("_n") * F.col("_v"))
    between = F.sum(F.col("_n") * F.col("_m") * F.col("_m")) - F.pow(F.sum(F.col("_n") * F.col("_m")), 2) / F.sum("_n")
    return inside.agg(F.sum("_n").alias("n"), F.try_divide(within, within + between).alias("share_within"))


def tolerance_check(left: Column, right: Column, absolute: float = 1e-4, relative: float = 1e-5) -> list[Column]:
    """Aggregates of the budget rule left <= right: violations beyond the tolerance, missing sides, worst excess."""
    excess = left - right
    return [
        F.count_if(excess > absolute + relative * F.abs(right)).alias("n_violations"),
        F.count_if(left.isNull() | right.isNull()).alias("n_missing"),
        F.max(excess).alias("worst_excess"),
    ]


def compare_fields(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per ``keys[:-1]``: rows that differ (null equals null, NaN equals NaN), the largest difference and the largest value."""
    left, right = a.select(*keys, F.col(value).alias("_a")), b.select(*keys, F.col(value).alias("_b"))
    both = left.join(right, keys, "full")
    return both.groupBy(*keys[:-1]).agg(F.count("*").alias("n"), F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("n_differing"), F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_diff"), F.max(F.abs("_a")).alias("max_value"))


def year_step(df: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """Per year, against the year before: shares of the earlier total in keys that halved, doubled or vanished, and new keys."""
    before = df.select(*keys, (F.col(year) + 1).alias(year), F.col(value).alias("_before"))
    both = df.select(*keys, year, F.col(value).alias("_now")).join(before, [*keys, year], "full")
    span = df.agg(F.min(year).alias("_low"), F.max(year).alias("_high"))
    both = both.crossJoin(F.broadcast(span)).where(F.col(year).between(F.col("_low") + 1, F.col("_high"))).select("*", F.coalesce("_now", F.lit(0.0)).alias("n1"), F.coalesce("_before", F.lit(0.0)).alias("n0"))
    share = lambda c: F.try_divide(F.sum(F.when(c, F.col("n0")).otherwise(0.0)), F.sum("n0"))
    return both.groupBy(year).agg(
        share((F.col("n1") > 0) & (F.col("n1") < 0.5 * F.col("n0"))).alias("halved"), share((F.col("n0") > 0) & (F.col("n1") > 2 * F.col("n0"))).alias("doubled"), share((F.col("n0") > 0) & (F.col("n1") == 0)).alias("vanished"), F.count_if((F.col("n0") == 0) & (F.col("n1") > 0)).alias("n_new")
    )
