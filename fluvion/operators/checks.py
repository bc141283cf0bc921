"""Verifiers and balances: each check is one grouped aggregate whose row says what was counted and whether it passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def value_check(df: DataFrame, keys: list[str], value: str, active: str, low: float, high: float, low_open: bool = False) -> DataFrame:
    """Fill and range of a field on its active cells: missing, out of range, zeros, ones, and values where no cell is active.

    ``low_open`` counts ``low`` itself as out of range. A group passes if no active cell is missing or out of range.
    """
    v, on = F.col(value), F.coalesce(F.col(active), F.lit(False))
    outside = ((v <= low) if low_open else (v < low)) | (v > high)
    out = df.groupBy(*keys).agg(
        F.count_if(on).alias("n_active"), F.count_if(on & v.isNull()).alias("n_missing"), F.count_if(on & outside).alias("n_out_of_range"), F.count_if(on & (v == 0)).alias("n_zero"),
        F.count_if(on & (v == 1)).alias("n_one"), F.count_if(~on & v.isNotNull()).alias("n_outside"), F.min(F.when(on, v)).alias("lowest"), F.max(F.when(on, v)).alias("highest"),
    )
    return out.withColumn("status", F.when((F.col("n_missing") == 0) & (F.col("n_out_of_range") == 0), "passed").otherwise("failed"))


def closure(balance: DataFrame, keys: list[str], year: str, inflow: str, losses: list[str], storage: str) -> DataFrame:
    """Adds ``storage_change`` against the year before and ``residual``: inflow less losses less that change.

    ``storage`` is the store at the year's end. Both are null where the year
    before is absent or a term is missing.
    """
    before = balance.select(*keys, (F.col(year) + 1).alias(year), F.col(storage).alias("_before"))
    change = F.col(storage) - F.col("_before")
    rest = F.col(inflow)
    for loss in losses:
        rest = rest - F.col(loss)
    return balance.join(before, [*keys, year], "left").withColumn("storage_change", change).withColumn("residual", rest - change).drop("_before")


def deficit_repaid(df: DataFrame, keys: list[str], time: str, deficit: str) -> DataFrame:
    """Adds ``increase`` of a deficit over the step before (the first counts from 0) and ``repaid``, what a decrease paid back."""
    before = F.lag(deficit, 1, 0.0).over(Window.partitionBy(*keys).orderBy(time))
    return df.withColumn("increase", F.col(deficit) - before).withColumn("repaid", F.greatest(before - F.col(deficit), F.lit(0.0)))


def share_passed(df: DataFrame, keys: list[str], passed: str, missing: str, threshold: float) -> DataFrame:
    """Cells, those that passed, those that could not be tested, the share that passed, and whether it reaches ``threshold``."""
    ok = F.coalesce(F.col(passed), F.lit(False))
    out = df.groupBy(*keys).agg(F.count("*").alias("cells"), F.count_if(ok).alias("passed_cells"), F.count_if(F.col(missing)).alias("missing_cells"))
    share = F.col("passed_cells") / F.col("cells")
    return out.withColumn("share_passed", share).withColumn("passed", share >= threshold)


def block_status(df: DataFrame, keys: list[str], passed: str, problems: str) -> DataFrame:
    """``not_checked`` for a block with a problem or without a test, ``failed`` if any test failed, else ``passed``."""
    status = F.when((F.count_if(F.col(problems)) > 0) | (F.count(passed) == 0), "not_checked").when(F.count_if(~F.col(passed)) > 0, "failed").otherwise("passed")
    return df.groupBy(*keys).agg(status.alias("status"))


def annual_means(monthly: DataFrame, keys: list[str], year: str, month: str, value: str) -> DataFrame:
    """Mean of each year weighted by the length of its months, the lowest month, and December's value; null unless all twelve are known."""
    days = F.dayofmonth(F.last_day(F.make_date(F.col(year).cast("int"), F.col(month).cast("int"), F.lit(1))))
    whole = F.count(value) == 12
    return monthly.groupBy(*keys, year).agg(
        F.count(value).alias("n_months"), F.when(whole, F.sum(F.col(value) * days) / F.sum(days)).alias("mean"), F.when(whole, F.min(value)).alias("lowest"), F.max(F.when(F.col(month) == 12, F.col(value))).alias("december")
    )


def reaggregate(parents: DataFrame, children: DataFrame, parent: str, total: str, share: str, absolute: float, relative: float) -> DataFrame:
    """Each parent's total against the sum of its children: ``child_sum``, ``difference`` and ``agrees`` within the tolerance; no children sum to 0."""
    sums = children.groupBy(parent).agg(F.sum(share).alias("child_sum"), F.count("*").alias("n_children"))
    out = parents.select(parent, total).join(sums, parent, "left").fillna(0, ["child_sum", "n_children"])
    off = F.col("child_sum") - F.col(total)
    return out.withColumn("difference", off).withColumn("agrees", F.abs(off) <= absolute + relative * F.abs(total))


def ledger_match(ledger: DataFrame, measured: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Every key of either side with its state: matched, differs, only_ledger or only_measured."""
    a, b = ledger.select(*keys, F.col(value).alias("_a")), measured.select(*keys, F.col(value).alias("_b"))
    both = a.withColumn("_l", F.lit(True)).join(b.withColumn("_m", F.lit(True)), keys, "full")
    same = F.coalesce(F.abs(F.col("_a") - F.col("_b")) <= tolerance, F.col("_a").isNull() & F.col("_b").isNull())
    state = F.when(F.col("_l").isNull(), "only_measured").when(F.col("_m").isNull(), "only_ledger").when(same, "matched").otherwise("differs")
    return both.select(*keys, state.alias("state"))


def coverage_check(df: DataFrame, keys: list[str], share: Column, tolerance: float) -> DataFrame:
    """Shares of each cell: their sum, negatives, and whether the sum is 1 within the tolerance without a negative."""
    out = df.groupBy(*keys).agg(F.sum(share).alias("total"), F.count_if(share < 0).alias("n_negative"))
    return out.withColumn("closed", (F.abs(F.col("total") - 1) <= tolerance) & (F.col("n_negative") == 0))


def compare_runs(df: DataFrame, keys: list[str], one: str, two: str, observed: str) -> DataFrame:
    """Two runs at stations against what was observed: medians of the ratios, shares within 0.8 and 1.25, stations changed, and changed for the better.

    Stations whose three means are not all positive are left out. Medians are
    exact: stations are a few thousand at most per key.
    """
    known = df.where((F.col(one) > 0) & (F.col(two) > 0) & (F.col(observed) > 0))
    a, b = F.col(one) / F.col(observed), F.col(two) / F.col(observed)
    change = F.abs(F.log(F.col(one) / F.col(two)))
    closer = F.abs(F.log(a)) < F.abs(F.log(b))
    within = lambda c: F.avg(c.between(0.8, 1.25).cast("double"))
    return known.groupBy(*keys).agg(
        F.count("*").alias("n_stations"), F.median(a).alias("median_one"), F.median(b).alias("median_two"), within(a).alias("within_one"), within(b).alias("within_two"),
        F.count_if(change > F.log(F.lit(1.05))).alias("n_changed_5"), F.count_if(change > F.log(F.lit(1.2))).alias("n_changed_20"), F.count_if(closer & (change > F.log(F.lit(1.05)))).alias("n_closer_5"),
    )
