"""Reports on fields, soils and run logs: quantiles of differences, rows beyond limits, timings, full grids, surface height."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.functions import physics as P
from fluvion.operators.aggregates import exact_percentiles
from fluvion.operators.grid import conservative_remap, overlap_weights


def difference_quantiles(old: DataFrame, new: DataFrame, keys: list[str], groups: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Per group: how many cells both fields hold, and the named percentiles of the size of their difference."""
    both = old.select(*keys, *groups, F.col(value).alias("_old")).join(new.select(*keys, F.col(value).alias("_new")), keys)
    size = both.withColumn("_d", F.abs(F.col("_new") - F.col("_old"))).where("_d is not null")
    return size.groupBy(*groups).agg(F.count("*").alias("n")).join(exact_percentiles(size, groups, "_d", probabilities), groups)


def beyond_limits(df: DataFrame, keys: list[str], value: str, limits: list[float]) -> DataFrame:
    """The rows whose size exceeds the least limit, with ``limit``, the largest that they exceed, and ``times``, their size over it."""
    size = F.abs(F.col(value))
    reached = F.array_max(F.filter(F.array(*[F.lit(float(x)) for x in limits]), lambda x: x < size))
    return df.where(size > min(limits)).select(*keys, value, reached.alias("limit"), (size / reached).alias("times"))


NUMBER = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"


def timing_table(lines: DataFrame, keys: list[str], line: str, columns: list[str], facts: dict[str, str] | None = None) -> DataFrame:
    """``(*keys, name, *columns)`` of table rows ``| name | number | ... |`` in run logs, and of ``label : number`` lines.

    ``facts`` maps a name to its label; its number is in the first column. Of
    repeated rows the last by text order counts, lines that fit nothing are left out.
    """
    row = r"^\s*\|\s*([A-Za-z][A-Za-z ]*?)\s*\|" + r"\|".join([rf"\s*{NUMBER}\s*"] * len(columns)) + r"\|\s*$"
    table = lines.where(F.col(line).rlike(row)).select(*keys, F.regexp_extract(line, row, 1).alias("name"), *[F.regexp_extract(line, row, k + 2).cast("double").alias(c) for k, c in enumerate(columns)])
    for name, label in (facts or {}).items():
        fact = rf"^\s*{label}\s*:\s*{NUMBER}"
        found = lines.where(F.col(line).rlike(fact)).select(*keys, F.lit(name).alias("name"), F.regexp_extract(line, fact, 1).cast("double").alias(columns[0]), *[F.lit(None).cast("double").alias(c) for c in columns[1:]])
        table = table.unionByName(found)
    last = table.groupBy(*keys, "name").agg(F.max(F.struct(*columns)).alias("_l"))
    return last.select(*keys, "name", *[F.col(f"_l.{c}").alias(c) for c in columns])


def full_grid(values: DataFrame, row: str, col: str, value: str, n_rows: int, n_cols: int, fill: float) -> DataFrame:
    """Every cell of a grid with its value, ``fill`` where the table has none; rows outside the grid are an error."""
    cells = values.sparkSession.range(n_rows * n_cols).select(F.floor(F.col("id") / n_cols).alias(row), (F.col("id") % n_cols).alias(col))
    outside = ~(F.col(row).between(0, n_rows - 1) & F.col(col).between(0, n_cols - 1))
    held = values.select(F.when(outside, F.raise_error(F.lit("a cell lies outside the grid")).cast("long")).otherwise(F.col(row)).alias(row), col, F.col(value))
    return cells.join(held, [row, col], "left").select(row, col, F.coalesce(value, F.lit(fill)).alias(value))


def surface_height(geopotential: DataFrame, value: str, source_rows: DataFrame, source_cols: DataFrame, rows: DataFrame, cols: DataFrame) -> DataFrame:
    """Height in m on a coarser grid from the geopotential of a finer one (row, col, value), by conservative remapping.

    The axes are (id, low, high) in degrees, in either direction: they meet by
    their edges, so no row has to be turned round. A missing value is an error.
    """
    known = F.coalesce(F.col(value), F.raise_error(F.lit("a cell has no geopotential")).cast("double")) / P.GRAVITY
    return conservative_remap(geopotential.select("row", "col", known.alias("height")), overlap_weights(source_rows, rows, spherical=True), overlap_weights(source_cols, cols), "height")


def soil_columns(depth: Column, bulk: Column, particle: Column, d1: Column, d2: Column, d3: Column, d4: Column) -> dict[str, Column]:
    """Porosity, the most moisture in mm, and the base-flow parameters of the bottom layer in their second form: the most flow, and the shares of flow and moisture where it turns non-linear.

    ``d1`` to ``d4`` are the linear reservoir, the non-linear one, the moisture where it begins and its exponent.
    """
    porosity = P.porosity(bulk, particle)
    moist = depth * porosity * 1000.0
    most = d2 * F.pow(moist - d3, d4) + d1 * moist
    return {"porosity": porosity, "max_moist": moist, "dsmax": most, "ds": F.try_divide(d1 * d3, most), "ws": F.try_divide(d3, moist)}


def soil_problems(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """``(*keys, rule, n)``: rows that break each rule, 0 included; a rule that cannot be judged for want of a value counts as broken."""
    counts = df.groupBy(*keys).agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules])).alias("_e")
    return counts.select(*keys, each).select(*keys, "_e.rule", "_e.n")
