"""Grid relations as weight tables: subdivision, replication, linear and conservative remapping, neighbourhoods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parent_index(fine: Column, first_edge: float, size: float) -> Column:
    """Index of the coarse cell that holds a fine centre on a regular axis."""
    return F.floor((fine - first_edge) / size).cast("long")


def linear_weights(fine: DataFrame, position: str, first: float, step: float, count: int, periodic: bool = False) -> DataFrame:
    """Two rows per fine position: coarse index ``corner`` and ``weight``; the axis wraps if periodic, else it clamps at its ends."""
    at = (F.col(position) - first) / step
    low = F.floor(at)
    if periodic:
        pairs = F.array(F.struct(F.pmod(low, F.lit(count)).alias("corner"), (1 - (at - low)).alias("weight")), F.struct(F.pmod(low + 1, F.lit(count)).alias("corner"), (at - low).alias("weight")))
    else:
        held = F.least(F.greatest(at, F.lit(0.0)), F.lit(float(count - 1)))
        base = F.least(F.floor(held), F.lit(count - 2))
        pairs = F.array(F.struct(base.alias("corner"), (1 - (held - base)).alias("weight")), F.struct((base + 1).alias("corner"), (held - base).alias("weight")))
    return fine.select("*", F.explode(pairs).alias("_p")).select(*fine.columns, F.col("_p.corner").cast("long").alias("corner"), F.col("_p.weight").alias("weight"))


def bilinear(rows: DataFrame, cols: DataFrame, values: DataFrame, row: str, col: str, value: str, clip: bool = False) -> DataFrame:
    """Interpolated ``value`` for each pair of a fine row and a fine column, from their weight tables and the coarse values.

    ``rows`` and ``cols`` are linear_weights() with the columns ``row`` and
    ``col``; ``values`` has prow, pcol and the value. With ``clip`` the result
    stays within its corners. The weight tables have two rows per axis place.
    """
    corners = (
        rows.select(row, F.col("corner").alias("prow"), F.col("weight").alias("_wr"))
        .join(values, "prow")
        .join(cols.select(col, F.col("corner").alias("pcol"), F.col("weight").alias("_wc")), "pcol")
        .withColumn("_w", F.col("_wr") * F.col("_wc"))
    )
    out = corners.groupBy(row, col).agg(F.sum(F.col("_w") * F.col(value)).alias(value), F.min(value).alias("_low"), F.max(value).alias("_high"))
    held = F.least(F.greatest(F.col(value), F.col("_low")), F.col("_high")) if clip else F.col(value)
    return out.select(row, col, held.alias(value))


def overlap_weights(fine: DataFrame, coarse: DataFrame, spherical: bool = False, bins: int = 1024) -> DataFrame:
    """Overlap of the intervals (low, high) of two axes, as (fine_id, coarse_id, overlap); of their sines for latitudes.

    Both axes are dealt into ``bins`` equal parts of their extent; intervals
    meet by equality in the parts they touch, so no line is compared with all.
    """
    low, high = F.greatest("f_low", "c_low"), F.least("f_high", "c_high")
    size = F.sin(F.radians(high)) - F.sin(F.radians(low)) if spherical else high - low
    span = coarse.agg(F.min("low").alias("_from"), ((F.max("high") - F.min("low")) / bins).alias("_width"))

    def dealt(axis: DataFrame, p: str) -> DataFrame:
        part = lambda c: F.greatest(F.least(F.floor((c - F.col("_from")) / F.col("_width")), F.lit(bins)), F.lit(-1))
        one = axis.select(F.col("id").alias(f"{p}_id"), F.col("low").alias(f"{p}_low"), F.col("high").alias(f"{p}_high")).crossJoin(F.broadcast(span))
        return one.withColumn("_part", F.explode(F.sequence(part(F.col(f"{p}_low")), part(F.col(f"{p}_high"))))).drop("_from", "_width")

    met = dealt(fine, "f").join(dealt(coarse, "c"), "_part").where((F.col("f_low") < F.col("c_high")) & (F.col("c_low") < F.col("f_high")))
    return met.select(F.col("f_id").alias("fine_id"), F.col("c_id").alias("coarse_id"), size.alias("overlap")).distinct()


def conservative_remap(values: DataFrame, row_overlap: DataFrame, col_overlap: DataFrame, value: str) -> DataFrame:
    """First-order conservative mean on the destination grid; ``values`` has the source row and col, overlaps link them as fine_id to coarse_id."""
    r = row_overlap.select(F.col("fine_id").alias("row"), F.col("coarse_id").alias("to_row"), F.col("overlap").alias("_wr"))
    c = col_overlap.select(F.col("fine_id").alias("col"), F.col("coarse_id").alias("to_col"), F.col("overlap").alias("_wc"))
    joined = values.where(F.col(value).isNotNull()).join(r, "row").join(c, "col")
    w = F.col("_wr") * F.col("_wc")
    return joined.groupBy("to_row", "to_col").agg(F.try_divide(F.sum(w * F.col(value)), F.sum(w)).alias(value))


def neighbours(cells: DataFrame, row: str, col: str, n_rows: int, n_cols: int, reach: int = 1) -> DataFrame:
    """Each cell with the places (nrow, ncol) around it; columns wrap, rows end at the poles. Eight rows per cell at reach 1."""
    steps = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1) if (a, b) != (0, 0)])
    moved = cells.select("*", F.explode(steps).alias("_s"))
    out = moved.select(*cells.columns, (F.col(row) + F.col("_s.dr")).alias("nrow"), F.pmod(F.col(col) + F.col("_s.dc"), F.lit(n_cols)).alias("ncol"))
    return out.where(F.col("nrow").between(0, n_rows - 1))


def line_class(index: Column, widths: dict[str, int], rest: str = "interior") -> Column:
    """Name of the coarsest line, of those given with their widths in cells, that lies before an index."""
    ordered = sorted(widths.items(), key=lambda x: -x[1])
    return reduce(lambda c, x: c.when(index % x[1] == 0, x[0]), ordered[1:], F.when(index % ordered[0][1] == 0, ordered[0][0])).otherwise(rest)


def on_active(values: DataFrame, cells: DataFrame, keys: list[str], value: str, active: str, fill: float | None = None, least: float | None = None) -> DataFrame:
    """The values of a source on the active cells of a grid, found by their keys.

    A missing value becomes ``fill``; without one it is an error, as is a value
    below ``least``. Inactive cells are left out.
    """
    held = cells.where(active).select(*keys).join(values.select(*keys, value), keys, "left")
    v = F.col(value)
    known = F.coalesce(v, F.lit(fill)) if fill is not None else F.coalesce(v, F.raise_error(F.lit("an active cell has no value")).cast("double"))
    if least is not None:
        known = F.when(known < least, F.raise_error(F.lit("a value is too low")).cast("double")).otherwise(known)
    return held.select(*keys, known.alias(value))


def blocks(cells: DataFrame, row: str, col: str, rows: int, cols: int) -> DataFrame:
    """Adds the block (brow, bcol) of ``rows`` by ``cols`` cells that holds each cell, and the cell's place in it, row by row from 0."""
    place = F.pmod(F.col(row), F.lit(rows)) * cols + F.pmod(F.col(col), F.lit(cols))
    return cells.withColumn("brow", F.floor(F.col(row) / rows)).withColumn("bcol", F.floor(F.col(col) / cols)).withColumn("place", place.cast("int"))


def unblocked(df: DataFrame, row: str, col: str, rows: int, cols: int) -> DataFrame:
    """Rows and columns of cells from their blocks and places: the inverse of blocks()."""
    return df.withColumn(row, F.col("brow") * rows + F.floor(F.col("place") / cols)).withColumn(col, F.col("bcol") * cols + F.col("place") % cols)


def nesting_report(fine: DataFrame, coarse: DataFrame, low: str, high: str) -> DataFrame:
    """One row: fine intervals, how many lie inside one coarse interval, and how many coarse intervals are covered without a gap."""
    inside = overlap_weights(fine.select(F.col("id"), F.col(low).alias("low"), F.col(high).alias("high")), coarse.select(F.col("id"), F.col(low).alias("low"), F.col(high).alias("high")))
    size = lambda d, n: d.select(F.col("id").alias(n), (F.col(high) - F.col(low)).alias(f"_{n}"))
    nested = inside.join(size(fine, "fine_id"), "fine_id").groupBy("fine_id").agg(F.max(F.col("overlap") >= F.col("_fine_id") - 1e-9).alias("ok"))
    covered = inside.groupBy("coarse_id").agg(F.sum("overlap").alias("_o")).join(size(coarse, "coarse_id"), "coarse_id").agg(F.count_if(F.col("_o") >= F.col("_coarse_id") - 1e-9).alias("n_covered"))
    return fine.agg(F.count("*").alias("n_fine")).crossJoin(nested.agg(F.count_if("ok").alias("n_nested"))).crossJoin(covered)
