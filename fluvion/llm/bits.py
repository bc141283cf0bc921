"""A bit table of fixed size that tells which rows surely have no partner, so that they are dropped before a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places of the table.
PLACES = 1 << 24


def may_hold(rows: DataFrame, ids: DataFrame, column: str, places: int = PLACES) -> DataFrame:
    """The rows whose ``column`` may be among ``ids`` (of the same column); none that is among them is dropped.

    The table has ``places`` / 64 rows of 16 bytes at most (4 MB), whatever the
    number of ids, so it can always be broadcast; with more ids than places it
    lets more rows through, and the join after it decides. Nulls are dropped.
    """
    place = F.pmod(F.xxhash64(column), F.lit(places))
    word, bit = F.floor(place / 64).cast("int").alias("_word"), (place % 64).cast("int").alias("_bit")
    table = ids.where(F.col(column).isNotNull()).select(word, bit).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    return rows.where(F.col(column).isNotNull()).select("*", word, bit).join(F.broadcast(table), "_word").where(F.getbit("_bits", "_bit") == 1).select(*rows.columns)
