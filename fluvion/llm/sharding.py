"""Balanced contiguous shards from a two-level prefix sum of byte sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.session import materialise


def prefix_sums(rows: DataFrame, order: list[str], sizes: dict[str, str]) -> DataFrame:
    """``rows`` plus, for each ``sizes[column] = name``, the sum of ``column`` over all earlier rows in ``order``.

    Rows are dealt into key ranges and each range is summed by itself; only one
    total per range meets in one place, so no task sees more than a range or
    the list of ranges. The dealt rows are written once, as range bounds are
    sampled and a second run could choose others. A counter joins the key, so
    equal keys, even a third of all rows, spread over several ranges.
    """
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    ranged = materialise(salted.repartitionByRange(*order, "_salt").withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("_part").orderBy(*order, "_salt").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: at most as many as there are shuffle partitions.
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_total_{n}") for c, n in sizes.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", *[F.coalesce(F.sum(f"_total_{n}").over(earlier), F.lit(0)).alias(f"_base_{n}") for n in sizes.values()])
    inside = ranged.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for c, n in sizes.items()])
    joined = inside.join(F.broadcast(starts), "_part")
    for n in sizes.values():
        joined = joined.withColumn(n, F.col(n) + F.col(f"_base_{n}"))
    return joined.drop("_part", "_salt", *[f"_base_{n}" for n in sizes.values()])


def balanced_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Contiguous shards of near equal bytes, in ``doc_id`` order (nulls first).

    The cuts lie at multiples of total / shards; a row goes to the shard that
    holds its middle byte, so a shard differs from its target by less than its
    two border rows. Size is the UTF-8 length plus 1; a null text counts as
    empty. Equal rows are dealt one by one, each with a slot of its own, and
    equal texts may lie in different shards. An empty table gives no rows, and
    rows far longer than a shard may leave a shard empty.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(1).cast("long").alias("_one"),
    )
    # The text is read once; what follows sees 24 bytes a row.
    narrow = materialise(narrow, "sizes")
    total = narrow.agg(F.sum("size").alias("_total"))
    placed = prefix_sums(narrow, ["doc_id", "text_crc32", "size"], {"size": "_start", "_one": "_index"}).crossJoin(F.broadcast(total))
    placed = materialise(placed.withColumn("shard", F.expr(f"least(((2 * _start + size) * {shards}) div (2 * _total), {shards - 1})").cast("int")), "placed")
    first = placed.groupBy("shard").agg(F.min("_index").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_index") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
