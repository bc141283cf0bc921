"""Benchmark decontamination with a distributed positional inverted index.

The index stores the postings (text, position) of every test term in the
training texts, and one end mark per text whose position is its length. A
query starts at the rarest term of each test window, aligns the item with the
text at that posting and intersects the offset-adjusted postings of all other
item words. Runs of matched words are exact phrase matches. Proximity matches
hold most of an item's words at alignments within a small slop; they start from
as many of an item's rarest words as no such match can all miss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.llm.bits import may_hold
from fluvion.llm.textstats import ascii_lower
from fluvion.session import materialise

#: Words of a window.
WINDOW = 13
#: Share of item words that a proximity match holds, and how far alignments may drift apart.
NEAR_SHARE, SLOP = 0.8, 4
#: Rarest words of an item that a proximity candidate holds, where a match must hold so many.
NEAR_ANCHORS = 3
#: Tables of the benchmark up to this many rows (32 bytes each) are broadcast, after counting; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: No word contains this character, so it can mark the end of a text.
END = "\x00"


def index_words(text: Column) -> Column:
    """Words: runs of digits, letters a-z (A-Z lower-cased) and all characters from \\x80 on."""
    low = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def bounded(table: DataFrame) -> DataFrame:
    """A written table of the benchmark, to be broadcast if it is within the bound. It never grows with the training texts."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def build_index(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Postings ``(_uid, term, pos)`` of vocabulary terms in every row, and its end mark with ``doc_id`` and length.

    ``_uid`` numbers rows, so repeated or null ids never mix. Terms are 64-bit
    hashes. The table is written once, split by text and in text order: no
    term's postings ever meet in one place.
    """
    terms = vocabulary.select("term").unionByName(docs.sparkSession.range(1).select(F.xxhash64(F.lit(END)).alias("term")))
    terms = bounded(materialise(terms, "terms"))
    rows = docs.select(F.monotonically_increasing_id().alias("_uid"), F.col(id_col).alias("doc_id"), F.concat(index_words(F.col(text_col).cast("string")), F.array(F.lit(END))).alias("_words"))
    postings = rows.select("_uid", "doc_id", F.posexplode("_words").alias("pos", "_word")).withColumn("term", F.xxhash64("_word")).join(terms, "term", "left_semi")
    end = F.col("term") == F.xxhash64(F.lit(END))
    return materialise(postings.select("_uid", "term", "pos", F.when(end, F.col("doc_id")).alias("doc_id"), end.alias("is_end")), "postings")


def exact_alignments(index: DataFrame, items: DataFrame, frequency: DataFrame) -> DataFrame:
    """``(_uid, _item, _delta)`` at which the rarest term of some test window meets its posting."""
    tokens = items.join(frequency, "term", "left").withColumn("_df", F.coalesce("_df", F.lit(0)))
    span = F.least(F.col("_n"), F.lit(WINDOW))
    starts = F.sequence(F.greatest(F.col("_ipos") - span + 1, F.lit(0)), F.least(F.col("_ipos"), F.col("_n") - span))
    windows = tokens.select("_item", "_ipos", "term", "_df", F.explode(starts).alias("_window"))
    rarest = windows.groupBy("_item", "_window").agg(F.min(F.struct("_df", "_ipos", "term")).alias("_r"))
    # A window with an absent term occurs nowhere.
    anchors = bounded(materialise(rarest.where("_r._df > 0").select("_item", "_r._ipos", "_r.term").distinct(), "anchors"))
    return index.where(~F.col("is_end")).join(anchors, "term").select("_uid", "_item", (F.col("pos") - F.col("_ipos")).alias("_delta"))


def near_alignments(index: DataFrame, items: DataFrame, frequency: DataFrame) -> DataFrame:
    """``(_uid, _item, _delta)`` around which a proximity match can lie.

    A match misses at most ``_n - _need`` words, so of that many and
    NEAR_ANCHORS more rarest ones it holds NEAR_ANCHORS. Candidates are counted
    in overlapping grids that hold any two alignments within the slop.
    """
    rarest = Window.partitionBy("_item").orderBy(F.coalesce("_df", F.lit(0)), "_ipos")
    ranked = items.join(frequency, "term", "left").withColumn("_need", need()).withColumn("_rank", F.row_number().over(rarest))
    anchors = ranked.where((F.col("_rank") <= F.col("_n") - F.col("_need") + NEAR_ANCHORS) & F.col("_df").isNotNull())
    anchors = bounded(materialise(anchors.select("_item", "_ipos", "term", F.least("_need", F.lit(NEAR_ANCHORS)).alias("_held")), "near-anchors"))
    delta = index.where(~F.col("is_end")).join(anchors, "term").select("_uid", "_item", "_held", (F.col("pos") - F.col("_ipos")).alias("_delta"))
    # Cells of width 2 * SLOP, one every SLOP: alignments up to SLOP apart share one.
    cell = F.floor(F.col("_delta") / SLOP)
    cells = delta.select("_uid", "_item", "_held", F.explode(F.array(cell - 1, cell)).alias("_cell")).groupBy("_uid", "_item", "_held", "_cell").agg(F.count("*").alias("_m")).where("_m >= _held")
    around = F.sequence(F.col("_cell") * SLOP, (F.col("_cell") + 2) * SLOP - 1)
    return cells.select("_uid", "_item", F.explode(around).alias("_delta"))


def need() -> Column:
    """Item words that a proximity match holds."""
    return F.ceil(F.lit(NEAR_SHARE) * F.col("_n") - F.lit(1e-9))


def intersect(index: DataFrame, items: DataFrame) -> DataFrame:
    """Matched item words ``(_uid, _item, _delta, _ipos)`` of every alignment, written; ``_exact`` and ``_near`` say which search asked for it.

    Both searches share one pass of the postings: the benchmark's anchors are
    broadcast, so a frequent anchor meets its postings where they lie, and only
    the alignments' own words are matched by a shuffle.
    """
    frequency = materialise(index.where(~F.col("is_end")).groupBy("term").agg(F.count("*").alias("_df")), "frequency")
    exact = exact_alignments(index, items, frequency).withColumn("_exact", F.lit(True)).withColumn("_near", F.lit(False))
    near = near_alignments(index, items, frequency).withColumn("_exact", F.lit(False)).withColumn("_near", F.lit(True))
    aligned = exact.unionByName(near).groupBy("_uid", "_item", "_delta").agg(F.max("_exact").alias("_exact"), F.max("_near").alias("_near"))
    aligned = materialise(aligned, "aligned")
    words = bounded(items)
    # Postings of texts without any alignment stay where they are.
    postings = may_hold(index.where(~F.col("is_end")).select("_uid", "pos", "term"), aligned, "_uid")
    needed = aligned.join(words, "_item").select("_uid", "_item", "_delta", "_ipos", "_n", "_id", "_exact", "_near", "term", (F.col("_delta") + F.col("_ipos")).alias("pos")).where("pos >= 0")
    return materialise(postings.join(needed, ["_uid", "pos", "term"]), "matched")


def indexed(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """The items' words ``(_item, _id, _n, _ipos, term)`` and the index of their terms, both written."""
    item_rows = benchmark.select(
        F.monotonically_increasing_id().alias("_item"), F.col(item_col).cast("string").alias("_id"), index_words(F.col(item_text).cast("string")).alias("_words")
    )
    items = item_rows.select("_item", "_id", F.size("_words").alias("_n"), F.posexplode("_words").alias("_ipos", "_word")).withColumn("term", F.xxhash64("_word")).drop("_word")
    items = materialise(items, "items")
    return items, build_index(docs, items.select("term").distinct(), id_col, text_col)


def near_items(matched: DataFrame) -> DataFrame:
    """Distinct ``(_uid, _id)`` of proximity matches: NEAR_SHARE of the item's words at alignments no more than SLOP apart."""
    words = matched.where("_near").select("_uid", "_item", "_id", "_n", "_ipos", F.explode(F.sequence(F.col("_delta") - SLOP, F.col("_delta"))).alias("_low")).distinct()
    return words.groupBy("_uid", "_item", "_id", "_n", "_low").agg(F.count("*").alias("_m")).where(F.col("_m") >= need()).select("_uid", "_id").distinct()


def proximity_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_near_items and the sorted ids ``near_items``; rows as in ``decontaminate``."""
    items, index = indexed(docs, benchmark, id_col, text_col, item_col, item_text)
    near = near_items(intersect(index, items)).groupBy("_uid").agg(F.array_sort(F.collect_set("_id")).alias("_near"))
    ids = F.coalesce(F.col("_near"), F.array().cast("array<string>"))
    ends = index.where("is_end").select("_uid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return ends.join(near, "_uid", "left").select("doc_id", "n_words", F.size(ids).cast("long").alias("n_near_items"), ids.alias("near_items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: n_words, n_hit, n_items, items_sha256, contaminated, and the proximity matches: n_near_items, near_items (sorted ids, comma-joined).

    Null or wordless texts have no words and no hits; null or wordless items
    occur nowhere; words of items without an id are hit, but those items are not
    listed or counted. Repeated rows, of
    documents or items, are each treated as a row of their own; an item id
    counts once. Ties between equally rare terms go to the earlier word. Empty
    tables give empty or clean results. Other columns are ignored.
    """
    items, index = indexed(docs, benchmark, id_col, text_col, item_col, item_text)
    matched = intersect(index, items)

    one = Window.partitionBy("_uid", "_item", "_delta").orderBy("_ipos")
    runs = (
        matched.where("_exact").withColumn("_run", F.col("_ipos") - F.row_number().over(one))
        .groupBy("_uid", "_item", "_delta", "_run", "_n", "_id")
        .agg(F.min("pos").alias("_from"), F.max("pos").alias("_to"))
        .where(F.col("_to") - F.col("_from") + 1 >= F.least(F.col("_n"), F.lit(WINDOW)))
    )
    text = Window.partitionBy("_uid").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max("_to").over(text), F.lit(-1)), F.col("_from") - 1)
    hits = runs.withColumn("_new", F.greatest(F.col("_to") - reached, F.lit(0)))
    found = hits.groupBy("_uid").agg(F.sum("_new").alias("n_hit"), F.array_sort(F.collect_set("_id")).alias("_ids"))

    near = near_items(matched).groupBy("_uid").agg(F.array_sort(F.collect_set("_id")).alias("_near_ids"))
    near_ids = F.coalesce(F.col("_near_ids"), F.array().cast("array<string>"))

    ends = index.where("is_end").select("_uid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    ids = F.coalesce(F.col("_ids"), F.array().cast("array<string>"))
    return ends.join(found, "_uid", "left").join(near, "_uid", "left").select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"), F.size(near_ids).cast("long").alias("n_near_items"), F.array_join(near_ids, ",").alias("near_items"),
    )
