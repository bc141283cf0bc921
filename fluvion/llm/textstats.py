"""Column expressions for whole-text statistics, all of them built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that separates words, as a Java character class.
SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs of characters other than space and \\x09-\\x0D; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. All-ASCII texts take the fast path, as there both agree."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def chained_hash(array: Column, step: int) -> Column:
    """Hashes of each element with the one ``step`` further; the last ``step`` places are dropped."""
    n = F.size(array)
    ahead = F.slice(array, F.lit(step + 1), F.greatest(n - step, F.lit(0)))
    here = F.slice(array, F.lit(1), F.greatest(n - step, F.lit(0)))
    return F.zip_with(here, ahead, lambda a, b: F.xxhash64(a, b))


def word_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_chars.

    n_repeat_words counts the words inside eight-word windows that the same
    text holds at least twice. Windows are compared by 64-bit hashes that are
    built by doubling (1, 2, 4, 8 words), in the row itself: no shuffle. Only
    texts that do hold a repeated window sort their windows; a word lies in a
    repeated window if the window starts less than eight words before it, so
    the count is the sum of the gaps between repeated starts, eight at most.
    """
    t = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    d = d.select(
        *keep,
        F.char_length(t).cast("long").alias("n_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        words_of(F.col("_text")).alias("_words"),
    )
    d = d.select(
        *keep,
        "n_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    rest = [c for c in d.columns if c != "_h"]
    for step in (1, 2, 4):
        d = d.select(*rest, chained_hash(F.col("_h"), step).alias("_h"))
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    pairs = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select(*rest, F.when(repeated, pairs).alias("_p"))
    n = F.size("_p")
    after = F.slice("_p", F.lit(2), F.greatest(n - 1, F.lit(0)))
    before = F.slice("_p", F.lit(1), F.greatest(n - 1, F.lit(0)))
    same = F.zip_with(before, after, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
    d = d.select(*rest, F.when(F.col("_p").isNotNull(), starts).alias("_s"))
    n = F.size("_s")
    gaps = F.zip_with(
        F.slice("_s", F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice("_s", F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.least(b - a, F.lit(8)),
    )
    covered = F.aggregate(gaps, F.lit(8).cast("long"), lambda acc, x: acc + x)
    return d.select(*rest, F.when(F.col("_s").isNotNull(), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))
