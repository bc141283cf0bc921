"""Similar names: the ratio of matching blocks, and the pairs that can reach a given ratio found without meeting all others.

Let two names of lengths summing to L match in M characters, so that their
ratio is 2M / L. Blocks are parted by unmatched characters, so there are at most
1 + L - 2M of them, and a block of m characters holds m - 1 of its bigrams. So
the names share at least 3M - 1 - L bigrams, and M characters. A ratio of at
least t means M >= tL / 2 and that no length exceeds the other's (2 - t) / t
times. Names that share o tokens, whatever the order of tokens, have a common
one among all but the last o - 1 of each: with the rarest tokens first, only
rare ones join names. Short names, for which the bound on bigrams says nothing,
are joined by their characters in the same way.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.session import materialise, ship


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype=float)


def block_ratio(a: str, b: str) -> Column:
    """Twice the matched characters over all, by longest matching blocks found left and right of each other, in Arrow batches; order matters a little."""
    return F.pandas_udf(_ratios, "double")(a, b)


def _tokens(text: Column, q: int) -> Column:
    """Q-grams of a text with their number of occurrence (``ab:0``), so that multiplicities count; they come in order of position."""
    grams = F.transform(F.sequence(F.lit(1), F.char_length(text) - (q - 1)), lambda i: F.substring(text, i, F.lit(q)))
    every = F.when(F.char_length(text) >= q, grams).otherwise(F.array().cast("array<string>"))
    return F.transform(every, lambda g, i: F.concat(g, F.lit(":"), F.size(F.filter(F.slice(every, 1, i), lambda h: h == g)).cast("string")))


def _prefixes(side: DataFrame, others: DataFrame, q: int, least: float) -> DataFrame:
    """``(_n, _w)``: for each name the tokens of which a partner has to share one, rarest first; names without a bound are left out."""
    length = F.char_length("_n").cast("double")
    both = length + F.ceil(length * least / (2 - least) - 1e-9)
    shared = F.ceil(1.5 * least * both - 1 - both - 1e-9) if q == 2 else F.ceil(least * both / 2 - 1e-9)
    tokens = lambda d: d.select("_n", F.explode(_tokens(F.col("_n"), q)).alias("_w"))
    ranks = tokens(side.unionByName(others)).groupBy("_w").agg(F.count("*").alias("_f"))
    held = tokens(side).join(ranks, "_w").groupBy("_n").agg(F.array_sort(F.collect_list(F.struct("_f", "_w"))).alias("_t"))
    return held.withColumn("_o", shared).where("_o > 0").select("_n", F.explode(F.slice("_t", F.lit(1), F.greatest(F.size("_t") - F.col("_o").cast("int") + 1, F.lit(0)))).alias("_e")).select("_n", F.col("_e._w").alias("_w"))


def similar_pairs(left: DataFrame, right: DataFrame, name: str, least: float) -> DataFrame:
    """``(a, b, similarity)`` of all pairs of different names on the left and the right whose block ratio is at least ``least`` (above 2/3)."""
    if not 2 / 3 < least <= 1:
        raise ValueError("the bound on shared bigrams needs a ratio above 2/3")
    ship(left.sparkSession)
    distinct = lambda d: materialise(d.select(F.col(name).alias("_n")).where(F.char_length("_n") > 0).distinct(), "names")
    a, b = distinct(left), distinct(right)
    # Below this length the bound on bigrams may say nothing for some partner.
    short = next(n for n in range(1, 1000) if (1.5 * least - 1) * (n + n * least / (2 - least)) - 1 > 1e-6)
    found = None
    for q, x, y in ((2, a, b), (1, a.where(F.char_length("_n") <= short * (2 - least) / least), b.where(F.char_length("_n") <= short * (2 - least) / least))):
        pairs = _prefixes(x, y, q, least).withColumnRenamed("_n", "a").join(_prefixes(y, x, q, least).withColumnRenamed("_n", "b"), "_w").select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
    # A name of few letters fails the length rule before anything is compared.
    fits = 2 * F.least(F.char_length("a"), F.char_length("b")) >= least * (F.char_length("a") + F.char_length("b")) - 1e-9
    scored = found.where(fits).distinct().withColumn("similarity", block_ratio("a", "b"))
    return scored.where(F.col("similarity") >= least - 1e-12)


def similar_names(left: DataFrame, right: DataFrame, lid: str, rid: str, name: str, least: float = 0.75, k: int = 3) -> DataFrame:
    """``(lid, rid, similarity, rank)``: for each left row the ``k`` right rows with the most similar names among those of at least ``least`` (ties: the smallest id).

    Equal names are compared once. Null and empty names have no partner. Of
    equal names on the right only the ``k`` smallest ids can be among the first
    ``k``, so no name brings more rows than that to a left row.
    """
    pairs = materialise(similar_pairs(left, right, name, least), "similar")
    ids = right.select(F.col(name).alias("b"), F.col(rid)).groupBy("b").agg(F.slice(F.array_sort(F.collect_set(rid)), 1, k).alias("_ids"))
    best = pairs.join(ids, "b").select("a", "similarity", F.explode("_ids").alias(rid))
    each = best.groupBy("a").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("s"), F.col(rid).alias("r")))), 1, k).alias("_best"))
    rows = left.select(F.col(lid), F.col(name).alias("a")).join(each, "a").select(lid, F.posexplode("_best").alias("_k", "_b"))
    return rows.select(lid, F.col("_b.r").alias(rid), (-F.col("_b.s")).alias("similarity"), (F.col("_k") + 1).alias("rank"))
