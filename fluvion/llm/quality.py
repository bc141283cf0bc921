"""Quality rules: minimum-covariance-determinant outliers per language and source.

Every document gets a vector of transformed statistics. For each group of one
language and source, the centre and scatter come from the share ``H`` of
documents with the smallest scatter determinant, found by concentration steps
from two deterministic starts. Small groups are shrunk toward the estimate of
their language, and small languages toward that of all rows. A document whose Mahalanobis distance exceeds a
chi-squared quantile is rejected. All of it is DataFrame code: moments and
quantiles are mergeable aggregates (partial sums and counts before each
shuffle), so a group that holds a third of the corpus costs one row per task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.llm.textstats import word_statistics
from fluvion.session import materialise

#: Share of each group that the estimates rest on.
H = 0.75
#: Concentration steps after each start at most; they end when no determinant's logarithm moves by more than SETTLED.
STEPS, SETTLED = 8, 1e-3
#: Documents, ten for each dimension, from which a group's own estimate stands alone; that of a smaller group is shrunk.
MIN_GROUP = 40
#: Tail probability of the chi-squared cutoff.
TAIL = 1e-6
#: Statistics and the standard deviation added to each, so that a constant statistic has a scatter.
FLOORS = {"x_word_length": 0.3, "x_symbols": 0.012, "x_dup_lines": 0.04, "x_repeats": 0.05}


def chi2_cdf(x: float, dof: int) -> float:
    """Chi-squared distribution for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return (low + high) / 2


def vectors(stats: DataFrame) -> DataFrame:
    """Adds the transformed statistics. Rates are damped by 50 words (10 lines), so short texts vary no more than long ones."""
    n = F.col("n_words")
    return (
        stats.withColumn("x_word_length", (F.col("word_chars") + 300) / (n + 50))
        .withColumn("x_symbols", F.col("n_symbols") / (F.col("n_chars") + 300))
        .withColumn("x_dup_lines", F.col("n_dup_lines") / (F.col("n_lines") + 10))
        .withColumn("x_repeats", F.col("n_repeat_words") / (n + 50))
    )


def bin_quantile(df: DataFrame, keys: list[str], value: Column, p: float, out: str) -> DataFrame:
    """Per key, the upper edge of the bin in which the share ``p`` is reached.

    ``value`` is an integer bin. Counts merge exactly, so the result depends
    neither on the partitioning nor on the order of rows, unlike a sketch.
    """
    counts = df.groupBy(*keys, value.alias("_bin")).agg(F.count("*").alias("_n"))
    by = Window.partitionBy(*keys)
    cumulated = counts.withColumn("_c", F.sum("_n").over(by.orderBy("_bin"))).withColumn("_t", F.sum("_n").over(by))
    return cumulated.where(F.col("_c") >= F.lit(p) * F.col("_t")).groupBy(*keys).agg((F.min("_bin") + 1).alias(out))


def distance(names: list[str], prefix: str) -> Column:
    """Squared Mahalanobis distance from centre ``{prefix}_m_i`` under precision ``{prefix}_p_i_j``."""
    terms = []
    for i, a in enumerate(names):
        for j in range(i + 1):
            b = names[j]
            term = (F.col(a) - F.col(f"{prefix}_m_{i}")) * (F.col(b) - F.col(f"{prefix}_m_{j}")) * F.col(f"{prefix}_p_{i}_{j}")
            terms.append(term if i == j else 2 * term)
    return F.greatest(reduce(lambda a, b: a + b, terms), F.lit(0.0))


def precision(groups: DataFrame, p: int, prefix: str) -> DataFrame:
    """From covariances ``{prefix}_c_i_j`` the precision ``{prefix}_p_i_j`` and ``{prefix}_logdet``, by a Cholesky factor."""
    c = lambda k, i, j: F.col(f"{prefix}_{k}_{i}_{j}")
    for i in range(p):
        for j in range(i + 1):
            rest = reduce(lambda a, b: a + b, [c("l", i, k) * c("l", j, k) for k in range(j)], F.lit(0.0))
            value = F.sqrt(c("c", i, i) - rest) if i == j else (c("c", i, j) - rest) / c("l", j, j)
            groups = groups.withColumn(f"{prefix}_l_{i}_{j}", value)
    for j in range(p):
        for i in range(j, p):
            rest = reduce(lambda a, b: a + b, [c("l", i, k) * c("v", k, j) for k in range(j, i)], F.lit(0.0))
            groups = groups.withColumn(f"{prefix}_v_{i}_{j}", (F.lit(1.0 if i == j else 0.0) - rest) / c("l", i, i))
    for i in range(p):
        for j in range(i + 1):
            groups = groups.withColumn(f"{prefix}_p_{i}_{j}", reduce(lambda a, b: a + b, [c("v", k, i) * c("v", k, j) for k in range(i, p)]))
    logdet = reduce(lambda a, b: a + b, [2 * F.log(c("l", i, i)) for i in range(p)])
    return groups.withColumn(f"{prefix}_logdet", logdet).drop(*[x for x in groups.columns if x.startswith((f"{prefix}_l_", f"{prefix}_v_"))])


def consistency(share: Column, p: int) -> Column:
    """What the scatter of the nearest ``share`` of normal rows is multiplied by to be that of all: read off at steps of one in 200."""
    places = 200
    table = [1.0 if k == places else k / places / chi2_cdf(chi2_quantile(k / places, p), p + 2) for k in range(1, places + 1)]
    return F.element_at(F.array(*map(F.lit, table)), F.greatest(F.least(F.round(share * places).cast("int"), F.lit(places)), F.lit(1)))


def _log_bin(d2: Column) -> Column:
    return F.floor(F.log(d2 + F.lit(1e-9)) * 20).cast("long")


def mcd(rows: DataFrame, names: list[str], floors: list[float], h: float = H, steps: int = STEPS) -> DataFrame:
    """Per ``_group``: centre ``a_m_i``, scatter ``a_c_i_j`` and precision ``a_p_i_j`` of the start with the smaller determinant."""
    p = len(names)
    scale = 1000.0
    long = rows.select("_group", F.posexplode(F.array(*[F.col(x) for x in names])).alias("_k", "_x"))
    median = bin_quantile(long, ["_group", "_k"], F.floor(F.col("_x") * scale).cast("long"), 0.5, "_m").withColumn("_m", (F.col("_m") - 0.5) / scale)
    median = materialise(median, "mcd-median")
    off = long.join(median, ["_group", "_k"]).select("_group", "_k", F.abs(F.col("_x") - F.col("_m")).alias("_x"))
    mad = bin_quantile(off, ["_group", "_k"], F.floor(F.col("_x") * scale).cast("long"), 0.5, "_s").withColumn("_s", F.col("_s") * 1.4826 / scale)
    start = median.join(mad, ["_group", "_k"]).groupBy("_group").agg(
        *[F.max(F.when(F.col("_k") == i, F.col("_m"))).alias(f"m_{i}") for i in range(p)],
        *[F.max(F.when(F.col("_k") == i, F.col("_s") * F.col("_s") + floors[i] ** 2)).alias(f"s_{i}") for i in range(p)],
    )
    start = materialise(start, "mcd-start")
    z = [(F.col(x) - F.col(f"m_{i}")) * (F.col(x) - F.col(f"m_{i}")) / F.col(f"s_{i}") for i, x in enumerate(names)]
    # Start a ranks by the scaled Euclidean distance, start b by the largest coordinate.
    ranked = rows.join(start, "_group").select("_group", *names, reduce(lambda a, b: a + b, z).alias("_da"), F.greatest(*z).alias("_db"))
    # Bins hold whole ties, so a subset can hold more than h: its own share sets the factor.
    totals = rows.groupBy("_group").agg(F.count("*").alias("_all"))
    last = None
    for step in range(steps):
        both = ranked.select("_group", F.posexplode(F.array("_da", "_db")).alias("_start", "_d"), *names)
        cut = bin_quantile(both, ["_group", "_start"], _log_bin(F.col("_d")), h, "_cut")
        held = both.join(cut, ["_group", "_start"]).where(_log_bin(F.col("_d")) < F.col("_cut"))
        sums = held.groupBy("_group", "_start").agg(
            F.count("*").alias("_n"),
            *[F.sum(F.col(a)).alias(f"s_{i}") for i, a in enumerate(names)],
            *[F.sum(F.col(a) * F.col(names[j])).alias(f"q_{i}_{j}") for i, a in enumerate(names) for j in range(i + 1)],
        )
        sums = sums.join(totals, "_group").withColumn("_factor", consistency(F.col("_n") / F.col("_all"), p))
        mean = lambda i: F.col(f"s_{i}") / F.col("_n")
        cov = lambda i, j: F.col("_factor") * (F.col(f"q_{i}_{j}") / F.col("_n") - mean(i) * mean(j))
        one = sums.select(
            "_group",
            "_start",
            *[mean(i).alias(f"a_m_{i}") for i in range(p)],
            *[(F.greatest(cov(i, i), F.lit(0.0)) + floors[i] ** 2 if i == j else cov(i, j)).alias(f"a_c_{i}_{j}") for i in range(p) for j in range(i + 1)],
        )
        fitted = materialise(precision(one, p, "a"), f"mcd-step{step}")
        if last is not None:
            moved = fitted.join(last.select("_group", "_start", F.col("a_logdet").alias("_before")), ["_group", "_start"]).agg(F.max(F.abs(F.col("a_logdet") - F.col("_before")))).first()[0]
            if moved is None or moved <= SETTLED:
                break
        last = fitted
        if step < steps - 1:
            wide = fitted.where("_start = 0").drop("_start").join(
                fitted.where("_start = 1").drop("_start").select("_group", *[F.col(c).alias("b" + c[1:]) for c in fitted.columns if c.startswith("a_")]), "_group"
            )
            ranked = rows.join(wide, "_group").select("_group", *names, distance(names, "a").alias("_da"), distance(names, "b").alias("_db"))
    best = Window.partitionBy("_group").orderBy("a_logdet", "_start")
    return fitted.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r", "_start")


def shrunk(df: DataFrame, own: str, wider: str, out: str, n: Column, full: int, p: int) -> DataFrame:
    """Adds the centre ``{out}_m_i`` and scatter ``{out}_c_i_j`` of a mixture: the share n / ``full`` of ``own``, the rest of ``wider``.

    An estimate that is missing leaves all to the other; where both are, the result is null.
    """
    w = F.when(F.col(f"{own}_m_0").isNull(), 0.0).when(F.col(f"{wider}_m_0").isNull(), 1.0).otherwise(F.least(n / F.lit(full), F.lit(1.0)))

    def mix(name: str) -> Column:
        a, b = F.col(f"{own}_{name}"), F.col(f"{wider}_{name}")
        return F.when(F.col("_w") >= 1, a).when(F.col("_w") <= 0, b).otherwise(F.col("_w") * a + (1 - F.col("_w")) * b)

    apart = lambda i: F.col(f"{own}_m_{i}") - F.col(f"{wider}_m_{i}")
    between = lambda i, j: F.when((F.col("_w") > 0) & (F.col("_w") < 1), F.col("_w") * (1 - F.col("_w")) * apart(i) * apart(j)).otherwise(0.0)
    mixed = df.withColumn("_w", w)
    return mixed.select(
        "*", *[mix(f"m_{i}").alias(f"{out}_m_{i}") for i in range(p)], *[(mix(f"c_{i}_{j}") + between(i, j)).alias(f"{out}_c_{i}_{j}") for i in range(p) for j in range(i + 1)]
    ).drop("_w")


def robust_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_group: int = MIN_GROUP, tail: float = TAIL) -> DataFrame:
    """One row per input row: statistics, ``base_failed``, ``distance`` (squared) and ``kept``.

    Null text: no words, so it fails the base rules. Null language or source:
    a group of its own. Repeated rows are judged alike, each for itself.
    Every group is fitted on its n rows that pass the base rules. If n is below
    ``min_group``, the estimate is the mixture of n / ``min_group`` of it and
    the rest of its language's, which is shrunk likewise toward that of all
    rows; so ``distance`` is null only where no row at all passes. An empty
    table gives an empty result. Columns other than the four named are ignored,
    whatever their names.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    stats = vectors(word_statistics(d, ["doc_id", "lang", "source"]))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    lang, source = F.coalesce("lang", F.lit("\x02")), F.coalesce("source", F.lit("\x02"))
    stats = materialise(stats.select("*", failed.alias("base_failed"), F.concat_ws("\x01", lang, source).alias("_key"), lang.alias("_lang")).drop("lang", "source"), "quality")
    passed = stats.where(~F.col("base_failed"))
    own = Window.partitionBy("_lang")
    sizes = stats.groupBy("_key", "_lang").agg(F.count_if(~F.col("base_failed")).alias("_n"))
    groups = materialise(sizes.select("*", F.sum("_n").over(own).alias("_n_lang"), (F.min("_n").over(own) < min_group).alias("_small")), "quality-groups")
    # Only small groups need their language's estimate, and only those of small languages that of all rows.
    everywhere = not groups.where(F.col("_small") & (F.col("_n_lang") < min_group)).isEmpty()
    levels = [F.concat(F.lit("\x03"), "_key"), F.when(F.col("_small"), F.concat(F.lit("\x04"), "_lang")), *([F.lit("\x05")] if everywhere else [])]
    names, floors = list(FLOORS), list(FLOORS.values())
    p = len(names)
    # Every step reads only this: a group and four numbers a row and level.
    leveled = passed.join(groups.drop("_lang"), "_key").select(F.explode(F.array_compact(F.array(*levels))).alias("_group"), *names)
    fitted = materialise(mcd(materialise(leveled, "quality-vectors"), names, floors), "quality-fits")
    parts = [f"m_{i}" for i in range(p)] + [f"c_{i}_{j}" for i in range(p) for j in range(i + 1)]
    level = lambda prefix, mark: fitted.where(F.col("_group").startswith(mark)).select(F.substring("_group", 2, 1 << 30).alias(f"_{prefix}"), *[F.col(f"a_{x}").alias(f"{prefix}_{x}") for x in parts])
    known_at = groups.join(level("o", "\x03"), F.col("_key") == F.col("_o"), "left").join(level("l", "\x04"), F.col("_lang") == F.col("_l"), "left").join(level("g", "\x05"), F.col("_g") == "", "left")
    models = shrunk(shrunk(known_at, "l", "g", "w", F.col("_n_lang"), min_group, p), "o", "w", "a", F.col("_n"), min_group, p)
    models = materialise(precision(models.select("_key", *[f"a_{x}" for x in parts]), p, "a"), "quality-models")
    judged = stats.join(models, "_key", "left").withColumn("distance", distance(names, "a"))
    # A null distance has no centre to be measured from; greatest() skips nulls, so it is set apart here.
    known = F.col("a_m_0").isNotNull()
    cutoff = chi2_quantile(1 - tail, len(names))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (~known | (F.col("distance") <= cutoff))).alias("kept"),
        F.when(known, F.col("distance")).alias("distance"),
    )
