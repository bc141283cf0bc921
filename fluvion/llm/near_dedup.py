"""MinHash near-duplicate groups with SuperMinHash signatures.

1. Each text gets a SuperMinHash signature of its five-word shingles: every
   shingle ranks the slots by one random permutation, so the slots of a
   signature are correlated and its variance is below plain MinHash; a text is
   done as soon as all its slots are filled.
2. Equal texts collapse into one class. The classes' signatures are cut into
   bands; classes that share a band are tied to the band's smallest member
   (never pair by pair), and the ties' components are the families.
3. Inside a family every pair is compared on its full shingle sets, in blocks
   of bounded bytes; a block reports a spanning forest of its links.
4. Distributed union-find over the links gives the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.llm.bits import may_hold
from fluvion.llm.mixing import mix
from fluvion.operators.graph import connected_components
from fluvion.session import materialise, ship, tidy

#: Words of a shingle; bands and slots a band. A pair at similarity 0.85 shares no band with probability 1.2e-7.
SHINGLE, BANDS, ROWS = 5, 50, 8
#: Two sets are linked if 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Shingles whose permutations a task holds at once (two bytes a slot each).
CHUNK = 20_000
#: Texts and bytes of text of a block, on average.
BLOCK_ROWS, BLOCK_BYTES = 1500, 8_000_000

_A = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def shingles(text: str | None) -> tuple[bytes | None, np.ndarray]:
    """A digest of the lower-cased word sequence, and the sorted distinct shingle hashes; (None, empty) without words.

    Words are runs of characters other than space and \\x09-\\x0D; only A-Z are
    lower-cased. Fewer than five words make one shingle.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return None, np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = hashlib.md5(joined, usedforsecurity=False).digest()
    n = len(words) - SHINGLE + 1
    if n < 1:
        return digest, np.array([xxhash.xxh3_64_intdigest(joined)], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    total = h[:n] * _A[0]
    for k in range(1, SHINGLE):
        total += h[k : k + n] * _A[k]
    return digest, np.unique(mix(total))


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Signatures of non-empty sets, one row each.

    Round j takes place j of every shingle's permutation. A slot first hit in
    round j has a value in [j, j + 1), below that of any later round, so its
    value is the smallest draw of that round, and a set whose slots are all
    filled stops early. A large set is taken in parts: its signature is the
    least of theirs, slot by slot, so memory does not grow with a text.
    """
    parts = [s[k : k + CHUNK] for s in sets for k in range(0, len(s), CHUNK)]
    counts = np.array([-(-len(s) // CHUNK) for s in sets])
    return np.minimum.reduceat(_signatures(parts, m), np.cumsum(counts) - counts) if len(sets) else np.zeros((0, m), np.uint64)


def _signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    out = np.zeros((len(sets), m), dtype=np.uint64)
    start = 0
    while start < len(sets):
        stop, size = start, 0
        while stop < len(sets) and (stop == start or size + len(sets[stop]) <= CHUNK):
            size += len(sets[stop])
            stop += 1
        lengths = np.array([len(s) for s in sets[start:stop]])
        owner = np.repeat(np.arange(stop - start), lengths)
        seeds = np.concatenate(sets[start:stop])
        slots = np.tile(np.arange(m, dtype=np.uint16), (len(seeds), 1))
        rows = np.arange(len(seeds))
        best = np.full((stop - start) * m, np.iinfo(np.uint64).max, dtype=np.uint64)
        empty = np.full(stop - start, m)
        for j in range(m):
            draw = mix(seeds + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            k = j + ((draw >> np.uint64(44)) * np.uint64(m - j) >> np.uint64(20)).astype(np.int64)
            chosen = slots[rows, k]
            slots[rows, k] = slots[rows, j]
            # The round is the high part of the value, the draw's low 40 bits the rest.
            value = (np.uint64(j) << np.uint64(40)) | (draw & np.uint64((1 << 40) - 1))
            at = owner * m + chosen
            free = best[at] == np.iinfo(np.uint64).max
            at, value = at[free], value[free]
            np.minimum.at(best, at, value)
            filled = np.unique(at)
            empty -= np.bincount(filled // m, minlength=len(empty))
            left = empty[owner] > 0
            if not left.any():
                break
            if not left.all():
                owner, seeds, slots = owner[left], seeds[left], slots[left]
                rows = np.arange(len(seeds))
        out[start:stop] = best.reshape(stop - start, m)
        start = stop
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; equal keys of one band mean equal slots."""
    keys = np.zeros((len(signatures), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signatures[:, r : bands * rows : rows] + np.uint64(r + 1))
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("n_bytes", pa.int64()), ("bands", pa.list_(pa.int64()))])


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) to (doc_id, digest, n_shingles, n_bytes, bands)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 400):
            some = batch.slice(at, 400)
            texts = some.column(1).to_pylist()
            made = [shingles(t) for t in texts]
            place, sets = {}, []
            for digest, s in made:
                if digest is not None and digest not in place:
                    place[digest] = len(sets)
                    sets.append(s)
            keys = band_keys(superminhash(sets, BANDS * ROWS), BANDS, ROWS) if sets else np.zeros((0, BANDS), np.int64)
            bands = [keys[place[d]] if d is not None else None for d, _ in made]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([d for d, _ in made], pa.binary()), pa.array([len(s) for _, s in made], pa.int64()), pa.array([len((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                schema=SIGNED,
            )


def linked_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of linked sets with i in ``left`` and j in ``right``, by exact intersection counts."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[code] > 1
    owner, code = owner[shared], np.unique(code[shared], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    where_l, where_r = np.full(len(sets), -1), np.full(len(sets), -1)
    where_l[left], where_r[right] = np.arange(len(left)), np.arange(len(right))
    width = 4096
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [low, low + width])
        o, c = owner[a:b], code[a:b] - low
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        il, ir = where_l[o] >= 0, where_r[o] >= 0
        x[where_l[o[il]], c[il]] = 1
        y[where_r[o[ir]], c[ir]] = 1
        common += x @ y.T
    n = common.astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - n
    i, j = np.nonzero(100 * n >= percent * union)
    return left[i], right[j]


def forest(n: int, pairs: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """The pairs that join two trees when taken in turn: union-find with path halving."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(pairs[0].tolist(), pairs[1].tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def block_links(percent: int):
    """Grouped function: the texts of one pair of blocks to a spanning forest of their links."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["doc_id", "digest"])
        ids, block = rows["doc_id"].to_numpy(), rows["block"].to_numpy()
        sets = [shingles(t)[1] for t in rows["text"]]
        one, two = rows["one"].iloc[0], rows["two"].iloc[0]
        left, right = np.nonzero(block == one)[0], np.nonzero(block == two)[0]
        if not len(left) or not len(right):
            return pd.DataFrame({"src": pd.Series([], dtype="int64"), "dst": pd.Series([], dtype="int64")})
        i, j = linked_pairs(sets, left, right, percent)
        keep = i != j
        chosen = forest(len(sets), (i[keep], j[keep]))
        return pd.DataFrame({"src": ids[[a for a, _ in chosen]].astype("int64"), "dst": ids[[b for _, b in chosen]].astype("int64")})

    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts without words (null ones too) have an empty set and are linked with
    nothing. Rows that share a doc_id are one document: all its texts' links
    count. A row without doc_id is no node: its component_id is null and it is
    kept. Repeated rows come back as often as they came. Sets are compared by
    64-bit shingle hashes. An empty table gives no rows; other columns are
    ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, digest binary, n_shingles long, n_bytes long, bands array<long>"
    table = materialise(texts.mapInArrow(tidy(signed), schema), "signatures")
    wordy = table.where("digest is not null and doc_id is not null")

    # One class for each word sequence; its node is its smallest document.
    classes = materialise(wordy.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"), F.max("n_bytes").alias("n_bytes")), "classes")
    banded = classes.select("rep", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    ties = banded.join(shared, "band").where("rep <> first").select(F.col("rep").alias("src"), F.col("first").alias("dst")).distinct()
    families = materialise(connected_components(ties), "families").withColumnRenamed("node", "rep")

    sized = families.join(classes.select("rep", "digest", "n_bytes"), "rep")
    blocks = sized.groupBy("component").agg(F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n_bytes") / BLOCK_BYTES)).cast("int").alias("n_blocks"))
    members = materialise(sized.join(blocks, "component").select("component", "rep", "digest", "n_blocks", F.pmod(F.xxhash64("rep", "digest"), F.col("n_blocks")).cast("int").alias("block")), "members")
    # Texts that are surely no member's are dropped before their words are hashed and dealt out; then
    # a sort-merge join at every size: the members grow with the corpus, so they are never broadcast.
    keyed = may_hold(texts, members.select(F.col("rep").alias("doc_id")), "doc_id").withColumn("digest", word_digest("text"))
    named = members.select("component", F.col("rep").alias("_rep"), F.col("digest").alias("_digest"), "n_blocks", "block")
    found = keyed.join(named.hint("merge"), (F.col("doc_id") == F.col("_rep")) & (F.col("digest") == F.col("_digest"))).select("component", "doc_id", "digest", "n_blocks", "block", "text")
    dealt = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "component", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "doc_id", "digest", "text"
    )
    links = materialise(dealt.groupBy("component", "one", "two").applyInPandas(block_links(percent), "src long, dst long"), "links")

    # Texts of one doc_id are one node; then every class leads to its component.
    groups = connected_components(links.unionByName(same_document(classes, wordy)))
    leads = classes.select("digest", "rep").join(groups, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = table.select("doc_id", "digest", "n_shingles").join(leads, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def same_document(classes: DataFrame, wordy: DataFrame) -> DataFrame:
    """Ties between the classes of texts that share a doc_id; none where ids are unique."""
    several = wordy.groupBy("doc_id").agg(F.min("digest").alias("_low"), F.max("digest").alias("_high")).where("_low <> _high").select("doc_id")
    held = wordy.select("doc_id", "digest").join(several, "doc_id").distinct().join(classes.select("digest", "rep"), "digest")
    return held.select(F.col("doc_id").alias("src"), F.col("rep").alias("dst"))


def word_digest(text: str):
    """The digest of shingles(), by built-in functions: MD5 of the lower-cased words joined by one space."""
    from fluvion.llm.textstats import ascii_lower, words_of

    return F.unhex(F.md5(F.array_join(words_of(ascii_lower(F.col(text))), " ").cast("binary")))
