"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and how often their ids meet.

The tokens of one tokenizer (B) are a static interval index over the bytes of a
text; for each token of the other (A) two bisections give the first and the
last B token that it overlaps. A gap between two A tokens that no B token spans
ends a group. All pairs of an A and a B token of one group are linked.

Words that neither tokenizer joins across are aligned once and kept. A document
is then a count of words, and its links are those of its words.

How many documents hold an id pair is counted in chunks: the encoding task
gives each distinct pair of a chunk once, with its documents. So a pair that is
in every document makes one row a chunk, and what is found for it returns to
the chunk in one row again. Documents meet what was found inside their chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.llm.wordcuts import KEPT, ByteWords, spelt, word_keys
from fluvion.session import materialise, ship, tidy

#: Texts encoded at once; distinct (document, pair) entries and bytes of group texts after which a chunk is closed.
ENCODE_ROWS, ENTRIES, GROUP_BYTES = 200, 300_000, 1 << 23
#: Characters of a word after which no word is kept beyond its batch.
LONG_KEPT = 100_000


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token the first and the last B token that share a byte with it.

    Tokens follow each other without gaps from byte 0, so their ends are the
    whole interval index. Both lists cover the same bytes.
    """
    if not len(a_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a_starts, b_starts = np.concatenate([[0], a_ends[:-1]]), np.concatenate([[0], b_ends[:-1]])
    return np.searchsorted(b_ends, a_starts, side="right"), np.searchsorted(b_starts, a_ends, side="left") - 1


def group_ends(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Indices of the A tokens after which no B token spans the gap."""
    return np.flatnonzero(np.append(last[:-1] < first[1:], True)) if len(first) else np.zeros(0, np.int64)


class Aligned(NamedTuple):
    """What a document holds; ``pairs`` are A id << 32 | B id, each once, with its links in ``times``. ``text`` is None where the bytes differ."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    text: bytes | None
    pairs: np.ndarray
    times: np.ndarray


FAILED = Aligned(0, 0, 0, 0, None, np.zeros(0, np.int64), np.zeros(0, np.int64))


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the spans that begin at ``starts``, one span after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class Numbers(dict):
    """Numbers of words in order of their first use; those that are new since the last call of ``new`` are listed."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number

    def new(self) -> list[str]:
        found, self.fresh = self.fresh, []
        return found


class Words:
    """Aligned words by number: facts (A tokens, B tokens, groups, links, sound), group texts, and pairs with their links from ``first`` on, ``size`` of them."""

    def __init__(self):
        self.number = Numbers()
        self.texts: list[bytes] = []
        self.facts, self.first, self.size = np.zeros((0, 5), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: list[str], facts: np.ndarray, texts: list[bytes], owner: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        """``owner`` is the place in ``keys`` of each pair's word; pairs come word by word."""
        size = np.bincount(owner, minlength=len(keys))
        self.first = np.concatenate([self.first, len(self.pairs) + np.cumsum(size) - size])
        self.size, self.facts = np.concatenate([self.size, size]), np.concatenate([self.facts, facts])
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])
        self.texts += texts


class Aligner:
    """Aligns words by a byte-level tokenizer file (A) and a piece model with byte fallback (B)."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = ByteWords(a_path, plain_specials=True)
        self.a_bytes = self.a.token_bytes()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.blank = self.b.piece_to_id("▁")
        #: Whether no token of either goes on from another character to a space, or holds a newline beside others.
        self.cuts_safely = self.a.cuts_safely and not any("\n" in p or "▁" in p.lstrip("▁") for p in pieces)
        self.words = Words()

    def b_ids(self, words: list[str]) -> list[list[int]]:
        """B's ids of words as spelt. The model puts a space before what it is given, so a leading one is left to it."""
        found = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        # Before a newline that space is a piece by itself, as no piece holds a newline.
        return [ids if w[0] == " " else ids[1:] if ids[:1] == [self.blank] else [] for w, ids in zip(words, found, strict=True)]

    def align(self, keys: list[str]) -> None:
        """Take in new words, given by their keys; those of a call are indexed and searched together."""
        words = [spelt(k) for k in keys]
        want = [w.encode() for w in words]
        a, b = list(map(self.a.encode_word, keys) if self.cuts_safely else self.a.encode(words)), self.b_ids(words)
        a_flat, b_flat = np.frombuffer(b"".join(a), "<u4").astype(np.int64), np.array([i for ids in b for i in ids], np.int64)
        a_n, b_n = np.array([len(x) // 4 for x in a], np.int64), np.array(list(map(len, b)), np.int64)
        a_word, b_word = np.repeat(np.arange(len(keys)), a_n), np.repeat(np.arange(len(keys)), b_n)
        sizes = np.array(list(map(len, want)), np.int64)
        spell = lambda flat, table: b"".join([table[i] for i in flat.tolist()])
        sound = (np.bincount(a_word, self.a_sizes[a_flat], len(keys)) == sizes) & (np.bincount(b_word, self.b_sizes[b_flat], len(keys)) == sizes)
        if not (sound.all() and spell(a_flat, self.a_bytes) == spell(b_flat, self.b_bytes) == b"".join(want)):
            a_from, b_from = np.cumsum(a_n) - a_n, np.cumsum(b_n) - b_n
            sound = np.array([spell(a_flat[i : i + n], self.a_bytes) == w == spell(b_flat[j : j + m], self.b_bytes) for w, i, n, j, m in zip(want, a_from, a_n, b_from, b_n, strict=True)], dtype=bool)
            a_keep, b_keep = sound[a_word], sound[b_word]
            a_flat, a_word, b_flat, b_word = a_flat[a_keep], a_word[a_keep], b_flat[b_keep], b_word[b_keep]
        first, last = overlaps(np.cumsum(self.a_sizes[a_flat]), np.cumsum(self.b_sizes[b_flat]))
        # A word's end is an end of both, so groups never cross words.
        ends = group_ends(first, last)
        a_ends, b_ends = ends + 1, (last[ends] if len(ends) else ends) + 1
        a_starts, b_starts = np.concatenate([[0], a_ends[:-1]])[: len(ends)], np.concatenate([[0], b_ends[:-1]])[: len(ends)]
        x, y = a_ends - a_starts, b_ends - b_starts
        word = a_word[a_starts]
        links, owner, pairs, times = x * y, [], [], []
        # All pairs of an A and a B token of a group, some groups at a time; then each pair of a word once.
        cuts = np.searchsorted(np.cumsum(links), np.arange(0, links.sum(), 1 << 20), side="right")
        for lo, hi in zip(cuts, [*cuts[1:], len(links)]):
            n, nx, ny = links[lo:hi], x[lo:hi], y[lo:hi]
            which = np.repeat(np.arange(hi - lo), n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            codes = a_flat[a_starts[lo:hi][which] + inside // ny[which]] << 32 | b_flat[b_starts[lo:hi][which] + inside % ny[which]]
            owner.append(word[lo:hi][which])
            pairs.append(codes)
        owner, pairs = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (owner, pairs))
        order = np.lexsort((pairs, owner))
        owner, pairs = owner[order], pairs[order]
        new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (pairs[1:] != pairs[:-1])])) if len(pairs) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(pairs)))
        groups = np.bincount(word, minlength=len(keys))
        facts = np.stack([np.where(sound, a_n, 0), np.where(sound, b_n, 0), groups, np.bincount(word, links, len(keys)).astype(np.int64), sound], axis=1).astype(np.int64)
        a_names, b_names = ([self.names[i] for i in flat.tolist()] for flat in (a_flat, b_flat))
        texts = [",".join(a_names[i:j]) + "|" + ",".join(b_names[k:m]) for i, j, k, m in zip(a_starts.tolist(), a_ends.tolist(), b_starts.tolist(), b_ends.tolist(), strict=True)]
        stops = np.cumsum(groups).tolist()
        self.words.add(keys, facts, [";".join(texts[i:j]).encode() for i, j in zip([0, *stops], stops)], owner[new], pairs[new], times)

    def documents(self, texts: list[str | None]) -> list[Aligned]:
        """Whole texts; those without tokens are ``FAILED``."""
        keys = [word_keys(t) if self.cuts_safely else [t if t[0] not in " \n" else " " + t] for t in texts if t]
        if len(self.words.texts) > KEPT:
            self.words = Words()
        w = self.words
        number, group_text = w.number.__getitem__, w.texts.__getitem__
        found = iter([list(map(number, k)) for k in keys])
        new = w.number.new()
        if new:
            self.align(new)
        out = []
        for t in texts:
            if not t:
                out.append(FAILED)
                continue
            numbers = next(found)
            each, times = np.unique(np.array(numbers, np.int64), return_counts=True)
            facts = times @ w.facts[each]
            if facts[4] < len(numbers):
                out.append(FAILED)
                continue
            size = w.size[each]
            at = spans(w.first[each], size)
            pairs, place = np.unique(w.pairs[at], return_inverse=True)
            links = np.bincount(place, w.times[at] * np.repeat(times, size), len(pairs)).astype(np.int64)
            out.append(Aligned(*facts[:4].tolist(), b";".join(map(group_text, numbers)), pairs, links))
        # Words too long to be kept make room at once.
        if any(len(k) > LONG_KEPT for k in new):
            self.words = Words()
        return out


_aligners: dict[tuple[str, str], Aligner] = {}
DOCUMENTS = "n_a long, n_b long, n_groups long, n_links long"
CHUNKS = f"chunk long, doc_id long, {DOCUMENTS}, groups string, picks binary, times binary, pairs array<long>, held array<long>"
ARROW_CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups", pa.string()), ("picks", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))]
)


def aligned_chunks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in chunks, and for each chunk one more row with its distinct pairs and the number of its documents that hold each.

    A document's ``picks`` are places in its chunk's ``pairs`` (unsigned 32-bit),
    its ``times`` the links of each (signed 64-bit), and ``groups`` the ids of its
    groups as ``a1,a2|b1;a3|b2,b3``.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligners.get((a_path, b_path))
        if aligner is None:
            aligner = _aligners[a_path, b_path] = Aligner(a_path, b_path)
        ids: list = []
        found: list[Aligned] = []
        entries = size = part = chunk = 0

        def close() -> pa.RecordBatch:
            n = len(ids)
            pairs, picks = np.unique(np.concatenate([f.pairs for f in found]), return_inverse=True)
            held = np.bincount(picks, minlength=len(pairs))
            cuts = np.cumsum([len(f.pairs) for f in found])[:-1]
            columns = [
                [part << 40 | chunk] * (n + 1), [*ids, None], *[[f[k] for f in found] + [None] for k in range(4)], [(f.text or b"").decode() for f in found] + [None],
                [p.astype("<u4").tobytes() for p in np.split(picks, cuts)] + [None], [f.times.astype("<i8").tobytes() for f in found] + [None],
                pa.array([None] * n + [pairs], pa.list_(pa.int64())), pa.array([None] * n + [held], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, ARROW_CHUNKS.types, strict=True)], schema=ARROW_CHUNKS)

        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                some = batch.slice(at, ENCODE_ROWS)
                part = some.column(0)[0].as_py()
                for i, f in zip(some.column(1).to_pylist(), aligner.documents(some.column(2).to_pylist()), strict=True):
                    ids.append(i)
                    found.append(f)
                    entries, size = entries + len(f.pairs), size + len(f.text or b"")
                    if entries >= ENTRIES or size >= GROUP_BYTES:
                        yield close()
                        ids, found, entries, size, chunk = [], [], 0, 0, chunk + 1
        if ids:
            yield close()

    return rows.mapInArrow(tidy(encode), CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, its documents corpus-wide (n_docs), and whether no other pair of its A id has more (best)."""
    pairs = chunks.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "held"))).select("chunk", F.col("pos"), F.col("col.pairs").alias("pair"), F.col("col.held").alias("held"))
    counts = pairs.groupBy("pair").agg(F.sum("held").alias("n_docs")).withColumn("_a", F.shiftright("pair", 32))
    # One row per A id of the vocabulary.
    highest = counts.groupBy("_a").agg(F.max("n_docs").alias("_most"))
    return counts.join(highest, "_a").select("pair", "n_docs", (F.col("n_docs") == F.col("_most")).alias("best"))


def token_alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = True) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and groups if wanted.

    A encodes a space and the text, B the text, before which it puts a space;
    strings of special tokens are plain text. Null and empty texts, and those
    whose tokens do not spell them, have no tokens: zeros, and an empty digest.
    ``n_best`` are links whose pair is in as many documents as any pair of its A
    id (ties count), ``count_sum`` the documents of a link's pair, summed. Each
    row is a document, also where ids are null or repeated; an empty table gives
    no rows; other columns are ignored. A text is encoded whole in one worker; a
    long one is a chunk by itself.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).when(F.col("n_a") == 0, "").alias("groups_sha256")
    groups = ["groups"] if with_groups else []
    chunks = materialise(aligned_chunks(docs, a_path, b_path, id_col, text_col).select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, *groups, "picks", "times", "pairs", "held"), "aligned")
    pairs = chunks.where("pairs IS NOT NULL").select("chunk", F.posexplode("pairs").alias("pos", "pair"))
    found = pairs.join(pair_counts(chunks), "pair").select(F.col("chunk").alias("_chunk"), "pos", "n_docs", "best")
    held = chunks.where("pairs IS NULL").drop("pairs", "held")
    named = [f for f in held.schema.fields if f.name not in ("chunk", "picks", "times")]

    def meet(rows: pa.Table, facts: pa.Table) -> pa.Table:
        # A chunk's facts in the order of its pairs.
        at = facts.column("pos").to_numpy()
        docs_of, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        docs_of[at], best[at] = facts.column("n_docs").to_numpy(), facts.column("best").to_numpy(zero_copy_only=False)
        sums, bests = [], []
        for picks, times in zip(rows.column("picks").to_pylist(), rows.column("times").to_pylist(), strict=True):
            picks, times = np.frombuffer(picks, "<u4"), np.frombuffer(times, "<i8")
            sums.append(int(docs_of[picks] @ times))
            bests.append(int(best[picks] @ times))
        out = rows.select([f.name for f in named])
        return out.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named) + ", n_best long, count_sum long"
    joined = held.groupBy("chunk").cogroup(found.groupBy("_chunk")).applyInArrow(meet, schema)
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *groups)
