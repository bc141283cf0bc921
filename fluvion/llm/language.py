"""Language identification with bit-sliced Bloom filters of character n-grams.

Each place of the filter is a bit mask of languages, so one look-up (the AND of
three places) gives every language whose filter holds an n-gram. A text's
n-grams are looked up once, the masks' bits are counted per language, each
count is corrected for that language's false positives, and the largest share
decides. The filter has a fixed size, however many rows it was learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvion.llm.mixing import mix
from fluvion.session import ship, tidy

#: Documents of each language that the filter is learned from, about; the choice is by a hash of the id.
TRAIN_DOCS = 1500
#: Share of a language's n-grams that one n-gram needs; so no language has more than 1 / MIN_SHARE of them.
MIN_SHARE = 1e-4
#: Labels that can be learned; more are an error, as each adds to what the driver holds.
MAX_LANGUAGES = 2000
#: Places of the filter, a power of two, and places looked up for each n-gram.
PLACES, HASHES = 1 << 17, 3
#: Texts and characters handled at once.
ROWS, CHARS = 500, 500_000
#: Below this share of known n-grams (after correction) a text is taken for none of the languages.
MIN_SCORE = 0.25

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter; made once in each process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers and hashes of all trigrams with a letter in the middle, and whether each text has a letter.

    Texts are lower-cased; any other character counts as a word boundary.
    """
    low = [t.lower() for t in texts]
    points = np.frombuffer("\0".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])[: len(points) - 2] if low else np.zeros(0, np.int64)
    code = np.where(letters()[points], points, 0).astype(np.uint64)
    middle = code[1:-1]
    at = np.nonzero(middle)[0]
    gram = (code[at] << np.uint64(42)) | (middle[at] << np.uint64(21)) | code[at + 2]
    owner = owner[at]
    has = np.zeros(len(low), dtype=bool)
    has[owner] = True
    return owner, mix(gram), has


def places(gram: np.ndarray) -> list[np.ndarray]:
    return [((gram >> np.uint64(20 * k)) & np.uint64(PLACES - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class LanguageFilter:
    """languages in order of their bits; table of 64-bit masks, one slice for every 64 languages; false-positive rates."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of known n-grams, texts by languages; whether a text has a letter."""
        owner, gram, has = ngrams(texts)
        at = places(gram)
        total = np.maximum(np.bincount(owner, minlength=len(texts)), 1).astype(float)
        out = np.zeros((len(texts), len(self.languages)))
        for s in range(len(self.table)):
            mask = self.table[s][at[0]]
            for p in at[1:]:
                mask &= self.table[s][p]
            for bit in range(min(64, len(self.languages) - 64 * s)):
                k = 64 * s + bit
                found = np.bincount(owner[(mask >> np.uint64(bit)) & np.uint64(1) == 1], minlength=len(texts))
                rate = self.false_rate[k]
                out[:, k] = (found - rate * total) / (1 - rate) / total
        return np.clip(out, 0, 1), has

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 for a text that is null or has no letter. Ties go to the first language by name."""
        if not texts or not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        shares, has = self.shares([t or "" for t in texts])
        best = shares.argmax(axis=1)
        score = np.where(has, shares[np.arange(len(texts)), best], 0.0)
        return [self.languages[k] if h else "und" for k, h in zip(best.tolist(), has.tolist(), strict=True)], score


def pieces(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of texts with bounded numbers and characters (one text at least)."""
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and stop - start < ROWS and (stop == start or size + len(texts[stop] or "") <= CHARS):
            size += len(texts[stop] or "")
            stop += 1
        yield start, stop
        start = stop


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to (lang, gram, n), summed within each batch."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            own = [texts[i] for i in np.nonzero(langs == lang)[0]]
            for a, b in pieces(own):
                gram, n = np.unique(ngrams(own[a:b])[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> LanguageFilter:
    """Learn from about ``train_docs`` documents of each language that are not held out.

    The driver sees one row per language, MAX_LANGUAGES at most, and at most 1 / MIN_SHARE n-grams of each.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null").where(~held_out(F.col("_id")))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    if sizes.limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    draw = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1_000_000)) * F.col("_n") < F.lit(1_000_000 * train_docs)
    sample = rows.join(F.broadcast(sizes), "lang").where(draw).select("lang", "text")
    counts = sample.mapInArrow(tidy(count_ngrams), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("_t"))
    common = counts.join(totals, "lang").where(F.col("n") >= MIN_SHARE * F.col("_t")).select("lang", "gram").toPandas()
    languages = sorted(set(common["lang"]))
    table = np.zeros((max(1, (len(languages) + 63) // 64), PLACES), dtype=np.uint64)
    for k, lang in enumerate(languages):
        gram = common["gram"][common["lang"] == lang].to_numpy(dtype=np.int64).view(np.uint64)
        for p in places(gram):
            np.bitwise_or.at(table[k // 64], p, np.uint64(1 << (k % 64)))
    fill = np.array([((table[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
    return LanguageFilter(languages, table, fill**HASHES)


def identify(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, or where no
    language could be learned. Repeated rows get equal results; an empty table
    gives no rows; other columns are never read.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in pieces(texts):
                lang, score = model.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(tidy(predict), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageFilter, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text is in a learned language with at least ``min_score``."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for a, b in pieces(texts):
                lang, score = model.predict(texts[a:b])
                yield batch.slice(a, b - a).filter(pa.array([x != "und" and y >= min_score for x, y in zip(lang, score.tolist(), strict=True)]))

    return docs.mapInArrow(tidy(keep), docs.schema)


def language_ids(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out, then identify all rows."""
    return identify(docs, fit_languages(docs))
