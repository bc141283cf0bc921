"""A corpus pipeline of five stages; each works on all that the one before kept.

Rows that share a doc_id are one document: they stay or go together. A row
without a doc_id is no document that another row can speak for: stages that
judge documents by their ids keep it. Columns other than doc_id, text, lang and
n_chars are carried along whatever their names; an empty table passes every
stage as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fluvion.llm.decontamination import decontaminate
from fluvion.llm.language import fit_languages, keep_identified
from fluvion.llm.near_dedup import near_duplicates
from fluvion.llm.sampled_pieces import sample_pieces
from fluvion.llm.secrets import fit_secrets, redact
from fluvion.session import materialise, settled, table


def without(docs: DataFrame, gone: Callable[[], DataFrame]) -> DataFrame:
    """``docs`` but for the ids that ``gone`` gives; rows without an id stay. The ids alone are kept of what was written to find them."""
    ids = settled(docs.sparkSession, lambda: gone().select("doc_id").distinct(), "gone")
    return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages.

    Texts that are null or empty, have no letter, or hold mostly unknown
    n-grams go, and so do all if no row has a label to learn from. Each row is
    judged by its own text; ties between languages keep the row either way.
    """
    return keep_identified(docs, fit_languages(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group.

    Texts without words are in no group. Rows that share an id are one node
    with all their links; repeated rows stay or go together.
    """
    return without(docs, lambda: near_duplicates(docs).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Null and wordless texts have no hits. If any row of an id is contaminated,
    all its rows go. An empty benchmark lets everything pass.
    """
    return without(docs, lambda: decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark.

    Spans that overlap are replaced as one; null texts stay null; the length
    column is renewed where the text changed, if there is one. Without labelled
    examples only the fixed patterns are found.
    """
    return redact(docs, fit_secrets(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of all documents, one row for each row: its key, ids, log-probabilities and inclusion chances.

    A null or empty text has one sample without ids. Rows with equal keys and
    texts get equal samples.
    """
    return sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages are not SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
