"""From raw documents to training tokens: the stages, and ``run`` that applies them.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``; the last one returns the digests of
the tokens, a row for each time a document is in the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caremart.llm import bpe, chosen_path, language, line_dedup, mixing
from caremart.sources.tables import staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters and those of no learned language go."""
    return language.keep_identified(docs)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that their source has on too many of its distinct texts."""
    return line_dedup.drop_boilerplate(docs, copies=False)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    return chosen_path.keep_one_of_each(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them."""
    return mixing.mix_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's tokens and of the text that they decode to."""
    return bpe.round_trip(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_boilerplate_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

#: SQL has neither the models nor the trees of these stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
