"""Corpus preparation in five stages, each one an operator of mapledger.llm over all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mapledger.llm import minmax, mixing, piece_transducer, private, quality
from mapledger.llm.steps import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 or more."""
    return minmax.one_of_each(docs, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to a mark of its kind; no document goes."""
    return private.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are thinned to the target weights of their domains; clean ones keep rate 1."""
    return mixing.drawn(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding them gives the text back."""
    return piece_transducer.encoded_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one_of_each),
    ("PII", redact),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: Learned models and shortest paths are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
