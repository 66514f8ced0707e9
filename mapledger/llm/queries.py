"""Registered queries of the training-data operators: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapledger.llm import (
    alignment,
    chains,
    count_trees,
    cross_polytope,
    minmax,
    mixing,
    pair_index,
    piece_transducer,
    prefix_trie,
    private,
    quality,
    repeats,
    rotation_codes,
    statements,
)
from mapledger.llm.steps import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation_codes.classes(table(spark, sf_dir, "embeddings"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op3_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.classes(table(spark, sf_dir, "documents"), percent=85)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.found(table(spark, sf_dir, "documents"))


def op6_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_transducer.round_trip(table(spark, sf_dir, "documents"))


def op7_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.passages(table(spark, sf_dir, "documents"))


def op8_count_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_trees.recounted(table(spark, sf_dir, "documents"))


def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_index.digests(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.counted(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


Q: dict[str, Query] = {
    "op1_rotation_codes": op1_rotation_codes,
    "op2_repeats": op2_repeats,
    "op3_minmax": op3_minmax,
    "op4_quality": op4_quality,
    "op5_private": op5_private,
    "op6_piece_transducer": op6_piece_transducer,
    "op7_chains": op7_chains,
    "op8_count_trees": op8_count_trees,
    "op9_cross_polytope": op9_cross_polytope,
    "op10_mixing": op10_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pair_index": op12_pair_index,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op1_rotation_codes": statements.ROTATION_CODES,
    "op2_repeats": statements.REPEATS,
    "op3_minmax": statements.MINMAX,
    "op11_prefix_trie": statements.PREFIX_TRIE,
}
