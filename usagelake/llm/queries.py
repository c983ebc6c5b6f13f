"""Registered queries of the subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from usagelake.llm import (
    chaining, collocations, cover_tree, lines, mixing, packing, pii, quality, sharding, simhash, suffix_array, topk,
    trie)
from usagelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.op1(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op2(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op3(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op4(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.op5(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op6(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op7(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op8(table(spark, sf_dir, "documents"))


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.op9(table(spark, sf_dir, "embeddings"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op10(table(spark, sf_dir, "embeddings"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.op11(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.op12(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.op13(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_suffix_array": op1_suffix_array,
    "op2_pii": op2_pii,
    "op3_sharding": op3_sharding,
    "op4_quality": op4_quality,
    "op5_chaining": op5_chaining,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_cover_tree": op9_cover_tree,
    "op10_topk": op10_topk,
    "op11_line_dedup": op11_line_dedup,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op6_mixing": mixing.ORACLE_SQL,
    "op10_topk": topk.ORACLE_SQL,
    "op11_line_dedup": lines.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
    "op13_prefix_trie": trie.ORACLE_SQL,
}
