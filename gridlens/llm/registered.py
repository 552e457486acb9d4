"""The operators applied to the driver tables, and SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridlens import tune
from gridlens.llm import (
    automaton, byte_pairs, collisions, lines, merkle, mixing, quality, rank_index, repair, simhash, suffix_tree, token_counts,
    vectors,
)
from gridlens.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: query(read(tune(spark), folder, table))


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": _over("documents", byte_pairs.round_trip),
    "op2_curriculum_mix": _over("documents", mixing.mix_sizes),
    "op3_whole_tokens": _over("documents", token_counts.document_counts),
    "op4_fourier_quality": lambda spark, folder: quality.score_documents(
        read(tune(spark), folder, "documents"), read(spark, folder, "labels")),
    "op5_merkle_tree": _over("documents", merkle.fingerprints),
    "op6_product_quantisation": _over("embeddings", vectors.vector_components),
    "op7_simhash_blocks": _over("documents", simhash.document_components),
    "op8_line_dedup": _over("documents", lines.document_lines),
    "op9_suffix_tree": _over("documents", suffix_tree.document_scores),
    "op10_repair_ids": lambda spark, folder: repair.stored_documents(tune(spark), folder),
    "op11_automaton_rank": lambda spark, folder: automaton.search(
        read(tune(spark), folder, "documents"), read(spark, folder, "benchmark")),
    "op12_collision_search": _over("embeddings", collisions.nearest_vectors),
    "op13_rank_index": _over("documents", rank_index.document_forms),
}

ORACLES: dict[str, str] = {
    "op2_curriculum_mix": mixing.sql(),
    "op5_merkle_tree": merkle.sql(),
    "op6_product_quantisation": vectors.sql(),
    "op8_line_dedup": lines.sql(),
    "op11_automaton_rank": automaton.sql(),
    "op12_collision_search": collisions.sql(),
    "op13_rank_index": rank_index.sql(),
}
