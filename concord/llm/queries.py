"""Registered queries of the operators."""

from __future__ import annotations

from concord.llm import (
    bpe,
    cross_entropy,
    decontamination,
    embedding_dedup,
    hard_negatives,
    jaccard_join,
    license_scan,
    oracle,
    prefix_trie,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    warc,
)

QUERIES = {f.__name__: f for f in (
    quality_classifier.op1_quality_classifier,
    jaccard_join.op2_ngram_jaccard_join,
    suffix_dedup.op3_suffix_array_dedup,
    sharding.op4_min_cost_flow_sharding,
    warc.op5_warc_splittable,
    cross_entropy.op6_cross_entropy_difference,
    bpe.op7_byte_bpe,
    quality_rules.op8_quality_rules,
    license_scan.op9_license_scan,
    decontamination.op10_decontamination,
    hard_negatives.op11_hard_negatives,
    prefix_trie.op12_prefix_trie,
    embedding_dedup.op13_embedding_near_dedup,
)}

ORACLE_SQL = {**oracle.ORACLE_SQL, "op9_license_scan": license_scan.oracle()}

__all__ = ["ORACLE_SQL", "QUERIES"]
