"""Operators of a training-data pipeline: one module each, one registered query each."""

from __future__ import annotations

from strata.llm import (
    decontamination,
    hard_negatives,
    language_id,
    line_dedup,
    mtree,
    prefix_trie,
    quality_rules,
    sentencepiece,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)

#: query name → (spark, sf_dir) → DataFrame
QUERIES = {
    "op1_sentencepiece": sentencepiece.op1_sentencepiece,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_simhash": simhash.op5_simhash,
    "op6_warc": warc.op6_warc,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_language_id": language_id.op9_language_id,
    "op10_mtree_topk": mtree.op10_mtree_topk,
    "op11_quality_rules": quality_rules.op11_quality_rules,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

#: DuckDB SQL of the queries that SQL can express
ORACLE: dict[str, str] = {
    "op4_line_dedup": line_dedup.ORACLE,
    "op6_warc": warc.ORACLE,
    "op10_mtree_topk": mtree.ORACLE,
    "op11_quality_rules": quality_rules.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
