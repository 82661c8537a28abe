"""Queries of this subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from quillon.llm import op1_lines, op2_norm_topk, op3_chat, op4_packing, op5_simhash, op6_lm, op7_mixing, op8_warc, op9_quality, op10_hyperplane, op11_line_crf, op12_merkle, op13_prefix_trie


def queries() -> dict:
    found = [
        op1_lines.op1_line_dedup,
        op2_norm_topk.op2_norm_bucketed_topk,
        op3_chat.op3_chat_prefix_targets,
        op4_packing.op4_best_fit_packing,
        op5_simhash.op5_simhash_near_dedup,
        op6_lm.op6_attention_lm,
        op7_mixing.op7_mixing_to_targets,
        op8_warc.op8_warc_salvage,
        op9_quality.op9_quality_trees,
        op10_hyperplane.op10_hyperplane_near_dedup,
        op11_line_crf.op11_line_crf_rules,
        op12_merkle.op12_merkle_slot_pivot,
        op13_prefix_trie.op13_prefix_trie_bands,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """No SQL: tokenizers (4), XXH64 (5), trained models (6, 9, 11), hashed draws (7)."""
    sql = {
        "op1_line_dedup": op1_lines.ORACLE,
        "op2_norm_bucketed_topk": op2_norm_topk.ORACLE,
        "op3_chat_prefix_targets": op3_chat.ORACLE,
        "op8_warc_salvage": op8_warc.ORACLE,
        "op10_hyperplane_near_dedup": op10_hyperplane.ORACLE,
        "op12_merkle_slot_pivot": op12_merkle.ORACLE,
        "op13_prefix_trie_bands": op13_prefix_trie.ORACLE,
    }
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
