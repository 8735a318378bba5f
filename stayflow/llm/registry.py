"""Queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from stayflow.llm import (chat_format, exact_dedup, jaccard_join, lm_scoring, packing, personal_data,
                          quality_ranking, quality_rules, sentence_pieces, source_divergence,
                          token_alignment, token_counts, warc)

QUERIES = {
    "op1_sentence_pieces": sentence_pieces.op1_sentence_pieces,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_lm_scoring": lm_scoring.op4_lm_scoring,
    "op5_warc_derivatives": warc.op5_warc_derivatives,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_personal_data": personal_data.op7_personal_data,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_source_divergence": source_divergence.op11_source_divergence,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_quality_ranking": quality_ranking.op13_quality_ranking,
}

ORACLE = {
    "op2_chat_format": chat_format.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op11_source_divergence": source_divergence.ORACLE,
}
