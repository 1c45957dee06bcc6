"""Queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from odmeter.llm import bitpack, harmonic, host_rules, lexical, lm_whole, mixing, near_copies, near_vectors, packing, pii
from odmeter.llm import prefix_trie, quality_model, repeats

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_cross_entropy_difference": lm_whole.op1_cross_entropy_difference,
    "op2_personal_data": pii.op2_personal_data,
    "op3_quality_classifier": quality_model.op3_quality_classifier,
    "op4_near_copies": near_copies.op4_near_copies,
    "op5_near_vectors": near_vectors.op5_near_vectors,
    "op6_host_rules": host_rules.op6_host_rules,
    "op7_bitpack_tokens": bitpack.op7_bitpack_tokens,
    "op8_remove_repeats": repeats.op8_remove_repeats,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_ranked_search": lexical.op11_ranked_search,
    "op12_harmonic_packing": harmonic.op12_harmonic_packing,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLES = {
    "op1_cross_entropy_difference": lm_whole.ORACLE,
    "op5_near_vectors": near_vectors.ORACLE,
    "op6_host_rules": host_rules.ORACLE,
    "op9_mix_sources": mixing.ORACLE,
    "op11_ranked_search": lexical.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
