"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from turnloom.llm import (
    decontaminate,
    divergence,
    html_extract,
    jaccard_join,
    lexical_search,
    mixing,
    oracles,
    quotation,
    resampling,
    sharding,
    substring_dedup,
    suffix_tree,
    toxicity,
    whitening,
)

QUERIES = {
    "op1_lempel_ziv": substring_dedup.op1_lempel_ziv,
    "op2_divergence": divergence.op2_divergence,
    "op3_gated_recurrent": toxicity.op3_gated_recurrent,
    "op4_hypergeometric": sharding.op4_hypergeometric,
    "op5_fair_queueing": mixing.op5_fair_queueing,
    "op6_quotation": quotation.op6_quotation,
    "op7_suffix_automaton": decontaminate.op7_suffix_automaton,
    "op8_tree_model": html_extract.op8_tree_model,
    "op9_grouped_prefix": jaccard_join.op9_grouped_prefix,
    "op10_importance": resampling.op10_importance,
    "op11_refined_whitening": whitening.op11_refined_whitening,
    "op12_suffix_tree": suffix_tree.op12_suffix_tree,
    "op13_stratified_search": lexical_search.op13_stratified_search,
}

ORACLES = {
    "op1_lempel_ziv": oracles.OP1_SQL,
    "op5_fair_queueing": mixing.OP5_SQL,
    "op7_suffix_automaton": oracles.OP7_SQL,
    "op9_grouped_prefix": oracles.OP9_SQL,
    "op13_stratified_search": lexical_search.OP13_SQL,
}
