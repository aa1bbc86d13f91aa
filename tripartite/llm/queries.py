"""One query for each operator, on the tables it is meant for, and SQL where it can say the same."""

from __future__ import annotations

from tripartite.llm import (
    conversation,
    decontaminate,
    exact_dedup,
    fill_middle,
    html_text,
    jaccard_join,
    language_id,
    lm_scoring,
    packing,
    quality,
    token_counts,
    toxicity,
    vector_search,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_language_id": language_id.op5_language_id,
    "op6_lm_scoring": lm_scoring.op6_lm_scoring,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_packing": packing.op8_packing,
    "op9_html_extraction": html_text.op9_html_extraction,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_conversation_repair": conversation.op11_conversation_repair,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_vector_search": vector_search.op13_vector_search,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op7_decontamination": decontaminate.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op12_fill_middle": fill_middle.ORACLE,
    "op13_vector_search": vector_search.ORACLE,
}
