"""The queries of this package and their DuckDB twins."""

from __future__ import annotations

from basketflow.llm import chat, classifier, conversation_repair, decontamination, jaccard, language_model, lexical_search, pieces, pii, quality_rules, setsketch, sharding, suffix_dedup

QUERIES = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_sharding": sharding.op2_sharding,
    "op3_pii": pii.op3_pii,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_sentencepiece": pieces.op6_sentencepiece,
    "op7_quality_classifier": classifier.op7_quality_classifier,
    "op8_chat": chat.op8_chat,
    "op9_lm_scoring": language_model.op9_lm_scoring,
    "op10_jaccard_join": jaccard.op10_jaccard_join,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_setsketch": setsketch.op12_setsketch,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

ORACLE = {
    "op1_decontamination": decontamination.OP1_SQL,
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op8_chat": chat.OP8_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
