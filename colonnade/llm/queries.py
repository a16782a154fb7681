"""The query of each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from colonnade.llm import (
    bpe,
    chat_preference,
    collocations,
    language_id,
    mixing,
    ngram_join,
    oracles,
    pii,
    quality_crf,
    quality_rules,
    substring_dedup,
    topk_tree,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_url_filter": url_filter.query,
    "op3_ngram_join": ngram_join.query,
    "op4_mixing": mixing.query,
    "op5_topk_tree": topk_tree.query,
    "op6_chat_preference": chat_preference.query,
    "op7_quality_crf": quality_crf.query,
    "op8_pii": pii.query,
    "op9_substring_dedup": substring_dedup.query,
    "op10_bpe": bpe.query,
    "op11_collocations": collocations.query,
    "op12_whitening": whitening.query,
    "op13_language_id": language_id.query,
}

ORACLES = {
    **oracles.ORACLES,
    "op5_topk_tree": topk_tree.ORACLE,
    "op6_chat_preference": chat_preference.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
