"""Registered queries of the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

from basketry.llm import (
    bpe_codec,
    fm_dedup,
    langid,
    lexical,
    line_dedup,
    mixing,
    near_dedup,
    quality_lm,
    site_quality,
    sp_codec,
    suffix_dedup,
    topk,
    whitening,
)

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_fm_dedup": fm_dedup.op4_fm_dedup,
    "op5_quality_rules": quality_lm.op5_quality_rules,
    "op6_sentencepiece": sp_codec.op6_sentencepiece,
    "op7_top_k": topk.op7_top_k,
    "op8_site_quality": site_quality.op8_site_quality,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_whitening": whitening.op11_whitening,
    "op12_byte_bpe": bpe_codec.op12_byte_bpe,
    "op13_ranked_search": lexical.op13_ranked_search,
}

ORACLE_SQL = {
    "op3_mix_sources": mixing.ORACLE_SQL,
    "op7_top_k": topk.ORACLE_SQL,
    "op13_ranked_search": lexical.ORACLE_SQL,
}
