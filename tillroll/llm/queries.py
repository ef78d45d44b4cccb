"""Registered queries of the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

from tillroll.llm import (
    decontaminate, embedding_dedup, html_text, language_id, lm_score, mixing, ngram_join, packing, repeated_passages,
    spelling, token_align, token_files, url_rules,
)

QUERIES = {
    "op1_embedding_dedup": embedding_dedup.query,
    "op2_ngram_join": ngram_join.query,
    "op3_repeated_passages": repeated_passages.query,
    "op4_packing": packing.query,
    "op5_url_rules": url_rules.query,
    "op6_decontaminate": decontaminate.query,
    "op7_html_text": html_text.query,
    "op8_token_files": token_files.query,
    "op9_language_id": language_id.query,
    "op10_lm_score": lm_score.query,
    "op11_spelling": spelling.query,
    "op12_token_align": token_align.query,
    "op13_mixing": mixing.query,
}

ORACLE = {
    "op1_embedding_dedup": embedding_dedup.SQL,
    "op2_ngram_join": ngram_join.SQL,
    "op5_url_rules": url_rules.SQL,
}
