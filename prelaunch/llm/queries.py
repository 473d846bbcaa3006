"""Registered queries of the package and their DuckDB oracles."""

from __future__ import annotations

from prelaunch.llm import (decontaminate, embedding_dedup, html_text, language_id, merkle, mixing, ngram_join, surrogates, token_counts,
                           topk_search, toxicity, url_reputation, whitening)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_url_filter": url_reputation.op2_url_filter,
    "op3_topk": topk_search.op3_topk,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_html_extraction": html_text.op5_html_extraction,
    "op6_mixing": mixing.op6_mixing,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_pii": surrogates.op8_pii,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_embedding_dedup": embedding_dedup.op12_embedding_dedup,
    "op13_whitening": whitening.op13_whitening,
}

# Learned, hashed and wrapped results and eigenvectors (1, 4, 5, 7, 8, 9, 13) are tested against brute force or held-out rows instead.
ORACLE = {
    "op2_url_filter": url_reputation.ORACLE_SQL,
    "op3_topk": topk_search.ORACLE_SQL,
    "op6_mixing": mixing.ORACLE_SQL,
    "op10_decontamination": decontaminate.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
    "op12_embedding_dedup": embedding_dedup.ORACLE_SQL,
}
