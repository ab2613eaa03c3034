"""Queries of the training-data operators, and the SQL where SQL can express them."""

from __future__ import annotations

from korbwerk.llm import bpe, decontaminate, divergence, negatives, perspectives, pii, quality, simhash, suffix_tree, token_counts, toxicity, url_filter, weighted_fingerprint

QUERIES = {
    "op1_suffix_tree": suffix_tree.query,
    "op2_perspectives": perspectives.query,
    "op3_decontaminate": decontaminate.query,
    "op4_toxicity": toxicity.query,
    "op5_url_filter": url_filter.query,
    "op6_pii": pii.query,
    "op7_token_counts": token_counts.query,
    "op8_bpe": bpe.query,
    "op9_simhash": simhash.query,
    "op10_quality": quality.query,
    "op11_divergence": divergence.query,
    "op12_hard_negatives": negatives.query,
    "op13_fingerprints": weighted_fingerprint.query,
}
ORACLE_SQL = {"op2_perspectives": perspectives.ORACLE_SQL, "op5_url_filter": url_filter.ORACLE_SQL, "op11_divergence": divergence.ORACLE_SQL, "op12_hard_negatives": negatives.ORACLE_SQL}
