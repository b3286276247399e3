"""Queries and SQL of this subpackage, by name."""

from __future__ import annotations

from helicase.llm import audit, bpe, chat, classifier, fingerprints, mixing, nearjoin, quality, secretscan, sharding, spelling, toxicity, warc

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op2_document_fingerprints": fingerprints.query,
    "op3_toxicity": toxicity.query,
    "op4_secret_scans": secretscan.query,
    "op5_sharding": sharding.query,
    "op6_bpe": bpe.query,
    "op7_quality_rules": quality.query,
    "op8_warc": warc.query,
    "op9_ngram_jaccard_join": nearjoin.query,
    "op10_mixing_sources": mixing.query,
    "op11_spelling_variants": spelling.query,
    "op12_quality_classifier": classifier.query,
    "op13_filter_audit": audit.query,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": chat.SQL,
    "op8_warc": warc.SQL,
    "op9_ngram_jaccard_join": nearjoin.SQL,
    "op10_mixing_sources": mixing.SQL,
    "op11_spelling_variants": spelling.SQL,
    "op13_filter_audit": audit.SQL,
}
