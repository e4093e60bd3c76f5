"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import bpe, exact_dedup, filter_audit, fingerprints, html_extract, langid, lexical_search, licenses, mixing, ngram_join, secrets, sharding, toxicity

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_extract_html": html_extract.query,
    "op3_fingerprint": fingerprints.query,
    "op4_scan_secrets": secrets.query,
    "op5_mix_sources": mixing.query,
    "op6_language": langid.query,
    "op7_byte_bpe": bpe.query,
    "op8_shard": sharding.query,
    "op9_scan_licenses": licenses.query,
    "op10_ngram_join": ngram_join.query,
    "op11_lexical_search": lexical_search.query,
    "op12_toxicity": toxicity.query,
    "op13_filter_audit": filter_audit.query,
}

SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op5_mix_sources": mixing.SQL,
    "op10_ngram_join": ngram_join.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
