"""The opN_ queries over the driver's tables and the DuckDB twin of each that SQL can express."""

from __future__ import annotations

from . import (bpe, conversation_repair, exact_dedup, host_rules, interpolation, licenses, mixing, page_text, prefix_trie,
               secrets_scan, setjoin, token_files, weak_quality)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_quality_classifier": weak_quality.op2_quality_classifier,
    "op3_lm_score": interpolation.op3_lm_score,
    "op4_bpe_roundtrip": bpe.op4_bpe_roundtrip,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_token_files": token_files.op6_token_files,
    "op7_secret_scan": secrets_scan.op7_secret_scan,
    "op8_ngram_jaccard_join": setjoin.op8_ngram_jaccard_join,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_host_quality": host_rules.op10_host_quality,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_page_text": page_text.op12_page_text,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

SQL = {
    "op1_mix_sources": mixing.SQL,
    "op7_secret_scan": secrets_scan.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op10_host_quality": host_rules.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
}
