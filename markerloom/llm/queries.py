"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from markerloom.llm import embedding_dedup, filter_audit, language_id, license_scan, mixing, ngram_join, packing, prefix_trie, quality, secret_scan, sharding, suffix_dedup, topk


def queries() -> dict:
    return {
        "op1_license_scan": license_scan.op1_license_scan,
        "op2_exact_topk": topk.op2_exact_topk,
        "op3_source_mix": mixing.op3_source_mix,
        "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
        "op5_ngram_jaccard": ngram_join.op5_ngram_jaccard,
        "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
        "op7_language_id": language_id.op7_language_id,
        "op8_packing": packing.op8_packing,
        "op9_secret_scan": secret_scan.op9_secret_scan,
        "op10_quality": quality.op10_quality,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_prefix_trie": prefix_trie.op12_prefix_trie,
        "op13_sharding": sharding.op13_sharding,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.oracle(),
        "op2_exact_topk": topk.oracle(),
        "op4_embedding_dedup": embedding_dedup.oracle(),
        "op5_ngram_jaccard": ngram_join.oracle(),
        "op9_secret_scan": secret_scan.oracle(),
        "op11_filter_audit": filter_audit.oracle(),
        "op12_prefix_trie": prefix_trie.oracle(),
        "op13_sharding": sharding.oracle(),
    }
