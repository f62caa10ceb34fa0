"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from wordstats.llm import (
    byte_bpe,
    clustering,
    fingerprints,
    hilbert,
    language,
    mixing,
    packing,
    secrets,
    simhash,
    topk,
    toxicity,
    url_filter,
    vector_codes,
)

QUERIES = {
    "op1_order_minhash": fingerprints.query,
    "op2_url_filters": url_filter.query,
    "op3_exact_topk": topk.query,
    "op4_toxicity": toxicity.query,
    "op5_secrets": secrets.query,
    "op6_hilbert_shards": hilbert.query,
    "op7_simhash": simhash.query,
    "op8_mixing": mixing.query,
    "op9_language": language.query,
    "op10_byte_bpe": byte_bpe.query,
    "op11_clustering": clustering.query,
    "op12_vector_codes": vector_codes.query,
    "op13_packing": packing.query,
}

ORACLE = {
    "op2_url_filters": url_filter.ORACLE,
    "op3_exact_topk": topk.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op11_clustering": clustering.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
