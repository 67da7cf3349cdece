"""The queries of this package, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import (
    conversation_trie,
    exact_dedup,
    fingerprints,
    jaccard_join,
    language_id,
    lexical_search,
    line_dedup,
    mixing,
    packing,
    sharding,
    token_output,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_simple8b_tokens": token_output.op1_simple8b_tokens,
    "op2_cube_mixing": mixing.op2_cube_mixing,
    "op3_sampled_splitters": sharding.op3_sampled_splitters,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_zstd_toxicity": toxicity.op6_zstd_toxicity,
    "op7_ngram_jaccard_join": jaccard_join.op7_ngram_jaccard_join,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_language_id": language_id.op9_language_id,
    "op10_i_match": fingerprints.op10_i_match,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_conversation_trie": conversation_trie.op13_conversation_trie,
}

SQL = {
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op5_url_filter": url_filter.OP5_SQL,
    "op11_line_dedup": line_dedup.OP11_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
    "op13_conversation_trie": conversation_trie.OP13_SQL,
}
