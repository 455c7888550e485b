"""The registered queries of the training-data operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm import bpe, classifier, convtrie, jaccard, mixing, pii, preferences, quality_rules, spelling, tokenfile, topk, toxicity, urlfilter

QUERIES = {
    "op1_ngram_jaccard": jaccard.op1_ngram_jaccard,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_mixing": mixing.op3_mixing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_pii": pii.op6_pii,
    "op7_url_filter": urlfilter.op7_url_filter,
    "op8_quality_classifier": classifier.op8_quality_classifier,
    "op9_preference_pairs": preferences.op9_preference_pairs,
    "op10_exact_topk": topk.op10_exact_topk,
    "op11_conversation_trie": convtrie.op11_conversation_trie,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_token_files": tokenfile.op13_token_files,
}
ORACLES = {"op7_url_filter": urlfilter.OP7_SQL, "op9_preference_pairs": preferences.OP9_SQL, "op10_exact_topk": topk.OP10_SQL,
           "op11_conversation_trie": convtrie.op11_conversation_trie,
    "op11_conversation_trie": convtrie.OP11_SQL, "op12_spelling_variants": spelling.OP12_SQL}
