"""The registered queries of this subpackage and their SQL."""

from cairn.llm import byte_bpe, conversation_trie, decontaminate, exact_dedup, language_id, quality, secrets, simhash, suffix_dedup, token_counts, toxicity, vector_codes, warc

MODULES = (suffix_dedup, warc, token_counts, language_id, toxicity, secrets, simhash, byte_bpe, decontaminate, exact_dedup, vector_codes, conversation_trie, quality)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
