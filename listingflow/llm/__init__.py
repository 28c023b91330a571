"""Training-data operators (deduplication, language, tokens, mixing, sharding, search).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds ``llm.queries`` when present.
"""
