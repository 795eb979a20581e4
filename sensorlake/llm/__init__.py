"""Training-data operators: exact search, deduplication, language, tokens, packing, mixing."""
