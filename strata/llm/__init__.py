"""Training-data operators: toxicity, search, mixing, PII, deduplication, tokens."""
