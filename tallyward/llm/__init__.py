"""Operators for preparing training data: search, packing, language, toxicity, privacy, mixing, sharding, duplicates, secrets."""
