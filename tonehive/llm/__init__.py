"""Training-data operators: fixity, mixing, deduplication, language, extraction, quality, privacy."""
