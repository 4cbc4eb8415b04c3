"""Training-data operators: sharding, deduplication, decontamination, licence
scans, similarity joins, toxicity, tokenizing, WARC records, language-model
scores and token files. Nothing else in the library imports this package."""
