"""Operators for preparing large text corpora: dedup, PII, secrets, tokens, filters, shards."""
